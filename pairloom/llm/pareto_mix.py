"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weighted share of all sizes, at most `cap` times its own
size; the excess goes to the others by weight. A document is taken `target / size of
its source` times in expectation (times its relative weight, where a weight column
is given). The whole part of that is certain. For the rest, documents are ranked by

    random odds U / (1 - U) divided by the odds of inclusion p / (1 - p)

and taken in this order until the source's target is met: the sample's size is fixed
in words, to within half of one document. U comes from a hash of the id, so reruns agree.

The cut in each source's order is found by narrowing a histogram of the ranks, one
aggregate per round, and by an ordered sum over the last, bounded bin; so a source
that holds a third of all rows never meets in one task.

Defined results: a null text has size 0; a null source is a source, last in order;
rows that repeat an id share its draw; ids that are null draw by text. Without words, targets
are 0. Other columns are carried along; `_mix_*` and the added columns are replaced.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.operators.ordered import with_position
from pairloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BINS = 1024
# Rows of a source that one window may order.
WINDOW_ROWS = 20_000
# Each round divides a bin by 1,024, so five rounds reach the last bit of a draw.
ROUNDS = 5
# Sources up to this number are broadcast (under 10 MB); more meet in an equi join.
BROADCAST_SOURCES = 100_000

_KEY, _DRAW, _RANK = "_mix_source", "_mix_draw", "_mix_rank"


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(id_col, text_col):
    """Uniform in (0, 1): 52 bits of a hash of the id."""
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit("mix-"), key)), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / 2.0**52


def _targets(sources: DataFrame, weights, cap) -> DataFrame:
    """Source, source_size -> with target. `sources` is stored and one row per source."""
    placed = with_position(sources, [F.col(_KEY).asc_nulls_last()], "_mix_position")
    choice = F.element_at(F.array(*map(F.lit, weights)), (F.col("_mix_position") % len(weights) + 1).cast("int"))
    placed = materialize(placed.withColumn("_mix_weight", choice.cast("double")))
    most = cap * F.col("source_size")
    total = float(placed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        # Rising level of a weight unit; sources that reach their cap stay there.
        capped = most < level * F.col("_mix_weight")
        full, open_weight = placed.agg(
            F.sum(F.when(capped, most).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("_mix_weight"))),
        ).first()
        if not open_weight:
            break
        reached = (total - full) / open_weight
        if reached <= level:
            break
        level = reached
    target = F.least(most.cast("double"), F.lit(level) * F.col("_mix_weight"))
    return placed.select(_KEY, "source_size", target.alias("target"))


def _meet(rows: DataFrame, sources: DataFrame, n_sources: int, how="inner") -> DataFrame:
    if n_sources <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    renamed = sources.withColumnRenamed(_KEY, "_mix_right")
    same = rows[_KEY].eqNullSafe(renamed["_mix_right"])
    return rows.join(renamed, same, how).drop("_mix_right")


def _cuts(ranked: DataFrame, needs: DataFrame, n_sources, window_rows) -> DataFrame:
    """Per source the largest rank that is taken; sources without one are absent.

    `ranked`: source, rank in [0, 1), words. `needs`: source, words wanted.
    """
    # The bin that holds the cut, and the words of the bins before it.
    bins = needs.filter(F.col("_mix_need") > 0).select(
        _KEY, "_mix_need", F.lit(0.0).alias("_mix_from"), F.lit(1.0).alias("_mix_width"),
        F.lit(0).cast("bigint").alias("_mix_before"),
    )
    order = W.partitionBy(_KEY).orderBy("_mix_bin")
    for _ in range(ROUNDS):
        inside = _meet(ranked, bins, n_sources).filter(
            (F.col(_RANK) >= F.col("_mix_from"))
            & (F.col(_RANK) < F.col("_mix_from") + F.col("_mix_width"))
        )
        number = F.floor((F.col(_RANK) - F.col("_mix_from")) / F.col("_mix_width") * BINS)
        counts = inside.groupBy(
            _KEY, "_mix_need", "_mix_from", "_mix_width", "_mix_before",
            F.least(number, F.lit(BINS - 1)).alias("_mix_bin"),
        ).agg(F.sum("size").alias("_mix_words"), F.count(F.lit(1)).alias("_mix_rows"))
        counts = counts.withColumn("_mix_upto", F.col("_mix_before") + F.sum("_mix_words").over(order))
        last = F.row_number().over(W.partitionBy(_KEY).orderBy(F.col("_mix_bin").desc())) == 1
        reached = (F.col("_mix_upto") >= F.col("_mix_need")) | F.col("_mix_last")
        first = W.partitionBy(_KEY).orderBy("_mix_bin")
        found = counts.withColumn("_mix_last", last).filter(reached).withColumn(
            "_mix_place", F.row_number().over(first)).filter("_mix_place = 1")
        step = F.col("_mix_width") / BINS
        bins = materialize(found.select(
            _KEY, "_mix_need", (F.col("_mix_from") + F.col("_mix_bin") * step).alias("_mix_from"),
            step.alias("_mix_width"),
            (F.col("_mix_upto") - F.col("_mix_words")).alias("_mix_before"), "_mix_rows",
        ))
        if (bins.agg(F.max("_mix_rows")).first()[0] or 0) <= window_rows:
            break
    inside = _meet(ranked, bins, n_sources).filter(
        (F.col(_RANK) >= F.col("_mix_from"))
        & (F.col(_RANK) < F.col("_mix_from") + F.col("_mix_width"))
    )
    steps = inside.groupBy(_KEY, "_mix_need", "_mix_from", "_mix_before", _RANK).agg(
        F.sum("size").alias("_mix_words"))
    upto = F.col("_mix_before") + F.sum("_mix_words").over(W.partitionBy(_KEY).orderBy(_RANK))
    missing = F.col("_mix_need") - (F.col("_mix_upto") - F.col("_mix_words"))
    # A step is taken while that brings the words nearer to what is wanted.
    nearer = F.col("_mix_upto") - F.col("_mix_need") < missing
    taken = steps.withColumn("_mix_upto", upto).groupBy(_KEY, "_mix_from").agg(
        F.max(F.when(nearer, F.col(_RANK))).alias("_mix_cut"))
    # Where no step of the last bin is taken, the bins before it are.
    return taken.select(
        _KEY, F.coalesce("_mix_cut", "_mix_from").alias("_mix_cut"),
        F.col("_mix_cut").isNotNull().alias("_mix_at"))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
        weights=WEIGHTS, cap=3, weight_col=None, window_rows=WINDOW_ROWS) -> DataFrame:
    """`docs` with size, source_size, target, copies (how often the mix takes it), taken."""
    added = ["size", "source_size", "target", "copies", "taken"]
    kept = docs.drop(*added)
    sized = kept.withColumns({
        "size": n_words(F.col(text_col)),
        _KEY: F.col(source_col),
        _DRAW: draw(id_col, text_col),
        "_mix_relative": F.col(weight_col).cast("double") if weight_col else F.lit(1.0),
    })
    narrow = materialize(sized.select(_KEY, "size", _DRAW, "_mix_relative"))
    sources = materialize(narrow.groupBy(_KEY).agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("size") * F.col("_mix_relative")).alias("_mix_weighed")))
    n_sources = sources.count()
    targets = _targets(sources.select(_KEY, "source_size"), weights, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    if weight_col:
        weighed = sources.select(F.col(_KEY).alias("_mix_other"), "_mix_weighed")
        targets = targets.join(weighed, F.col(_KEY).eqNullSafe(F.col("_mix_other"))).drop("_mix_other")
        rate = F.when(F.col("_mix_weighed") > 0, F.col("target") / F.col("_mix_weighed")).otherwise(0.0)
    targets = materialize(targets.withColumn("_mix_rate", rate))

    expected = F.least(F.lit(float(cap)), F.col("_mix_rate") * F.col("_mix_relative"))
    whole = F.floor(expected)
    chance = expected - whole
    odds = F.col(_DRAW) / (1 - F.col(_DRAW)) / (chance / (1 - chance))
    rank = F.when(chance > 0, F.least(odds / (1 + odds), F.lit(1 - 2.0**-53)))

    def rates(rows):
        return _meet(rows, targets.select(_KEY, "source_size", "target", "_mix_rate"), n_sources)

    ranked = rates(narrow).select(
        _KEY, "size", "target", whole.alias("_mix_whole"), rank.alias(_RANK))
    needs = materialize(ranked.groupBy(_KEY, "target").agg(
        F.sum(F.col("_mix_whole") * F.col("size")).alias("_mix_certain")
    ).select(_KEY, (F.col("target") - F.col("_mix_certain")).alias("_mix_need")))
    open_rows = ranked.filter(F.col(_RANK).isNotNull()).select(_KEY, _RANK, "size")
    cuts = materialize(_cuts(open_rows, needs, n_sources, window_rows))

    drawn = _meet(rates(sized).withColumn(_RANK, rank), cuts, n_sources, "left_outer")
    below = F.when(F.col("_mix_at"), F.col(_RANK) <= F.col("_mix_cut")).otherwise(
        F.col(_RANK) < F.col("_mix_cut"))
    copies = whole + F.when(below, 1).otherwise(0)
    return drawn.select(
        *kept.columns, "size", "source_size", F.col("target").cast("double").alias("target"),
        copies.cast("bigint").alias("copies"), (copies * F.col("size")).cast("bigint").alias("taken"))


def repeated(mixed: DataFrame, columns) -> DataFrame:
    """Each row as often as the mix takes it."""
    often = mixed.filter("copies > 0").withColumn("_mix_copy", F.explode(
        F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return often.select(*columns)
