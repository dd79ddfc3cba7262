"""Exact-size repeatable split into training and evaluation rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import draw_hash
from pairloom.operators import selection

DRAW_DIGITS = 32


def split_exact(df: DataFrame, key, eval_size=10, seed=42):
    """`(train, eval)`: `eval_size` rows with the lowest hash draws, and the rest.

    Together they are `df`, copies included; copies of a key are told apart by a digest of the
    row. The cut is found by counting draws, so both parts are filters of `df` at any
    evaluation size. Raises ValueError when no row would be left for training.
    """
    draw = draw_hash(F.col(key), seed, "split")
    found = selection.cut(df, draw, DRAW_DIGITS, eval_size)
    if found is None or found[1].isEmpty():
        raise ValueError(f"need more than {eval_size} rows to split")
    held_out, train = found
    return train, held_out


def split_summary(train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Row counts of `train`, `eval` and `total`."""
    def sized(df, name):
        return df.select(F.lit(name).alias("split"))

    both = sized(train, "train").unionByName(sized(held_out, "eval"))
    parts = both.withColumn("split", F.explode(F.array("split", F.lit("total"))))
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_leak_check(
    train: DataFrame, held_out: DataFrame, everything: DataFrame, key
) -> DataFrame:
    """Keys that break the split, with how often each part has them.

    A key is in order when it occurs in the parts as often as in `everything`,
    and not in both parts. Counted in one aggregate; an empty result is a pass.
    """
    def counted(df, name):
        return df.select(F.col(key).alias("key"), F.lit(name).alias("part"))

    rows = counted(train, "train").unionByName(counted(held_out, "eval"))
    rows = rows.unionByName(counted(everything, "all"))
    counts = rows.groupBy("key").agg(
        *[F.count_if(F.col("part") == p).alias(f"n_{p}") for p in ("train", "eval", "all")]
    )
    return counts.filter(
        (F.col("n_train") + F.col("n_eval") != F.col("n_all"))
        | ((F.col("n_train") > 0) & (F.col("n_eval") > 0))
    )


# Ranges of the digest comparison, and how many ranges each differing one is cut into.
RANGES = 1 << 10
NARROWER = 1 << 10


def _digests(df: DataFrame, key, ranges):
    """Rows and a sum of row digests per range of the key's hash: it does not depend on order."""
    place = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(ranges))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    # Halves, so that sums of any number of rows stay within a decimal.
    return df.select(place.alias("range"), row.cast("decimal(20,0)").alias("row"))


def table_differences(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Keys whose rows differ between two tables of the same columns, copies included.

    Compares commutative digests of hash ranges of the key (one aggregate, one row per range) and
    reads only the rows of ranges that differ again, by finer ranges and then by key. Equal
    tables cost one pass and move no row. Returns key, n_left, n_right.
    """
    def compared(a, b, ranges):
        both = _digests(a, key, ranges).withColumn("side", F.lit(1)).unionByName(
            _digests(b, key, ranges).withColumn("side", F.lit(-1)))
        summed = both.groupBy("range").agg(
            F.sum(F.col("side") * F.col("row")).alias("digest"), F.sum("side").alias("n"))
        return summed.filter("digest <> 0 or n <> 0").select("range")

    def within(df, ranges, broken):
        place = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(ranges))
        return df.withColumn("_range", place).join(
            F.broadcast(broken.select(F.col("range").alias("_range"))), "_range", "left_semi").drop("_range")

    # At most RANGES, then at most RANGES * NARROWER numbers are broadcast.
    for ranges in (RANGES, RANGES * NARROWER):
        broken = compared(left, right, ranges)
        left, right = within(left, ranges, broken), within(right, ranges, broken)

    def counted(df, name):
        row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
        return df.select(F.col(f"`{key}`").alias("key"), row.cast("decimal(20,0)").alias("row"), F.lit(name).alias("side"))

    rows = counted(left, 1).unionByName(counted(right, -1))
    found = rows.groupBy("key").agg(
        F.count_if(F.col("side") == 1).alias("n_left"), F.count_if(F.col("side") == -1).alias("n_right"),
        F.sum(F.col("side") * F.col("row")).alias("digest"),
    )
    return found.filter("digest <> 0 or n_left <> n_right").drop("digest")
