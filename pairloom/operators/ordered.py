"""Running totals, positions and ordered texts that survive one huge group.

Groups up to the hot limit go through a plain window or `collect_list`. A group
too large for one task is range-partitioned into slices of its order, so no task
ever holds it: each slice is summed on its own and starts from the total of the
slices before.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.session import materialize

HOT_ROWS = 1_000_000
# Lines of a group that are collected into one value without numbering them first.
HOT_TEXT_ROWS = 100_000
# A hot group holds more than 1/MAX_HOT_GROUPS of all rows, so there are fewer
# than this many of them: that bounds the table of hot keys that is broadcast.
# Groups below that share do not skew a shuffle, and a window sorts and spills them.
MAX_HOT_GROUPS = 10_000
SEGMENT_ROWS = 1_000
# Spark gathers the rows of a top-k in one task, so it is used up to this size.
TOP_K_ROWS = 100_000

_SLICE, _ROW_TOTAL, _START = "_slice", "_slice_total", "_start"
_NUMBER, _LINE = "_number", "_line"


def _join_keys(left: DataFrame, right: DataFrame, by) -> Column:
    condition = F.lit(True)
    for name in by:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def _group_sizes(df: DataFrame, by):
    """Rows per group, with the number of all rows and the largest group.

    Costs one job over the key columns, aggregated before its shuffle.
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    return sizes, total or 0, largest or 0


def _hot_groups(measured, hot_rows):
    """Keys of hot groups, or None when there are none."""
    sizes, total, largest = measured
    limit = max(hot_rows, total // MAX_HOT_GROUPS)
    return None if largest <= limit else sizes.filter(F.col("_n") > limit).drop("_n")


def _only(df: DataFrame, keys: DataFrame, by, how) -> DataFrame:
    keys = keys.select(*[F.col(name).alias(name) for name in by])
    return df.join(F.broadcast(keys), _join_keys(df, keys, by), how)


def _sliced_total(df: DataFrame, by, order_by, value: Column, name, slices) -> DataFrame:
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn(name, value.cast("bigint")).repartitionByRange(
        slices, *[F.col(c) for c in by], *order_by
    )
    # The slice of a row must not change between the two reads below.
    rows = materialize(ranged.withColumn(_SLICE, F.spark_partition_id()))

    # At most one row per group and slice it touches: #groups + #slices rows.
    totals = rows.groupBy(*by, _SLICE).agg(F.sum(name).alias(_ROW_TOTAL))
    before = W.partitionBy(*by).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        *by, _SLICE, F.coalesce(F.sum(_ROW_TOTAL).over(before), F.lit(0)).alias(_START)
    )
    within = W.partitionBy(*by, _SLICE).orderBy(*order_by)
    running = F.sum(name).over(within.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn(name, running)
    starts = starts.select(*[F.col(c).alias(c) for c in starts.columns])
    joined = rows.join(starts, _join_keys(rows, starts, [*by, _SLICE]), "left")
    kept = [rows[c] for c in df.columns if c != name]
    return joined.select(*kept, (rows[name] + starts[_START]).alias(name))


def running_total(
    df: DataFrame, by, order_by, value: Column, name, hot_rows=HOT_ROWS, slices=None
) -> DataFrame:
    """Add `name`: the sum of `value` up to and including each row of its group.

    `order_by` should order the rows of a group uniquely. With an empty `by` the
    whole table is one group.
    """
    by = list(by)
    order_by = [F.col(c) if isinstance(c, str) else c for c in order_by]

    def plain(part):
        window = W.partitionBy(*by).orderBy(*order_by)
        total = F.sum(value.cast("bigint")).over(window.rowsBetween(W.unboundedPreceding, 0))
        return part.withColumn(name, total)

    hot = _hot_groups(_group_sizes(df, by), hot_rows)
    if hot is None:
        return plain(df)
    if not by:
        return _sliced_total(df, by, order_by, value, name, slices)
    large = _only(df, hot, by, "left_semi")
    sliced = _sliced_total(large, by, order_by, value, name, slices)
    return plain(_only(df, hot, by, "left_anti")).unionByName(sliced)


def with_position(df: DataFrame, order_by, name="item_pos", hot_rows=HOT_ROWS, slices=None):
    """Number the rows of the table 0, 1, 2, ... in the given order."""
    numbered = running_total(df, [], order_by, F.lit(1), name, hot_rows, slices)
    return numbered.withColumn(name, F.col(name) - 1)


def first_rows(df: DataFrame, order_by, n, top_k_rows=TOP_K_ROWS) -> DataFrame:
    """The first `n` rows in the given order."""
    if n <= top_k_rows:
        return df.orderBy(*order_by).limit(n)
    placed = with_position(df, order_by, "_position")
    return placed.filter(F.col("_position") < n).drop("_position")


def _numbered(df: DataFrame, by, order, keep, measured, hot_rows, slices) -> DataFrame:
    """Number the rows of each wanted group from 1 in the given order.

    `keep` is applied after hot groups are set apart, so its join cannot skew.
    """
    def plain(part):
        number = F.row_number().over(W.partitionBy(*by).orderBy(*order))
        return _kept(part, by, keep).withColumn(_NUMBER, number.cast("bigint"))

    hot = _hot_groups(measured, hot_rows)
    if hot is None:
        return plain(df)
    rest = plain(_only(df, hot, by, "left_anti"))
    if keep is not None:
        # Still fewer than MAX_HOT_GROUPS keys.
        hot = _only(keep.select(*by).distinct(), hot, by, "left_semi")
    large = _only(df, hot, by, "left_semi")
    order = [F.col(c) for c in order]
    return rest.unionByName(_sliced_total(large, by, order, F.lit(1), _NUMBER, slices))


def _kept(df: DataFrame, by, keep) -> DataFrame:
    return df if keep is None else df.join(keep.select(*by), by, "left_semi")


def _text_order(df: DataFrame, by, order_by):
    """The remaining columns break the last ties."""
    return [*order_by, *[c for c in df.columns if c not in by and c not in order_by]]


def _lines(numbered: DataFrame, by, line) -> DataFrame:
    number = F.col(_NUMBER)
    return numbered.select(*by, _NUMBER, line(F.col, number).alias(_LINE))


def _glue(df: DataFrame, keys, number, text, name) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct(number, text)))
    texts = F.transform(rows, lambda row: row[text])
    return df.groupBy(*keys).agg(F.array_join(texts, "").alias(name))


def _parts(lines: DataFrame, by, name, part_rows) -> DataFrame:
    placed = lines.withColumn("part", F.expr(f"({_NUMBER} - 1) div {int(part_rows)}L"))
    return _glue(placed, [*by, "part"], _NUMBER, _LINE, name)


def ordered_text(
    df: DataFrame, by, order_by, line, name="text", keep=None,
    hot_rows=HOT_TEXT_ROWS, slices=None,
) -> DataFrame:
    """One text per group: its lines in order, joined without a separator.

    `order_by` names columns; the other columns of `df` break ties, in their order.
    `line(get, number)` builds the text of a row from `get(column)` and its
    number, counted from 1. `keep` optionally holds the keys to build texts for.

    The text of a group is one value, and Spark holds values of up to 2 GB; use
    `ordered_parts` where a group may be larger.
    """
    by, order_by = list(by), list(order_by)
    order = _text_order(df, by, order_by)
    measured = _group_sizes(df, by)
    if measured[2] > hot_rows:
        numbered = _numbered(df, by, order, keep, measured, hot_rows, slices)
        parts = _parts(_lines(numbered, by, line), by, _LINE, SEGMENT_ROWS)
        return _glue(parts, by, "part", _LINE, name)
    rows = F.sort_array(F.collect_list(F.struct(*order)))
    joined = F.transform(rows, lambda row, i: line(lambda c: row[c], i + 1))
    return _kept(df, by, keep).groupBy(*by).agg(F.array_join(joined, "").alias(name))


def ordered_parts(
    df: DataFrame, by, order_by, line, name="text", keep=None, part_rows=SEGMENT_ROWS,
    hot_rows=HOT_ROWS, slices=None,
) -> DataFrame:
    """The texts of `ordered_text` in parts of `part_rows` lines, numbered from 0.

    The parts of a group in order are its text. No task and no value holds more
    than one part of a hot group, so a group may have any size.
    """
    by, order_by = list(by), list(order_by)
    order = _text_order(df, by, order_by)
    numbered = _numbered(df, by, order, keep, _group_sizes(df, by), hot_rows, slices)
    return _parts(_lines(numbered, by, line), by, name, part_rows)
