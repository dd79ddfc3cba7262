"""The first rows of an order without sorting: a threshold found by narrowing histograms.

A rank is a hexadecimal text of fixed length. Each pass counts the rows by a few more of
its digits, under the prefix that the wanted row is known to have, so a pass returns at most
16 ** DIGITS counts whatever the size of the table, and three passes settle 10^11 rows of
random ranks. Nothing is sorted and no row moves; the result is a filter.
"""

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.ordered import running_total
from pairloom.session import materialize

DIGITS = 4
LONG_DIGITS = 16


def long_rank(value: Column) -> Column:
    """Digits that are ordered as the longs are, nulls first."""
    # The sign bit is turned over, so negative numbers come first.
    digits = F.lower(F.hex(value.cast("bigint").bitwiseXOR(F.lit(-(2**63)))))
    digits = F.lpad(digits, LONG_DIGITS, "0")
    return F.when(value.isNull(), "0" * (LONG_DIGITS + 1)).otherwise(F.concat(F.lit("1"), digits))


def row_rank(df: DataFrame) -> Column:
    """A digest of the whole row; only equal rows share it, but for chance."""
    return F.lower(F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), LONG_DIGITS, "0"))


def nth_prefix(df: DataFrame, rank: Column, length: int, n: int, start=""):
    """`(prefix, wanted, count)` of the n-th smallest rank, from 1.

    Rows with smaller ranks number n - wanted; `count` rows begin with `prefix`. The search
    ends where all of these are wanted, or at the whole rank. `prefix` is None when there are
    fewer than n rows.
    """
    prefix, wanted = start, n
    while True:
        rows = df
        if prefix:
            rows = df.filter(F.substring(rank, 1, len(prefix)) == prefix)
        found = rows.groupBy(F.substring(rank, 1, len(prefix) + DIGITS).alias("p")).count().collect()
        at = None
        for at, count in sorted(map(tuple, found)):
            if wanted <= count:
                break
            wanted -= count
        else:
            return None, wanted, 0
        prefix = at
        if wanted == count or len(prefix) >= length:
            return prefix, wanted, count


def numbered_rows(df: DataFrame, name: str) -> DataFrame:
    """Stored rows numbered from 0 in the order they are stored: counts of the parts, then offsets."""
    marked = df.withColumn("_mark", F.monotonically_increasing_id())
    marked = materialize(marked.withColumn("_part", F.shiftright("_mark", 33)))
    counts = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per task
    offsets, before = [], 0
    for part, count in sorted(map(tuple, counts)):
        offsets.append((part, before))
        before += count
    offsets = df.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")
    within = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    placed = marked.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + within)
    return placed.select(*df.columns, name)


def positions(df: DataFrame, order_by, name="item_pos") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of the named columns.

    Rows are dealt to tasks by ranges of the order and sorted there; the counts of the ranges give
    the first number of each. No task has more than its range, however large the table.
    """
    order = [F.col(f"`{c}`") for c in order_by]
    return numbered_rows(df.repartitionByRange(*order).sortWithinPartitions(*order), name)


def file_positions(df: DataFrame, block, row, name="item_pos") -> DataFrame:
    """Number the rows of files in file order: the rows of all blocks before, and the place in the block.

    `block` names the columns that order the blocks; `row` counts up by one within a block, from
    any number. Only one row per block is ordered; the rows themselves are not sorted.
    """
    counts = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first"))
    before = running_total(counts, [], block, F.col("_n"), "_upto")
    before = before.select(*block, (F.col("_upto") - F.col("_n") - F.col("_first")).alias("_before"))
    kept = [c for c in df.columns if c not in (*block, row)]
    return df.join(before, block).select(*kept, (F.col("_before") + F.col(row)).alias(name))


def cut(df: DataFrame, rank: Column, length: int, n: int, start=""):
    """`(first, rest)`: the n rows of least rank, equal ranks by a digest of the row, and the others.

    Both are filters of `df`, which must hold the same rows at each reading. Only where equal
    rows lie on both sides of the cut, these are stored and numbered. None when there are
    fewer than n rows.
    """
    if n <= 0:
        return df.filter(F.lit(False)), df
    prefix, wanted, count = nth_prefix(df, rank, length, n, start)
    if prefix is None:
        return None
    head = F.substring(rank, 1, len(prefix))
    if wanted == count:
        return df.filter(head <= prefix), df.filter(head > prefix)
    tied, digest = df.filter(rank == prefix), row_rank(df)
    least, wanted, count = nth_prefix(tied, digest, LONG_DIGITS, wanted)
    first, rest = df.filter(rank < prefix), df.filter(rank > prefix)
    head = F.substring(digest, 1, len(least))
    if wanted == count:
        return first.unionByName(tied.filter(head <= least)), rest.unionByName(tied.filter(head > least))
    equal = numbered_rows(tied.filter(digest == least), "_number")
    first = first.unionByName(tied.filter(digest < least))
    rest = rest.unionByName(tied.filter(digest > least))
    return (
        first.unionByName(equal.filter(F.col("_number") < wanted).drop("_number")),
        rest.unionByName(equal.filter(F.col("_number") >= wanted).drop("_number")),
    )


def smallest(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the least integer key (all, if there are fewer), nulls first."""
    if n <= 0:
        return df.filter(F.lit(False))
    rank = long_rank(F.col(f"`{key}`"))
    # Keys share their leading digits; the counts begin behind them.
    ends = df.agg(F.min(rank), F.max(rank)).first()
    if ends[0] is None:
        return df
    shared = os.path.commonprefix(list(ends))[: LONG_DIGITS + 1 - DIGITS]
    found = cut(df, rank, LONG_DIGITS + 1, n, shared)
    return df if found is None else found[0]
