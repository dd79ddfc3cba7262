"""Ordered texts of groups in parts of bounded bytes, whatever the rows and lines weigh.

Lines are numbered and stored; the running byte lengths are summed over narrow rows (group,
number, bytes). A line's start decides its part, and a line longer than a part is cut into pieces, so
no value exceeds the limit and no task gathers more than a part.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.ordered import (
    _LINE,
    _NUMBER,
    HOT_ROWS,
    _group_sizes,
    _join_keys,
    _lines,
    _numbered,
    _text_order,
    running_total,
)
from pairloom.session import materialize

# Spark holds values of up to 2 GB; parts stay far below.
PART_BYTES = 64 << 20
# Characters are placed as one byte each and may have four, and a part ends with a whole piece.
_SPREAD = 8


def byte_parts(
    df: DataFrame, by, order_by, line, name="text", keep=None, part_bytes=PART_BYTES,
    hot_rows=HOT_ROWS, slices=None,
) -> DataFrame:
    """(by, part, `name`): the parts of a group in order are its text; none exceeds `part_bytes`.

    `order_by`, `line` and `keep` are those of `ordered.ordered_text`. Parts are numbered from
    0 without gaps only where no line is longer than a part.
    """
    by, order_by = list(by), list(order_by)
    step = max(1, part_bytes // _SPREAD)
    order = _text_order(df, by, order_by)
    numbered = _numbered(df, by, order, keep, _group_sizes(df, by), hot_rows, slices)
    lines = materialize(_lines(numbered, by, line))

    narrow = lines.select(*by, _NUMBER, F.octet_length(_LINE).cast("bigint").alias("_bytes"))
    ends = running_total(narrow, by, [_NUMBER], F.col("_bytes"), "_end", hot_rows, slices)
    ends = ends.select(*[F.col(c).alias(c) for c in (*by, _NUMBER)], (F.col("_end") - F.col("_bytes")).alias("_start"))
    joined = lines.join(ends, _join_keys(lines, ends, [*by, _NUMBER]))
    kept = [lines[c] for c in (*by, _NUMBER, _LINE)]
    rows = joined.select(*kept, ends["_start"].alias("_start"))

    pieces = F.expr(f"greatest(0, (char_length({_LINE}) - 1) div {step}L)")
    rows = rows.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces)))
    at = (F.col("_piece") * step).cast("int")
    # A line without pieces is not copied.
    text = F.when(pieces == 0, F.col(_LINE)).otherwise(F.substring(F.col(_LINE), at + 1, F.lit(step)))
    rows = rows.select(
        *by, F.expr(f"(_start + _piece * {step}L) div {step}L").alias("part"), _NUMBER, "_piece", text.alias("_text"))
    listed = F.sort_array(F.collect_list(F.struct(_NUMBER, "_piece", "_text")))
    return rows.groupBy(*by, "part").agg(F.array_join(listed["_text"], "").alias(name))
