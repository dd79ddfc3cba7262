"""Texts in parts of bounded bytes."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators.ordered import ordered_text
from pairloom.operators.parts import byte_parts
from pairloom.operators.requests import comment_byte_parts, comment_block
from pairloom.operators.training import serialize_turns, turn_byte_parts


def line(get, number):
    return F.concat(number.cast("string"), F.lit(":"), get("t"), F.lit("\n"))


def glued(parts, by, name):
    found = {}
    for row in parts.orderBy(by, "part").collect():
        found[row[by]] = found.get(row[by], "") + row[name]
    return found


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
@pytest.mark.parametrize("limit", [8, 64, 4096])
def test_parts_make_up_the_text_and_keep_the_limit(spark, limit, hot_rows):
    pick = random.Random(limit)
    texts = ["", "a", "é日👍" * 9, "b" * 300, "line end\n"]
    rows = [(g, i, pick.choice(texts)) for g in (None, 1, 2, 3) for i in range(6 * (g or 2))]
    df = spark.createDataFrame(rows, "g int, o int, t string").repartition(4)
    parts = byte_parts(df, ["g"], ["o"], line, part_bytes=limit, hot_rows=hot_rows, slices=3)
    whole = ordered_text(df, ["g"], ["o"], line).collect()
    assert glued(parts, "g", "text") == {r["g"]: r["text"] for r in whole}
    # One character may have four bytes where a part has fewer.
    assert max(len(r["text"].encode()) for r in parts.collect()) <= max(limit, 4)


def test_ten_long_lines_give_parts(spark):
    df = spark.range(10).select(
        F.lit(1).alias("g"), F.col("id").alias("o"), F.repeat(F.lit("x y "), 1_000_000).alias("t"))
    parts = byte_parts(df, ["g"], ["o"], line, part_bytes=1 << 20)
    sizes = parts.select(F.octet_length("text").alias("n")).agg(F.max("n"), F.sum("n"), F.count("n")).first()
    assert sizes[0] <= 1 << 20 and sizes[1] == 10 * 4_000_000 + 9 * 3 + 4 and sizes[2] > 38


def test_comments_and_turns(spark):
    comments = spark.createDataFrame(
        [(1, 2, "second", "2024-02"), (1, None, "first", "2024-01"), (2, 1, None, None), (None, 1, "lost", "2024")],
        "PostId bigint, Score bigint, Text string, CreationDate string")
    blocks = {r["PostId"]: r["comment_block"] for r in comment_block(comments).collect()}
    assert glued(comment_byte_parts(comments, part_bytes=16), "PostId", "comment_block") == blocks
    turns = spark.createDataFrame(
        [(1, 0, "user", "a b"), (1, 1, "assistant", None), (2, 0, None, "z" * 50)],
        "conv_id bigint, turn bigint, role string, text string")
    chats = {r["conv_id"]: r["chat"] for r in serialize_turns(turns).collect()}
    assert glued(turn_byte_parts(turns, part_bytes=16), "conv_id", "chat") == chats
    assert turn_byte_parts(turns.limit(0)).count() == 0
