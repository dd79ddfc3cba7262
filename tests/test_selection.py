"""Thresholds by counting, positions, table digests and texts that are counted once."""

import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pairloom.operators import selection
from pairloom.operators.requests import cap_pending
from pairloom.operators.splits import split_exact, table_differences
from pairloom.plans.train import training_sequences


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 2, 7, 30, 59, 60, 61])
def test_smallest_equals_a_sort(spark, n):
    keys = [None, None, -(2**63), 2**63 - 1, -1, 0, 1, -5, *[7] * 20, *range(1000, 1032)]
    df = spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], "k bigint, v int").repartition(4)
    wanted = sorted(keys, key=lambda k: (k is not None, k))[:n]
    got = selection.smallest(df, "k", n)
    assert Counter(r["k"] for r in got.collect()) == Counter(wanted)
    assert not bag(got) - bag(df)


def test_caps_of_other_keys_and_empty_tables(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "k string, v int")
    assert [r["k"] for r in cap_pending(df, 1, "k").collect()] == ["a"]
    assert cap_pending(spark.range(0), 3, "id").count() == 0


def test_cut_tells_equal_rows_apart_by_number(spark):
    df = spark.createDataFrame([("x", 1)] * 50 + [("x", 2)] * 3 + [("y", 1)], "k string, v int").repartition(5)
    for n in (1, 2, 3, 4, 30, 53):
        train, held_out = split_exact(df, "k", n)
        assert held_out.count() == n and bag(train) + bag(held_out) == bag(df)


def test_split_of_more_than_a_top_k(spark):
    df = spark.range(250_000)
    train, held_out = split_exact(df, "id", 120_000)
    assert (train.count(), held_out.count()) == (130_000, 120_000)
    assert train.join(held_out, "id").count() == 0


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_positions_do_not_depend_on_the_partitioning(spark, parts):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"), F.lit("t").alias("t")).repartition(parts)
    got = selection.positions(df, ["k"])
    assert got.columns == ["k", "t", "item_pos"]
    assert sorted((r["k"], r["item_pos"]) for r in got.collect()) == [(i, i) for i in range(500)]
    assert selection.positions(df.limit(0), ["k"]).count() == 0


def test_file_positions(spark):
    rows = [("b", 0, 40 + i, f"b{i}") for i in range(3)] + [("a", 64, 10 + i, f"a64-{i}") for i in range(4)]
    rows += [("a", 0, i, f"a0-{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "f string, b int, r bigint, t string").repartition(6)
    got = selection.file_positions(df, ["f", "b"], "r", "at")
    texts = [r["t"] for r in got.orderBy("at").collect()]
    assert texts == [f"a0-{i}" for i in range(5)] + [f"a64-{i}" for i in range(4)] + [f"b{i}" for i in range(3)]
    assert [r["at"] for r in got.orderBy("at").collect()] == list(range(12))


def test_table_differences(spark):
    whole = spark.range(3000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    assert table_differences(whole, whole.repartition(7), "k").count() == 0
    key, value = F.col("k"), F.col("v")
    other = whole.filter("v <> 17").unionByName(whole.filter("v = 999")).withColumn(
        "v", F.when(value == 2500, -1).otherwise(value))
    assert sorted(map(tuple, table_differences(whole, other, "k").collect())) == [
        (17, 3, 2), (500, 3, 3), (999, 3, 4)]
    # Rows that change places between keys keep the total the same.
    swapped = whole.withColumn("v", F.when(key == 1, value + 1).when(key == 2, value - 1).otherwise(value))
    assert {r["key"] for r in table_differences(whole, swapped, "k").collect()} == {1, 2}
    lost = whole.filter("k is not null").unionByName(spark.createDataFrame([(None, 5)], "k bigint, v bigint"))
    assert [tuple(r) for r in table_differences(whole, lost, "k").collect()] == [(None, 0, 1)]


def test_a_counter_sees_each_text_once(spark, tmp_path):
    folder = str(tmp_path)

    @F.pandas_udf(LongType())
    def counter(texts: pd.Series) -> pd.Series:
        with open(os.path.join(folder, str(os.getpid())), "a") as log:
            log.writelines(f"{hash(t)}\n" for t in texts if t)
        return texts.map(lambda t: len(t.split()) if t else 0)

    df = spark.range(200).select(
        F.col("id").alias("question_id"), F.concat(F.lit("t"), "id").alias("title"), F.lit("b").alias("question_body"),
        F.lit("a b c").alias("enriched_answer"), F.when(F.col("id") % 3 > 0, "z y").otherwise("").alias("thinking_trace_re"),
        F.lit(False).alias("trace_truncated"),
    )
    found = training_sequences(df, drop_prob=0.5, block=64, counter=counter, rows_per_shard=60)
    rows = found.collect()
    assert len(rows) == 200 and {r["shard"] for r in rows} == {0, 1, 2, 3}
    seen = Counter(line for name in os.listdir(folder) for line in open(os.path.join(folder, name)))
    dropped = sum("<think></think>" in r["text"] for r in rows)
    assert dropped > 0 and sum(seen.values()) == len(seen) == 200 + dropped
    assert all(r["n_tokens"] == len(r["text"].split()) for r in rows)
