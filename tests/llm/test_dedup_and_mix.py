import random
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import grace_dedup, pareto_mix

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def random_docs(seed, n=300):
    rnd = random.Random(seed)
    pool = ["", " ", "a b", "ab", "a  b ", "\tab\n", "é x", "x" * 300, None, "long " * 2000]
    rows = [(i, rnd.choice([*pool, f"only {i}"]), "en", rnd.choice(["s", "t", None]), i) for i in range(n)]
    return rows + [rows[3], rows[3], (None, "ab", None, None, None), (None, None, None, None, None)]


def content(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


@pytest.mark.parametrize("table_bytes", [1, 3000, 1 << 20])
def test_groups_equal_brute_force(spark, table_bytes):
    rows = random_docs(table_bytes)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    groups = defaultdict(list)
    for r in rows:
        groups[content(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0))
    for hot_rows in (1, 10_000):
        found = grace_dedup.copy_groups(
            docs, hot_rows=hot_rows, local_bytes=table_bytes, table_bytes=table_bytes).collect()
        assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
        text_of = {r[0]: r[1] for r in rows if r[0] is not None}
        for r in (r for r in found if r.doc_id is not None):
            group = groups[content(text_of[r.doc_id])]
            assert r.group_size == len(group)
            assert r.keep_id == min(group)[2]
        assert sum(r.kept for r in found) == len(groups)
    kept = grace_dedup.keep_one(docs, local_bytes=table_bytes, table_bytes=table_bytes)
    assert kept.columns == docs.columns
    assert sorted(content(r.text) for r in kept.collect()) == sorted(groups)


def test_large_group_leaves_a_task_as_one_row(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text")).repartition(4)
    stored = grace_dedup._stored(docs, "doc_id", "text", grace_dedup.LOCAL_BYTES)
    assert stored.filter("_dedup_rows is not null").count() <= 4
    assert grace_dedup.copy_groups(docs, hot_rows=100).filter("kept").collect()[0].group_size == 5000


def test_contents_are_held_once_while_copies_are_told_apart():
    names = ["doc_id", "text", grace_dedup._ROW, grace_dedup._CHARS, grace_dedup._DIGEST, grace_dedup._ROWS]

    def batches():
        # Three copies of each content, the last one the longest, as blanks count.
        for copy in range(3):
            for first in range(0, 3000, 100):
                ids = range(first, first + 100)
                texts = [f"{i} " * 2000 + " " * copy for i in ids]
                digests = [(b"%08d" % (i // 2))[::-1] * 4 for i in ids]  # equal ones for two contents each
                rows = [3000 * copy + i for i in ids]
                columns = [rows, texts, rows, list(map(len, texts)), digests, [1] * 100]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=names)

    size = sum(len(f"{i}" * 2000) for i in range(3000))
    next(batches())  # imports what Arrow needs
    tracemalloc.start()
    try:
        found = [(r["doc_id"], r[grace_dedup._ROWS]) for batch in grace_dedup._grace(batches(), "doc_id", "text", 1 << 26)
                 for r in batch.select(["doc_id", grace_dedup._ROWS]).to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(found) == [(6000 + i, 3) for i in range(3000)]
    assert peak < size / 2


def test_dedup_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert grace_dedup.copy_groups(docs).count() == 0
    assert grace_dedup.keep_one(docs).count() == 0


def expected_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = {}, sum(sizes.values())
    while len(target) < len(names):
        left = [s for s in names if s not in target]
        unit = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if unit * weight[s] > cap * sizes[s]]
        if not over:
            target.update({s: unit * weight[s] for s in left})
        target.update({s: cap * sizes[s] for s in over})
    return target


@pytest.mark.parametrize("window_rows", [1, 20_000])
def test_mix_meets_its_targets(spark, window_rows):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(0, 60), "en", rnd.choice(["a"] * 6 + ["b", "c", "d", "é", None]), i)
            for i in range(900)] + [(900, None, None, "empty", 0), (None, "x y", None, "a", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash"))
    mixed = pareto_mix.mix(docs, window_rows=window_rows)
    found = mixed.collect()
    assert len(found) == len(rows)
    sizes, taken, targets = Counter(), Counter(), {}
    for r in found:
        assert r.size == len((r.text or "").split())
        assert r.taken == r.copies * r.size and r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
    for source, target in expected_targets(sizes).items():
        assert targets[source] == pytest.approx(target)
        assert abs(taken[source] - target) <= 60
    again = {(r.doc_id, r.copies) for r in pareto_mix.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.copies) for r in found}
    rows_out = pareto_mix.repeated(mixed, docs.columns[:5])
    assert rows_out.count() == sum(r.copies for r in found)


def test_weights_change_how_often_rows_are_taken(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("one two").alias("text"),
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("w"))
    b = pareto_mix.mix(docs, weight_col="w").filter("source = 'b'")
    mean = {r.w: r.m for r in b.groupBy("w").agg(F.avg("copies").alias("m")).collect()}
    assert mean[3.0] > 2 * mean[1.0]
    total = b.agg(F.sum("taken"), F.first("target")).first()
    assert abs(total[0] - total[1]) <= 2


def test_mix_of_no_rows_and_no_words(spark):
    none = spark.createDataFrame([], DOCS)
    assert pareto_mix.mix(none).count() == 0
    blank = spark.createDataFrame([(1, " ", "en", "s", 1), (2, None, "en", None, 1)], DOCS)
    assert {(r.target, r.taken) for r in pareto_mix.mix(blank).collect()} == {(0.0, 0)}
