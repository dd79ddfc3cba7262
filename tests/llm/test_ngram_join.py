import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import ngram_join, words
from pairloom.llm.shared import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = "/root/testdata/sf0.001"
CONTRACT = ["doc_id", "n_shingles", "component_id"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, size=5):
    found = WORD.findall(lower(text))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def brute_force(rows, size=5, percent=80):
    sets = [shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)].append(key)
    return sorted(
        ((k, len(s), min(least[find(i)], default=None) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))),
        key=str)


def found_rows(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_shingles string")
    out = ngram_join.jaccard_classes(docs.repartition(3), **options)
    return sorted(map(tuple, out.select(*CONTRACT).collect()), key=str)


def near_copies(seed):
    """Bases, chains of edits of each, one passage in many texts, short and odd texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rnd.choices(vocabulary, k=40)
    texts = ["", " \t", None, "A b", "a B", "a", "a b c d", "a b c d e", "é É", "é é", "x y z x y z x y z x y z"]
    for _ in range(12):
        base = rnd.choices(vocabulary, k=rnd.choice([6, 12, 30, 80, 200]))
        if rnd.random() < 0.5:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rnd.randint(1, 14)):
            texts.append(" ".join(base))
            for _ in range(rnd.randint(0, 3)):
                base = list(base)
                base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                base = base + rnd.choices(vocabulary, k=3)
    texts += [" ".join(passage), " ".join(passage + ["end"])] * 2
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    return rows + [rows[20], (None, texts[20]), (None, None)]


@pytest.mark.parametrize("seed, tile_rows", [(1, 2048), (2, 2), (3, 5)])
def test_classes_equal_brute_force(spark, seed, tile_rows):
    rows = near_copies(seed)
    assert found_rows(spark, rows, tile_rows=tile_rows, hot_rows=3) == brute_force(rows)


def test_other_thresholds(spark):
    rows = near_copies(4)
    assert found_rows(spark, rows, size=2, percent=50) == brute_force(rows, 2, 50)


def test_every_shingle_common_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "shingle_levels", lambda s: np.ones(1 << ngram_join.SKETCH_BITS, np.uint8))
    rows = near_copies(5)
    assert found_rows(spark, rows) == brute_force(rows)


def test_registered_query_equals_brute_force(spark):
    from pairloom.llm.queries import ngram_join_classes

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = ngram_join_classes(spark, DATA).select(*CONTRACT)
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)


def test_bounds_never_fall_below_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 200))) for _ in "ab")
        maps = [np.frombuffer(ngram_join.bitmap(x), np.uint8) for x in (a, b)]
        shared = len(np.intersect1d(a, b))
        assert ngram_join.overlap_bound(len(a), maps[0], len(b), maps[1]) >= shared
        assert (ngram_join.unpack(ngram_join.pack(a)) == a >> np.uint64(16)).all()


def test_sets_of_a_batch_are_made_in_small_chunks():
    texts = [f"{i} word of a text " * 300 for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array([0] * 300), pa.array(texts)], names=["id", "key", "text"])
    tracemalloc.start()
    try:
        assert sum(made.num_rows for made in ngram_join._set_rows([batch], 5)) == 300
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20 << 20


def test_words_of_chunks():
    texts = ["a  b", "", " ", None, "É x\ty", "A b", "long " * 50, "a\x0bb\x0cc d"]
    seen = {}
    for limit in (1, 20, 1 << 20):
        for rows, data, bounds in words.chunks(pa.array(texts), limit):
            hashes, firsts, _ = words.split(data, bounds)
            for i, text in enumerate(texts[rows]):
                mine = hashes[firsts[i] : firsts[i + 1]].tolist()
                expected = WORD.findall(lower(text))
                assert len(mine) == len(expected)
                for word, value in zip(expected, mine):
                    assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    out = components(spark.createDataFrame(edges, "a long, b long")).collect()
    root = {r.node: r.root for r in out}
    assert len(out) == len(root)
    assert {root[i] for i in range(61)} == {0} and {root[i] for i in range(100, 140)} == {100}
    assert root[202] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_classes(docs).count() == 0


def test_hot_group_of_near_copies(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit(" ".join(f"v{i}" for i in range(120)) + " tail "), F.col("id").cast("string")).alias("text"))
    out = ngram_join.jaccard_classes(docs, tile_rows=64)
    assert out.groupBy("component_id").count().collect() == [(0, 600)]


def linked(x, y, percent=80):
    a, b = shingles(x), shingles(y)
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def test_each_row_names_another_that_it_links_with(spark):
    texts = {i: text for i, text in enumerate({t: 0 for _, t in near_copies(6)})}
    texts |= {1000 + i: texts[i] for i in range(0, len(texts), 9)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for row in ngram_join.jaccard_classes(docs.repartition(3)).collect():
        others = {i for i in texts if i != row.doc_id and linked(texts[row.doc_id], texts[i])}
        assert row.linked_id in others if others else row.linked_id is None


def test_one_row_of_each_class_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near, other = base + " end", " ".join(f"v{i}" for i in range(30))
    rows = [(1, base, "p", 0), (1, base, "p", 0), (1, base, "q", 0), (2, near, "r", 0), (None, other, "s", 0), (None, other, "s", 0),
            (7, None, "t", 0), (7, None, "t", 0), (8, "", "u", 0), (9, "a b", "v", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, rows long")
    kept = ngram_join.keep_one_of_each(docs.repartition(3))
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(1, base), (None, other), (7, None), (7, None), (8, ""), (9, "a b")], key=str)
    assert ngram_join.keep_one_of_each(docs.limit(0)).count() == 0


def test_group_of_drifting_copies_needs_few_pairs_after_the_rounds(spark, monkeypatch):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(400):
        words_ = list(base)
        for at in rnd.sample(range(200), 2):
            words_[at] = f"x{rnd.randrange(10**6)}"
        texts.append((i, " ".join(words_)))
    sizes = []
    original = ngram_join._linked

    def counted(pairs, nodes, percent):
        sizes.append(pairs.count())
        return original(pairs, nodes, percent)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    assert found_rows(spark, texts) == brute_force(texts)
    # 79,800 pairs in all.
    assert sizes[-1] < 2000, sizes
