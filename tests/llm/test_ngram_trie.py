import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from pairloom.llm import elias_fano, ngram_trie
from pairloom.llm.elias_fano import EliasFano

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = "</end>"
D = ngram_trie.DISCOUNT


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [END]


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts):
        docs = [tokens(t) for t in texts]
        self.c1 = Counter(w for d in docs for w in d)
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        pairs = Counter(p for d in docs for p in zip([END, *d], d) if min(self.c1[p[0]], self.c1[p[1]]) >= 2)
        self.c2 = {p: c for p, c in pairs.items() if c >= 2}
        triples = Counter(t for d in docs for t in zip([END, *d], d, d[1:])
                          if t[:2] in self.c2 and t[1:] in self.c2)
        self.c3 = {t: c for t, c in triples.items() if c >= 2}
        self.left1, self.left2 = {}, {}
        for p, c in self.c2.items():
            self.left1[p[0]] = self.left1.get(p[0], 1.0) - (c - D) / self.c1[p[0]]
        for t, c in self.c3.items():
            self.left2[t[:2]] = self.left2.get(t[:2], 1.0) - (c - D) / self.c2[t[:2]]

    def p1(self, w):
        return (self.c1[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p2(self, u, w):
        direct = (self.c2[u, w] - D) / self.c1[u] if (u, w) in self.c2 else 0.0
        return direct + self.left1.get(u, 1.0) * self.p1(w)

    def p3(self, t, u, w):
        if t is None or (t, u) not in self.c2:
            return self.p2(u, w)
        direct = (self.c3[t, u, w] - D) / self.c2[t, u] if (t, u, w) in self.c3 else 0.0
        return direct + self.left2.get((t, u), 1.0) * self.p2(u, w)

    def score(self, text):
        d = tokens(text)
        before = [None, END, *d]
        return sum(math.log10(self.p3(before[i], before[i + 1], w)) for i, w in enumerate(d))


TEXTS = ["the cat sat", "The cat sat on", "a dog", "the cat ran", "a dog sat", None, "", "é é é é", "x " * 300,
         "the cat sat on the mat", "rare word", "on the mat on the mat"] * 3


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "the cat", None), (3, "the cat ran", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def out_of_training(key):
    return key is not None and zlib.crc32(str(key).encode()) % 10 == 0


@pytest.mark.parametrize("shard_rows", [3, 4_000_000])
def test_scores_equal_dictionaries(spark, docs, monkeypatch, shard_rows):
    monkeypatch.setattr(ngram_trie, "SHARD_ROWS", shard_rows)
    rows = ngram_trie.score_held_out(docs.repartition(3)).collect()
    assert len(rows) == len(TEXTS) + 2
    plain = Plain([r.text for r in docs.collect() if not out_of_training(r.doc_id)])
    for r in rows:
        mine = tokens(r.text)
        assert r.held_out == out_of_training(r.doc_id)
        assert (r.n_tokens, r.train_tokens) == (len(mine), plain.n)
        assert r.n_known == sum(plain.c1[w] > 0 for w in mine)
        assert r.base_score == pytest.approx(sum(math.log10(plain.p1(w)) for w in mine))
        # Each stored number is rounded to 1/4000.
        assert r.score == pytest.approx(plain.score(r.text), abs=3e-4 * len(mine))


def test_probabilities_of_each_context_sum_to_one():
    plain = Plain(TEXTS)
    for context in [(None, END), ("the", "cat"), (END, "the"), ("no", "such"), ("on", "the")]:
        total = sum(plain.p3(*context, w) for w in plain.c1) + plain.p3(*context, "never seen")
        assert total == pytest.approx(1.0)


def test_no_training_rows_and_no_rows(spark, docs):
    empty = docs.filter("doc_id < 0")
    assert ngram_trie.score_held_out(empty).count() == 0
    row = ngram_trie.score_documents(docs.limit(1), ngram_trie.train(empty)).first()
    assert (row.n_known, row.train_tokens, row.base_score, row.score) == (0, 0, 0.0, 0.0)


def test_held_out_texts_score_better_than_by_words_alone(spark):
    from pairloom.llm.queries import lm_scores

    rows = [r for r in lm_scores(spark, "/root/testdata/sf0.001").collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (1000, 10**9), (5000, 6000), (20000, 10**14), (3000, 3)])
def test_sequences(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n))
    coded = EliasFano(**elias_fano.encode(values, universe))
    assert (coded.access(np.arange(n)) == values).all()
    asked = np.unique(np.concatenate([values[:300], rng.integers(0, universe, 300)]))
    zero = np.zeros(len(asked), np.int64)
    assert (coded.successor(asked, zero, zero + n) == np.searchsorted(values, asked)).all()
    if n > 100:
        size = sum(coded.__dict__[k].nbytes for k in ("high", "low")) * 8 / n
        assert size < 4 + max(0, math.log2(universe / n)) + 64 * 600 / n


def test_missing_mount_is_refused(spark, docs, monkeypatch):
    monkeypatch.setattr(ngram_trie, "scratch_path", lambda *a: "store://bucket/x")
    with pytest.raises(ValueError):
        ngram_trie.train(docs)


def test_coding_takes_memory_by_slices():
    values = np.cumsum(np.arange(1_000_000) % 7)
    tracemalloc.start()
    coded = elias_fano.encode(values, int(values[-1]) + 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * values.nbytes
    some = np.arange(0, len(values), 997)
    assert (elias_fano.EliasFano(**coded).access(some) == values[some]).all()


def test_select_in_full_and_empty_words():
    values = np.concatenate([np.arange(200), np.arange(200) + 64_000, [10**6] * 130])
    sequence = elias_fano.EliasFano(**elias_fano.encode(values, 10**6 + 1))
    places = np.arange(len(values))
    assert (sequence.access(places) == values).all()
    asked = np.unique(np.concatenate([values, values[:-1] + 1]))
    found = sequence.successor(asked, np.zeros_like(asked), np.full_like(asked, len(values)))
    assert (found == np.searchsorted(values, asked)).all()


def test_tally_counts_over_merges(monkeypatch):
    monkeypatch.setattr(ngram_trie, "TALLY_ROWS", 40)
    tally, keys = ngram_trie.Tally(), np.arange(500) ** 2 % 37
    batches = [b for at in range(0, 500, 9) for b in tally.add(keys[at : at + 9])]
    batches += tally.flush()
    total = Counter()
    for batch in batches:
        total.update(dict(zip(*(c.to_pylist() for c in batch.columns))))
    assert total == Counter(keys.tolist())
