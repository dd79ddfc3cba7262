import math
from collections import Counter

import numpy as np

from pairloom.llm import whitening


def _expected(rows, most=32):
    """By definition: whole numbers, numpy covariance, eigenvectors."""
    kept = []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) and abs(c) < 2**62 / 64 for c in v):
            kept.append((i, [math.floor(64 * c) + 1_000_000 for c in v]))
    lengths = Counter(len(x) for _, x in kept)
    size = max(lengths, key=lambda k: (lengths[k], k))
    kept = [(i, x) for i, x in kept if len(x) == size]
    n, sums = len(kept), [sum(column) for column in zip(*[x for _, x in kept])]
    apart = [[n * c - s for c, s in zip(x, sums)] for _, x in kept]
    centred = np.array(apart, float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    deviations = Counter((i, sum(d * d for d in row)) for (i, _), row in zip(kept, apart))
    return n, deviations, centred, values, basis


def _check(found, rows, most=32):
    n, deviations, centred, values, basis = _expected(rows, most)
    width = min(most, len(values))
    assert len(found) == n * width
    assert Counter((r.vec_id, r.deviation) for r in found if r.component == 1) == deviations
    assert {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, width + 1))
    for r in found:
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9
    table = {}
    for r in found:
        table.setdefault(r.at, [0.0] * width)[r.component - 1] = r.whitened
    got = np.array([table[at] for at in sorted(table)])
    return got, centred, values, basis


def _equal_up_to_sign(got, centred, values, basis):
    for k in range(got.shape[1]):
        wanted = centred @ basis[:, k] / math.sqrt(values[k])
        # Rows come in any order.
        assert min(np.abs(np.sort(sign * got[:, k]) - np.sort(wanted)).max() for sign in (1, -1)) < 1e-6


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, at string, row int, x string")


def test_equals_numpy_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 7 * 6)
    pick = np.random.default_rng(1)
    spread = pick.normal(size=(6, 6))
    rows = [(i, (pick.normal(size=6) @ spread * 3).tolist()) for i in range(160)]
    frame = _frame(spark, [(*row, "a", 1, "x") for row in rows]).repartition(5)
    found = whitening.whiten(frame).collect()
    got, *rest = _check(found, rows)
    _equal_up_to_sign(got, *rest)
    error = {r.identity_error for r in found}
    assert len(error) == 1 and 0 <= error.pop() < 1e-9
    assert np.abs(got.T @ got / len(got) - np.eye(6)).max() < 1e-9


def test_only_the_first_components(spark):
    pick = np.random.default_rng(2)
    rows = [(i, pick.normal(size=40).tolist()) for i in range(90)]
    found = whitening.whiten(_frame(spark, [(*row, None, None, None) for row in rows])).collect()
    got, *rest = _check(found, rows)
    assert got.shape == (90, 32)
    _equal_up_to_sign(got, *rest)


def test_odd_rows(spark):
    pick = np.random.default_rng(3)
    rows = [(i // 2, pick.normal(size=3).tolist()) for i in range(30)]
    odd = [(None, rows[0][1]), (None, rows[0][1]), rows[4], rows[4]]  # null ids, repeated rows
    left_out = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 0.0]),
                (94, [float("inf"), 0.0, 0.0]), (95, [1.0, 2.0]), (96, [1e300, 0.0, 0.0])]
    far = [(97, [1e4, -1e4, 0.5])]
    rows = rows + odd + left_out + far
    found = whitening.whiten(_frame(spark, [(*row, "a", 1, "b") for row in rows])).collect()
    assert not {r.vec_id for r in found} & {90, 91, 92, 93, 94, 95, 96}
    got, *rest = _check(found, rows)
    _equal_up_to_sign(got, *rest)


def test_no_variance_and_no_rows(spark):
    flat = _frame(spark, [(i, [float(i % 4), 2.0, 2.0 * (i % 4)], "a", 1, "b") for i in range(12)])
    found = whitening.whiten(flat).collect()
    assert len(found) == 36
    assert {r.whitened for r in found if r.component > 1} == {0.0}
    assert {r.identity_error for r in found} == {1.0}
    one = whitening.whiten(flat.limit(1)).collect()
    assert {(r.whitened, r.deviation, r.explained) for r in one} == {(0.0, 0, 0.0)}
    for frame in (flat.limit(0), flat.limit(0).union(_frame(spark, [(1, None, "a", 1, "b")]))):
        empty = whitening.whiten(frame)
        assert empty.collect() == [] and empty.dtypes == whitening.whiten(flat).dtypes


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(2**40) * (i % 2), 0.0], "a", 1, "b") for i in range(4)]
    assert {r.deviation for r in whitening.whiten(_frame(spark, rows)).collect()} == {None}
