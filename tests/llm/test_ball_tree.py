import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import ball_tree


def brute_force(rows, is_query, k):
    points = {}
    for key, vector in rows:
        if key is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            points[key] = [math.floor(256 * x) for x in vector]
    out = []
    for q in filter(is_query, points):
        scores = sorted((-sum(a * b for a, b in zip(points[q], v)), key) for key, v in points.items() if key != q)
        out += [(q, i + 1, key, -s) for i, (s, key) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, leaf", [(50_000, 256), (40, 4), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, shard_rows, leaf):
    monkeypatch.setattr(ball_tree, "LEAF_ROWS", leaf)
    monkeypatch.setattr(ball_tree, "BLOCK_ROWS", 7)
    rnd = random.Random(shard_rows)
    n = 120 if shard_rows == 1 else 400
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(8)]) for i in range(n)]
    rows += [(n + i, list(rows[3][1])) for i in range(30)]  # one very common vector
    rows += [(9000, None), (9010, [None] * 8), (9020, [math.nan] * 8), (9030, [math.inf] * 8), (None, [1.0] * 8)]
    rows += [(n + 40 + i, [0.0] * 8) for i in range(4)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    found = ball_tree.top_products(
        frame.repartition(3), F.col("vec_id") % 10 == 0, shard_rows=shard_rows).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, lambda q: q % 10 == 0, 5)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5])], schema)
    assert len(ball_tree.top_products(few, F.col("vec_id") == 0).collect()) == 1
    assert ball_tree.top_products(few.filter("vec_id < 0"), F.col("vec_id") == 0).count() == 0


def test_bounds_hold_in_every_node():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(0, 60, (3000, 16)))

    def check(node):
        assert np.linalg.norm(points[node.rows] - node.centre, axis=1).max() <= node.radius
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            for child in node.children:
                check(child)

    check(ball_tree.Node(points, np.arange(len(points))))
