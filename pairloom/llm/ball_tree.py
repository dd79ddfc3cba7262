"""Exact top-k inner products: ball trees per shard, searched by branch and bound.

Rows with the same vector are one candidate that keeps its `k + 1` smallest ids (a query
can be one of them). Candidates are dealt to shards by hash; each shard builds a tree
whose nodes are balls. The inner product of a query with anything in a ball is at most
`query . centre + |query| * radius`; nodes are taken in the order of this bound and a
query leaves a node whose bound is below its current k-th score.

That score is shared: each query is first searched in one shard only, and its k-th score
there, which at least k candidates reach, goes with it to all shards. Queries travel
in blocks, so the tree is descended once per block.

Defined results: vectors that are null or hold null, NaN or infinite components take
no part, neither do those of another length than most; ties go to the smaller id; copies of a query's own
id are other rows only if their vector differs. Null ids take no part.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import materialize

SCALE = 256
# Candidates of a shard, which one task holds; queries of a block; rows of a leaf.
SHARD_ROWS = 50_000
BLOCK_ROWS = 512
LEAF_ROWS = 256


def scaled(vector):
    """floor(SCALE * x) of each component, or null where one is missing or not finite."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    finite = ~F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(as_double, lambda x: F.floor(x * SCALE)))


class Node:
    __slots__ = ("centre", "radius", "rows", "children")

    def __init__(self, points, rows):
        mine = points[rows]
        self.centre = mine.mean(0)
        gaps = np.linalg.norm(mine - self.centre, axis=1)
        # Rounding must not make a bound too small.
        self.radius = float(gaps.max()) * (1 + 1e-9) + 1e-6
        self.rows, self.children = rows, ()
        if len(rows) <= LEAF_ROWS or self.radius <= 2e-6:
            return
        # Split between the farthest point and the point farthest from that.
        far = mine[gaps.argmax()]
        other = mine[np.linalg.norm(mine - far, axis=1).argmax()]
        side = mine @ (other - far)
        order = np.argsort(side, kind="stable")
        half = len(rows) // 2
        self.children = (Node(points, rows[order[:half]]), Node(points, rows[order[half:]]))


class Best:
    """The k best (score, id) of each query of a block."""

    def __init__(self, floors, k):
        n = len(floors)
        self.k, self.floors = k, floors.astype(np.float64)
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def least(self):
        """Scores below these cannot be among the k best."""
        return np.maximum(self.floors, self.scores[:, -1])

    def offer(self, queries, scores, ids):
        """`scores` and `ids` have a row per query; ids of -1 are no candidates."""
        scores = np.where(ids >= 0, scores, -np.inf)
        all_scores = np.concatenate([self.scores[queries], scores], axis=1)
        all_ids = np.concatenate([self.ids[queries], ids], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[queries] = np.take_along_axis(all_scores, order, 1)
        self.ids[queries] = np.take_along_axis(all_ids, order, 1)


def search(tree: Node, points, ids, query_ids, queries, floors, k) -> Best:
    """Best candidates of each query; `ids` has a row of ids per point, -1 where fewer."""
    best, lengths = Best(floors, k), np.linalg.norm(queries, axis=1)

    def bounds(node, some):
        bound = queries[some] @ node.centre + lengths[some] * node.radius
        return bound + 1e-6 + 1e-9 * np.abs(bound)

    some = np.arange(len(queries))
    queue, turn = [(0.0, 0, tree, some, bounds(tree, some))], 0
    while queue:
        _, _, node, some, bound = heapq.heappop(queue)
        open_ = bound >= best.least()[some]
        some = some[open_]
        if not len(some):
            continue
        for child in node.children:
            bound = bounds(child, some)
            turn += 1
            heapq.heappush(queue, (-float(bound.max()), turn, child, some, bound))
        if not node.children:
            products = np.rint(queries[some] @ points[node.rows].T)
            # Only the k best points of a leaf can matter, however many ids they have.
            top = min(k + 1, products.shape[1])
            first = np.partition(products, -top, axis=1)[:, -top]
            for i, q in enumerate(some):
                near = np.flatnonzero(products[i] >= max(first[i], best.least()[q]))
                mine = ids[node.rows[near]]
                score = np.repeat(products[i][near], mine.shape[1])
                mine = np.where(mine == query_ids[q], -1, mine).ravel()
                if len(mine):
                    best.offer(np.array([q]), score[None], mine[None])
    return best


def _shard(table: pa.Table, k) -> pa.Table:
    """Search all query blocks of a shard in its candidates."""
    is_query = np.array(table.column("is_query").to_pylist(), bool)
    rows = table.column("vector").combine_chunks()
    vectors = np.array(rows.values.to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), -1) if len(
        rows) else np.zeros((0, 1))
    mine = np.flatnonzero(~is_query)
    asked = np.flatnonzero(is_query)
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(mine) and len(asked):
        if np.abs(vectors).max() ** 2 * vectors.shape[1] >= 2**52:
            raise ValueError("inner products too large to be exact")
        keys = table.column("ids").to_pylist()
        ids = np.full((len(mine), k + 1), -1, np.int64)
        for i, at in enumerate(mine):
            ids[i, : len(keys[at])] = keys[at]
        query_ids = np.array(table.column("query_id").to_pylist(), object)
        floors = np.array([-np.inf if x is None else x for x in table.column("floor").to_pylist()], float)
        points = vectors[mine]
        tree = Node(points, np.arange(len(mine)))
        for start in range(0, len(asked), BLOCK_ROWS):
            block = asked[start : start + BLOCK_ROWS]
            numbers = query_ids[block].astype(np.int64)
            best = search(tree, points, ids, numbers, vectors[block], floors[block], k)
            found = np.isfinite(best.scores)
            out["query_id"].extend(np.repeat(numbers, found.sum(1)).tolist())
            out["vec_id"].extend(best.ids[found].tolist())
            out["score"].extend(best.scores[found].astype(np.int64).tolist())
    return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})


def _smallest_ids(batches, k):
    """Per task and vector the k + 1 smallest ids; the larger ones can be in no result."""
    held: dict[tuple, list] = {}

    def flush():
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.list_(pa.int64())), pa.array(list(held.values()), pa.list_(pa.int64()))],
                names=["vector", "ids"])
        held.clear()

    for batch in batches:
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            kept = held.setdefault(tuple(key), [])
            kept[:] = sorted({*kept, *ids})[: k + 1]
        if len(held) > 50_000:
            yield from flush()
    yield from flush()


def _best(found: DataFrame, k) -> DataFrame:
    """The k best of each query: every shard sends at most k of each."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("below"), "vec_id")))
    top = found.groupBy("query_id").agg(F.slice(listed, 1, k).alias("_top"))
    return top.select("query_id", F.posexplode("_top").alias("_at", "_row")).select(
        "query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_row.vec_id").alias("vec_id"),
        (-F.col("_row.below")).alias("score"))


def top_products(vectors: DataFrame, is_query, k=5, id_col="vec_id", vector_col="embedding",
                 shard_rows=SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows of each query row."""
    points = vectors.select(F.col(id_col).cast("bigint").alias("id"), scaled(F.col(vector_col)).alias("vector"))
    points = points.filter("vector is not null and id is not null and size(vector) > 0")
    lengths = points.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").limit(1).first()
    points = points.filter(F.size("vector") == (usual.length if usual else 0))
    queries = materialize(points.join(
        vectors.filter(is_query).select(F.col(id_col).cast("bigint").alias("id")).distinct(), "id", "left_semi"
    ).select(F.col("id").alias("query_id"), "vector").dropDuplicates(["query_id"]))

    def smallest(batches):
        return _smallest_ids(batches, k)

    schema = "vector array<long>, ids array<long>"
    local = points.select("vector", F.array("id").alias("ids")).mapInArrow(smallest, schema)
    # After the first pass a vector is at most one row per task.
    candidates = materialize(local.repartition("vector").mapInArrow(smallest, schema))
    shards = max(1, -(-candidates.count() // shard_rows))
    dealt = materialize(candidates.select(
        F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("is_query"),
        "vector", "ids", F.lit(None).cast("bigint").alias("query_id"), F.lit(None).cast("bigint").alias("floor")))

    def one(table: pa.Table) -> pa.Table:
        return _shard(table, k)

    def searched(asked):
        rows = asked.select("shard", F.lit(True).alias("is_query"), "vector",
                            F.lit(None).cast("array<long>").alias("ids"), "query_id", "floor")
        both = dealt.unionByName(rows)
        return both.groupBy("shard").applyInArrow(one, "query_id long, vec_id long, score long")

    home = F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int")
    first = materialize(searched(queries.withColumns({
        "shard": home, "floor": F.lit(None).cast("bigint")})))
    if shards == 1:
        return _best(first, k)
    floors = first.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    everywhere = queries.join(floors, "query_id", "left_outer").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    others = everywhere.filter(F.col("shard") != home)
    return _best(first.unionByName(searched(others)), k)
