"""N-gram Jaccard join: classes of documents linked by shared word shingles.

Equal sets are one node. Each node has its sorted shingle hashes and a bitmap of
hashed bits sized to its set. The join finds the classes that all pairs at or above the threshold
make; pairs whose ends are in one component already are not verified, so the links it returns
join each class but are not all its pairs, and no number of links per document exists:

1. Order all shingles, rare before common. Two sets that reach the threshold share one
   among the first `n - ceil(t * n) + 1` of each, so a tile per such shingle holds all pairs.
   In the tile of the first one they share, their places in the order bound the overlap
   by what is left of each set; in every tile only pairs that this bound allows count.
2. A tile is sorted by set size and cut into size bands; in each band every node is a
   candidate with the band's first. Of a node's candidates the one that it shares most
   tiles with is verified, which already joins most large groups of near copies.
3. Then each tile gives a forest: of its pairs whose ends are in different components and
   whose bitmaps make a link likely, only those that join what the tile's earlier ones left
   apart, so fewer pairs than rows. Rounds of this go on as long as most of the pairs link.
   So a large group of near copies becomes one component by links that grow with its rows.
4. Then all pairs of a tile that are not yet in one component. No pair is verified twice.

The bitmaps of a pair bound the overlap from above: a bit that only one side has is a shingle
only that side has. Pairs that pass are verified by intersecting the sorted hashes.

How common a shingle is comes from a sketch of fixed size that counts those of all
sets; any order is right, this one keeps tiles small. Tiles too large for one task
are split into blocks that meet pairwise, so no pair is lost.

Defined results: A-Z count as a-z; a text of fewer words than a shingle is one
shingle; null, empty and blank texts have n_shingles 0, no links and their own id as
component; null ids never become a component's id. A row's linked_id is another row of the
same set, else one of a set it was verified to link with, else null. Shingles are compared by
48-bit hashes (64-bit for the counts), sets by a 64-bit hash and their size.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm import words
from pairloom.llm.shared import HOT_ROWS, components, meet_groups
from pairloom.session import materialize, scratch_path

SKETCH_BITS = 22
TILE_ROWS = 2048
# The links, and their share of the pairs tried, below which rounds end. These three change
# the work and no result.
LEAST_JOINED = 20
LEAST_SHARE = 0.5
# How much less of the overlap needed is likely enough in each further round.
LOOSER = 0.05
# A pair meets in many tiles; a task drops its copies among this many pairs.
PAIRS_HELD = 500_000
_CHUNK = 1 << 16
# Bytes of text hashed at once; arrays of a chunk take some fifty times as much.
TEXT_BYTES = 1 << 18
_FACTORS = words.numbers(64, 2)  # shingles have at most 64 words
_LENGTHS = words.numbers(64, 3)


def shingle_sets(data, bounds, size):
    """Sorted distinct 64-bit shingle hashes of each text of a chunk."""
    hashes, firsts, _ = words.split(data, bounds)
    counts = np.diff(firsts)
    windows = max(len(hashes) - size + 1, 0)
    summed = np.zeros(windows, np.uint64)
    for i in range(size):
        summed += hashes[i : i + windows] * _FACTORS[i]
    rolled = words.mix(summed)
    for first, count in zip(firsts.tolist(), counts.tolist()):
        if count >= size:
            yield np.unique(rolled[first : first + count - size + 1])
        elif count:
            short = (hashes[first : first + count] * _FACTORS[:count]).sum(dtype=np.uint64, keepdims=True)
            yield words.mix(short + _LENGTHS[count])
        else:
            yield np.zeros(0, np.uint64)


def pack(hashes: np.ndarray) -> bytes:
    """The top 48 bits of each hash, six bytes apiece, in the same order."""
    top = (hashes >> np.uint64(16)).astype("<u8")
    return top.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    raw = np.zeros((len(packed) // 6, 8), np.uint8)
    raw[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return raw.view("<u8").ravel()


def bitmap(hashes: np.ndarray) -> bytes:
    """One bit per hash in a power of two of at least twice as many bits."""
    bits = max(64, 1 << int(2 * len(hashes) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(hashes >> np.uint64(16)) & np.uint64(bits - 1)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _folded(maps: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) brought to `size` bytes; a set bit stays set."""
    while maps.shape[-1] > size:
        half = maps.shape[-1] // 2
        maps = maps[..., :half] | maps[..., half:]
    return maps


def overlap_bound(n_a, map_a: np.ndarray, n_b, map_b: np.ndarray):
    """No pair of sets with these sizes and bitmaps can share more than this."""
    size = min(map_a.shape[-1], map_b.shape[-1])
    map_a, map_b = _folded(map_a, size), _folded(map_b, size)
    only_a = np.bitwise_count(map_a & ~map_b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(map_b & ~map_a).sum(-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def likely_overlap(n_a, map_a: np.ndarray, n_b, maps: np.ndarray):
    """What a set most likely shares with each of others, by the bits that both have by chance."""
    size = min(map_a.shape[-1], maps.shape[-1])
    map_a, maps = _folded(map_a, size), _folded(maps, size)
    set_a = np.bitwise_count(map_a).sum(dtype=np.int64)
    set_b = np.bitwise_count(maps).sum(-1, dtype=np.int64)
    both = np.bitwise_count(map_a & maps).sum(-1, dtype=np.int64)
    free_a, free_b = (np.maximum(1 - s / (8 * size), 1e-6) for s in (set_a, set_b))
    by_a = n_a * (1 - (1 - both / set_a) / free_b)
    by_b = n_b * (1 - (1 - both / set_b) / free_a)
    return (by_a + by_b) / 2


def needed(n_a, n_b, percent):
    """Least overlap at which 100 * intersection >= percent * union."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def _set_rows(batches, size):
    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        for rows, data, bounds in words.chunks(batch.column(2), TEXT_BYTES):
            sets = list(shingle_sets(data, bounds, size))
            nodes = [int(words.mix(s).sum(dtype=np.uint64)) for s in sets]
            yield pa.RecordBatch.from_arrays([
                ids[rows],
                keys[rows],
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([pack(s) for s in sets], pa.binary()),
                pa.array([bitmap(s) for s in sets], pa.binary()),
            ], names=["id", "key", "node", "n", "hashes", "bits"])


def _first_of_each(batches):
    """Of rows sorted by node, the first of each node."""
    last = None
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        if not len(nodes):
            continue
        new = np.append(nodes[0] != last, nodes[1:] != nodes[:-1])
        last = nodes[-1]
        yield batch.filter(pa.array(new))


def _sketch(batches):
    counts = np.zeros(1 << SKETCH_BITS, np.int32)
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            buckets = unpack(packed) >> np.uint64(48 - SKETCH_BITS)
            np.add.at(counts, buckets.astype(np.int64), 1)
    for at in range(0, len(counts), _CHUNK):
        part = counts[at : at + _CHUNK]
        if part.any():
            # Counts of one task are small, so they compress well.
            small = zlib.compress(part.tobytes(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([small], pa.binary())], names=["at", "counts"])


def _sketch_sum(table: pa.Table) -> pa.Table:
    total = np.zeros(_CHUNK, np.int64)
    for part in table.column("counts").to_pylist():
        total += np.frombuffer(zlib.decompress(part), np.int32)
    packed = zlib.compress(total.tobytes(), 1)
    return pa.table({"at": [table.column("at")[0].as_py()], "counts": [packed]})


def shingle_levels(sets: DataFrame) -> np.ndarray:
    """Per bucket of the sketch, how far it is above an even share: 0 for as usual."""
    parts = sets.select("hashes").mapInArrow(_sketch, "at long, counts binary")
    # The table has a fixed number of rows and bytes, whatever the input.
    rows = parts.groupBy("at").applyInArrow(_sketch_sum, "at long, counts binary").collect()
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in rows:
        counts[row.at : row.at + _CHUNK] = np.frombuffer(zlib.decompress(row.counts), np.int64)
    mean = counts.mean()
    usual = 4 * np.sqrt(mean) + 2
    above = np.maximum((counts - mean) / usual, 1.0)
    return np.ceil(2 * np.log2(above)).astype(np.uint8)


def _tile_rows(batches, levels, percent):
    for batch in batches:
        nodes, sizes = (batch.column(i).to_numpy() for i in (0, 1))
        tokens, places = [], []
        for packed in batch.column(2).to_pylist():
            hashes = unpack(packed)
            n = len(hashes)
            prefix = n - -(-percent * n // 100) + 1
            level = levels[(hashes >> np.uint64(48 - SKETCH_BITS)).astype(np.int64)]
            # The hashes are sorted, so rare ones come first, and equal levels by hash.
            ordered = hashes[np.argsort(level, kind="stable")[:prefix]]
            tokens.append(ordered.view(np.int64))
            places.append(np.arange(len(ordered)))
        if tokens:
            counts = [len(t) for t in tokens]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(tokens)), pa.array(np.repeat(nodes, counts)),
                pa.array(np.repeat(sizes, counts)), pa.array(np.concatenate(places)),
            ], names=["token", "node", "n", "place"])


def _first_pairs(batches, percent):
    """Of tiles sorted by size: pairs with the first of a size band, and crowded tiles.

    A pair is (a, b, times); a row of a tile of more than two is (token, node, n, place).
    """
    token, open_rows = None, []

    def emit(pairs, crowded):
        if len(pairs):
            pairs, times = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
            null = pa.nulls(len(times), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [null, null, null, null, *(pa.array(np.ascontiguousarray(c)) for c in pairs.T), pa.array(times)],
                names=["token", "node", "n", "place", "a", "b", "times"])
        if len(crowded):
            rows = np.concatenate(crowded)
            null = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.ascontiguousarray(c)) for c in rows.T), null, null, null],
                names=["token", "node", "n", "place", "a", "b", "times"])

    leader, lead_n, lead_left, count, held = None, 0, 0, 0, None
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
        if not len(rows):
            continue
        # A token that stands alone, here and at the edges of the batch, is no tile.
        same = rows[1:, 0] == rows[:-1, 0]
        useful = np.append(same, True) | np.append(True, same)
        pairs, crowded = [], []
        for row in rows[useful].tolist():
            if row[0] != token:
                token, leader, lead_n, lead_left, count = row[0], row[1], row[2], row[2] - row[3], 1
                held = [row]
                continue
            count += 1
            if count == 3:
                crowded.extend([*held, row])
            elif count > 3:
                crowded.append(row)
            else:
                held.append(row)
            if percent * row[2] > 100 * lead_n:
                leader, lead_n, lead_left = row[1], row[2], row[2] - row[3]
            elif min(lead_left, row[2] - row[3]) >= needed(lead_n, row[2], percent):
                pairs.append((leader, row[1]))
        yield from emit([np.array(pairs)] if pairs else [], [np.array(crowded)] if crowded else [])


def _tile_pairs(batches, percent, turn=None):
    """Pairs (a, b) of different components in a tile whose places and bitmaps allow the overlap.

    With a `turn`, only a forest of those that likely link, less likely ones each turn: a row meets
    the likeliest member of each component that it reaches, and then counts as one component
    with all of these.

    Rows come sorted by (token, block_a, block_b, n, node). In the tile of a block with itself all
    pairs count, in that of two blocks those across.
    """
    def pairs(rows):
        node, n, place, comp, side = (np.array(c, np.int64) for c in zip(*(r[:5] for r in rows)))
        if (comp == comp[0]).all():
            return
        left = n - place
        maps = [np.frombuffer(r[5], np.uint8) for r in rows]
        widths = np.array([len(m) for m in maps])
        ready = {}
        stops = np.searchsorted(n, 100 * n // percent, "right")
        for i in range(len(rows) - 1):
            others = np.arange(i + 1, stops[i])
            others = others[comp[others] != comp[i]]
            allowed = np.minimum(left[i], left[others]) >= needed(n[i], n[others], percent)
            others = others[allowed]
            if side[i] >= 0:
                others = others[side[others] != side[i]]
            if not len(others):
                continue
            passing, likely = [], []
            for width in np.unique(widths[others]):
                some = others[widths[others] == width]
                if width not in ready:
                    where = np.flatnonzero(widths == width)
                    places = np.full(len(rows), -1)
                    places[where] = np.arange(len(where))
                    ready[width] = places, np.stack([maps[j] for j in where])
                places, stacked = ready[width]
                bound = overlap_bound(n[i], maps[i], n[some], stacked[places[some]])
                some = some[bound >= needed(n[i], n[some], percent)]
                if turn is not None and len(some):
                    share = likely_overlap(n[i], maps[i], n[some], stacked[places[some]])
                    share /= needed(n[i], n[some], percent)
                    some = some[share >= 1 - LOOSER * turn]
                    likely.append(share[share >= 1 - LOOSER * turn])
                passing.append(some)
            met = np.concatenate(passing)
            if turn is not None and len(met):
                met = met[np.argsort(-np.concatenate(likely), kind="stable")]
                reached, first = np.unique(comp[met], return_index=True)
                met = met[first]
                comp[np.isin(comp, reached)] = comp[i]
            yield np.stack([np.minimum(node[i], node[met]), np.maximum(node[i], node[met])], axis=1)

    def batch_of(found):
        columns = np.unique(np.concatenate(found), axis=0).T
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c)) for c in columns], names=["a", "b"])

    key, rows, found, held = None, [], [], 0

    def close():
        nonlocal held
        if len(rows) > 1:
            for some in pairs(rows):
                found.append(some)
                held += len(some)
                if held > PAIRS_HELD:
                    yield batch_of(found)
                    found.clear()
                    held = 0

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for token, block_a, block_b, block, *row in zip(*columns):
            if (token, block_a, block_b) != key:
                yield from close()
                key, rows = (token, block_a, block_b), []
            # Within one block all pairs count; between two, only those across.
            rows.append((*row[:4], -1 if block_a == block_b else block, *row[4:]))
    yield from close()
    if found:
        yield batch_of(found)


@F.arrow_udf(T.BooleanType())
def _passes(n_a: pa.Array, map_a: pa.Array, n_b: pa.Array, map_b: pa.Array, percent: pa.Array) -> pa.Array:
    rows = zip(n_a.to_pylist(), map_a.to_pylist(), n_b.to_pylist(), map_b.to_pylist(), percent.to_pylist())
    return pa.array([
        bool(overlap_bound(a, np.frombuffer(x, np.uint8), b, np.frombuffer(y, np.uint8)) >= needed(a, b, p))
        for a, x, b, y, p in rows], pa.bool_())


@F.arrow_udf(T.LongType())
def _overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array([
        len(np.intersect1d(unpack(a), unpack(b), assume_unique=True))
        for a, b in zip(left.to_pylist(), right.to_pylist())], pa.int64())


def _linked(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold, by their sorted hashes."""
    def side(name, *columns):
        return nodes.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))

    bounded = pairs.select("a", "b").join(side("a", "n", "bits"), "a").join(side("b", "n", "bits"), "b")
    passing = materialize(bounded.filter(
        _passes("n_a", "bits_a", "n_b", "bits_b", F.lit(percent))).select("a", "b", "n_a", "n_b"))
    both = passing.join(side("b", "hashes"), "b").join(side("a", "hashes"), "a")
    shared = both.select("a", "b", "n_a", "n_b", _overlap("hashes_a", "hashes_b").alias("shared"))
    enough = 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    return materialize(shared.filter(enough).select("a", "b"))


def shingle_nodes(docs: DataFrame, id_col, text_col, size, key=None):
    """Stored (id, key, node, n) of every row, and one row per distinct set, bucketed by node."""
    spark = docs.sparkSession
    key = F.lit(0).cast("bigint") if key is None else key
    columns = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text"))
    id_type, key_type = (columns.schema[c].dataType.simpleString() for c in ("id", "key"))

    def rows(batches):
        return _set_rows(batches, size)

    sets = columns.mapInArrow(rows, f"id {id_type}, key {key_type}, node long, n long, hashes binary, bits binary")
    members = materialize(sets.select("id", "key", "node", "n"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = sets.filter("n > 0").select("node", "n", "hashes", "bits")
    unique = kept.repartition(buckets, "node").sortWithinPartitions("node", "n")
    unique = unique.mapInArrow(_first_of_each, kept.schema)
    path = scratch_path(spark, "shingle-sets")
    name = "shingle_sets_" + path[-12:]
    # Later joins by node then move the pairs only, never the sets.
    (unique.write.bucketBy(buckets, "node").option("path", path).saveAsTable(name))
    return members, spark.table(name)


def candidate_tiles(nodes: DataFrame, percent: int) -> DataFrame:
    levels = shingle_levels(nodes)

    def tiles(batches):
        return _tile_rows(batches, levels, percent)

    def pairs(batches):
        return _first_pairs(batches, percent)

    rows = nodes.select("node", "n", "hashes").mapInArrow(
        tiles, "token long, node long, n long, place long")
    placed = rows.repartition("token").sortWithinPartitions("token", "n", "node")
    return materialize(placed.mapInArrow(
        pairs, "token long, node long, n long, place long, a long, b long, times long"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components so far."""
    for name in ("a", "b"):
        root = roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
        pairs = pairs.join(root, name, "left_outer")
    return pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def links(nodes: DataFrame, percent=80, tile_rows=TILE_ROWS):
    """Verified links (a, b) that connect every class of linked nodes, and (node, root) of these."""
    tiles = candidate_tiles(nodes, percent)
    pairs = materialize(tiles.filter("a is not null").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "times"
    ).groupBy("a", "b").agg(F.sum("times").alias("times")))
    # The candidate that each node shares most tiles with.
    best = pairs.groupBy(F.col("b").alias("node")).agg(F.max_by("a", F.struct("times", "a")).alias("other"))
    tried = best.select(F.col("other").alias("a"), F.col("node").alias("b"))
    edges = _linked(tried, nodes, percent)
    roots = materialize(components(edges))

    def joined_by(more):
        # The roots stand for the links before.
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        return materialize(components(stars.unionByName(more)))

    crowded = tiles.filter("token is not null").select("token", "node", "n", "place")
    turn = 0
    while True:
        forest = _mixed_pairs(crowded, roots, nodes, percent, tile_rows, turn)
        fresh = materialize(forest.distinct().join(tried, ["a", "b"], "left_anti"))
        more = _linked(fresh, nodes, percent)
        joined = more.count()
        if joined:
            roots = joined_by(more)
        edges, tried = edges.unionByName(more), tried.unionByName(fresh)
        if joined < max(LEAST_JOINED, LEAST_SHARE * fresh.count()):
            break
        turn += 1
    inside = _mixed_pairs(crowded, roots, nodes, percent, tile_rows)
    rest = _apart(pairs, roots).unionByName(inside).distinct().join(tried, ["a", "b"], "left_anti")
    more = _linked(rest, nodes, percent)
    return edges.unionByName(more), joined_by(more)


def _mixed_pairs(crowded, roots, nodes, percent, tile_rows, turn=None) -> DataFrame:
    """Pairs of tiles that still hold several components, see `_tile_pairs`."""
    placed = crowded.join(roots, "node", "left_outer").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("token").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("rows"))
    mixed = materialize(mixed.filter("low <> high").select("token", "rows"))
    held = meet_groups(placed, mixed, "token", "rows")
    blocks = F.ceil(F.col("rows") / tile_rows).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    held = held.join(nodes.select("node", "bits"), "node").withColumn("block", block)
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(
        F.least("block", other).alias("block_a"), F.greatest("block", other).alias("block_b")))
    spread = held.withColumn("meet", F.explode(meets)).select(
        "token", "meet.block_a", "meet.block_b", "block", "node", "n", "place", "root", "bits")

    def within(batches):
        return _tile_pairs(batches, percent, turn)

    order = ["token", "block_a", "block_b", "n", "node"]
    return spread.repartition(*order[:3]).sortWithinPartitions(*order).mapInArrow(
        within, "a long, b long")


def jaccard_classes(docs: DataFrame, id_col="doc_id", text_col="text", size=5, percent=80,
                    tile_rows=TILE_ROWS, hot_rows=HOT_ROWS, key=None) -> DataFrame:
    """Every row's id, n_shingles, component_id and linked_id.

    With a `key`, an orderable column that tells rows apart, also the row's key and
    whether it stays when each class keeps one row: that of the least id (null last), then key.
    """
    members, nodes = shingle_nodes(docs, id_col, text_col, size, key)
    edges, roots = links(nodes, percent, tile_rows)
    smallest = members.filter("n > 0").groupBy("node", "n").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("least"),
        F.max("id").alias("greatest"),
        F.count(F.lit(1)).alias("rows"))
    rooted = materialize(smallest.join(roots, "node", "left_outer").withColumn(
        "root", F.coalesce("root", "node")))
    heads = materialize(rooted.groupBy("root").agg(
        F.min("least").alias("head"), F.count(F.lit(1)).alias("nodes")))
    # One verified neighbour of each node, by the least id of its set.
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).join(
        rooted.select(F.col("node").alias("b"), F.col("least.id").alias("beside")), "b").drop("b")
    labels = meet_groups(rooted.select("node", "root", "rows", "least", "greatest"), heads, "root", "nodes")
    labels = materialize(labels.join(beside, "node", "left_outer").select(
        "node", "rows", F.col("head.id").alias("component_id"), F.col("head.key").alias("head_key"),
        F.col("least.id").alias("least_id"), "greatest", "beside"))
    whole = meet_groups(members.filter("n > 0"), labels, "node", "rows", hot_rows)
    stays = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("head_key"))
    copy = F.when(~F.col("least_id").eqNullSafe(F.col("id")), F.col("least_id"))
    other = F.when(F.col("greatest") != F.col("id"), F.col("greatest"))
    whole = whole.withColumns({"stays": stays, "linked_id": F.coalesce(copy, "beside", other)})
    alone = members.filter("n = 0").withColumns({
        "component_id": F.col("id"), "stays": F.lit(True), "linked_id": F.lit(None).cast(members.schema["id"].dataType)})
    columns = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "linked_id"]
    if key is not None:
        columns += ["key", "stays"]
    return whole.select(columns).unionByName(alone.select(columns))


def keep_one_of_each(docs: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The rows of `docs` without all but one of each class; rows without words stay.

    Rows are told apart by 128 bits of their id and text. Of rows equal in both, one stays, with
    all its columns.
    """
    key = F.struct(F.xxhash64(id_col, text_col).alias("x"), F.xxhash64(F.lit(1), id_col, text_col).alias("y"))
    name = "_key"
    while name in map(str.lower, docs.columns):
        name += "_"
    classes = materialize(jaccard_classes(docs, id_col, text_col, key=key, **options))
    dropped = classes.filter(~F.col("stays")).select(F.col("key").alias(name))
    equal = classes.filter(F.col("stays") & (F.col("n_shingles") > 0)).groupBy(
        F.col("key").alias(name)).agg(F.count(F.lit(1)).alias("rows"))
    equal = materialize(equal.filter("rows > 1").select(name))
    same = key == F.col(name)
    kept = docs.join(dropped, same, "left_anti")
    # Combined before the shuffle, so a row that is repeated without end moves once per task.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    once = kept.join(equal, same, "left_semi").groupBy(key.alias(name)).agg(F.first(row).alias("row"))
    return kept.join(equal, same, "left_anti").unionByName(once.select("row.*"))
