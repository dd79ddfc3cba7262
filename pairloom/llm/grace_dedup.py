"""Exact deduplication by Grace hashing over complete normalised contents.

Texts are equal when they are the same after blanks are deleted. Each task first
collapses the copies it sees in an open-addressing table, so a content that a third
of all rows share leaves a task as one row. What remains is partitioned by digest. In
each partition a second table compares complete contents; once it is full, contents
it does not hold go to spill files by further digest bits, and each file is
treated the same way after it.

Everything a task found is stored once in the shared folder, so later reads agree
also after executors are lost. Spill files are local to one task and end with it.

Defined results: a null text counts as empty; the row with the most code points
stays, then the smallest id (null last), then the first row stored; of repeated rows
one stays. Other columns are carried along by `keep_one`, whatever their names,
except the prefix `_dedup_`.
"""

import hashlib
import itertools
import os
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.shared import HOT_ROWS, meet_groups
from pairloom.session import materialize

# Bytes of distinct contents a table holds: in the first pass, and per partition.
LOCAL_BYTES = 48 << 20
TABLE_BYTES = 96 << 20
FANOUT = 8
BATCH_ROWS = 1000

_BLANKS = b" \t\n\x0b\x0c\r"
_ROW, _CHARS, _DIGEST, _ROWS = "_dedup_row", "_dedup_chars", "_dedup_digest", "_dedup_rows"
_ADDED = [
    T.StructField(_ROW, T.LongType()),
    T.StructField(_CHARS, T.LongType()),
    T.StructField(_DIGEST, T.BinaryType()),
    T.StructField(_ROWS, T.LongType()),
]


def normalised(text: bytes | None) -> bytes:
    return (text or b"").translate(None, _BLANKS)


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte.

    Contents stay in the rows that the table would keep: `content_at` gives that of a row,
    by the last two entries of its order.
    """

    def __init__(self, budget: int, content_at):
        self.budget, self.content_at = budget, content_at
        self.clear()

    def clear(self):
        self.slots = [-1] * 1024
        self.digests, self.best, self.rows, self.held = [], [], [], 0

    def _slot(self, digest: bytes, same) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (entry := self.slots[at]) >= 0 and not same(entry):
            at = (at + 1) & mask
        return at

    def _grow(self):
        self.slots = [-1] * (2 * len(self.slots))
        for entry, digest in enumerate(self.digests):
            self.slots[self._slot(digest, lambda _: False)] = entry

    def add(self, digest: bytes, content: bytes, order: tuple, rows: int) -> bool:
        """Count `rows` more of this content; False if it is new and does not fit.

        `order` starts with what decides which row stays; the least one is kept.
        """
        def same(entry):
            return self.digests[entry] == digest and self.content_at(*self.best[entry][4:]) == content

        at = self._slot(digest, same)
        entry = self.slots[at]
        if entry >= 0:
            self.rows[entry] += rows
            self.best[entry] = min(self.best[entry], order)
            return True
        if self.digests and self.held + len(content) > self.budget:
            return False
        self.slots[at] = len(self.digests)
        self.digests.append(digest)
        self.best.append(order)
        self.rows.append(rows)
        self.held += len(content) + 200
        if 2 * len(self.digests) > len(self.slots):
            self._grow()
        return True


def _joined(batches, rows=BATCH_ROWS):
    """Neighbouring batches as one, as long as they have no more than `rows` rows."""
    some, held = [], 0
    for batch in batches:
        if some and held + batch.num_rows > rows:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()
            some, held = [], 0
        some.append(batch)
        held += batch.num_rows
    if some:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches()


class _Winners:
    """A content table with the batches that hold the rows it would keep."""

    def __init__(self, budget: int, text_col: str):
        self.table = ContentTable(budget, self._content)
        self.text_col = text_col
        self.batches: list[pa.RecordBatch] = []

    def _content(self, batch: int, row: int) -> bytes:
        text = self.batches[batch].column(self.text_col)[row].as_buffer()
        return normalised(text and text.to_pybytes())

    def add(self, batch: pa.RecordBatch, id_col: str):
        """Row numbers of the batch whose contents did not fit."""
        left, held = [], len(self.batches)
        self.batches.append(batch)
        texts = batch.column(self.text_col).cast(pa.binary())
        columns = [batch.column(c).to_pylist() for c in (_DIGEST, _CHARS, id_col, _ROW, _ROWS)]
        for i, (text, digest, chars, key, row, rows) in enumerate(zip(texts, *columns)):
            order = (-chars, key is None, key or 0, row, held, i)
            if not self.table.add(digest, normalised(text.as_py()), order, rows):
                left.append(i)
        self._compact()
        return left

    def _compact(self):
        # Batches hold rows that lost meanwhile; keep only the rows still needed.
        total = sum(b.num_rows for b in self.batches)
        if len(self.batches) > 1 and total > 2 * len(self.table.best) + 1000:
            entries = self._by_place()
            self.batches = list(_joined(self._taken(entries)))
            places = ((b, i) for b, x in enumerate(self.batches) for i in range(x.num_rows))
            for entry, place in zip(entries, places):
                self.table.best[entry] = (*self.table.best[entry][:4], *place)

    def _by_place(self):
        best = self.table.best
        return sorted(range(len(best)), key=lambda entry: best[entry][4:])

    def _taken(self, entries):
        """The rows of these entries, which are in the order of their places; batches go on the way."""
        for at, group in itertools.groupby(entries, lambda entry: self.table.best[entry][4]):
            rows = pa.array([self.table.best[entry][5] for entry in group], pa.int64())
            yield self.batches[at].take(rows)
            self.batches[at] = None

    def flush(self):
        """The best row of each content, with the number of rows it stands for."""
        entries, done = self._by_place(), 0
        for rows in _joined(self._taken(entries)):
            counts = [self.table.rows[entry] for entry in entries[done : done + rows.num_rows]]
            done += rows.num_rows
            at = rows.schema.get_field_index(_ROWS)
            yield rows.set_column(at, _ROWS, pa.array(counts, pa.int64()))
        self.table.clear()
        self.batches = []


def _collapse(batches, id_col, text_col, budget):
    """All rows without their other columns, and the best rows of what a task saw."""
    winners = _Winners(budget, text_col)
    base = TaskContext.get().partitionId() << 40
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            size = part.num_rows
            texts = part.column(text_col).cast(pa.binary())
            digests = [hashlib.sha256(normalised(t.as_py())).digest() for t in texts]
            chars = pc.fill_null(pc.utf8_length(part.column(text_col)), 0).cast(pa.int64())
            added = [
                pa.array(range(base, base + size), pa.int64()), chars,
                pa.array(digests, pa.binary()), pa.array([1] * size, pa.int64()),
            ]
            base += size
            names = [*part.schema.names, _ROW, _CHARS, _DIGEST, _ROWS]
            full = pa.RecordBatch.from_arrays([*part.columns, *added], names=names)
            bare = [c if n == id_col else pa.nulls(size, c.type)
                    for n, c in zip(part.schema.names, part.columns)]
            added[3] = pa.nulls(size, pa.int64())
            yield pa.RecordBatch.from_arrays([*bare, *added], names=names)
            left = winners.add(full, id_col)
            if left:
                yield from winners.flush()
                # An empty table takes any content, so each turn gets further.
                while left:
                    full = full.take(pa.array(left))
                    left = winners.add(full, id_col)
                    if left:
                        yield from winners.flush()
    yield from winners.flush()


def _spill_name(folder, level, part):
    return os.path.join(folder, f"{level}-{part}.arrow")


def _grace(batches, id_col, text_col, budget, level=0):
    """One row per content; contents that do not fit go through spill files."""
    winners = _Winners(budget, text_col)
    with tempfile.TemporaryDirectory(prefix="dedup-") as folder:
        writers = {}
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                left = winners.add(batch, id_col)
                if not left:
                    continue
                digests = batch.column(_DIGEST)
                parts: dict[int, list[int]] = {}
                for i in left:
                    # Digest bytes beyond the ones that chose the partition and slot.
                    byte = digests[i].as_py()[8 + level % 24]
                    parts.setdefault(byte % FANOUT, []).append(i)
                for part, rows in parts.items():
                    if part not in writers:
                        path = _spill_name(folder, level, part)
                        writers[part] = pa.ipc.new_stream(path, batch.schema)
                    writers[part].write_batch(batch.take(pa.array(rows)))
        yield from winners.flush()
        for part, writer in writers.items():
            writer.close()
            path = _spill_name(folder, level, part)
            with pa.ipc.open_stream(path) as reader:
                yield from _grace(reader, id_col, text_col, budget, level + 1)
            os.remove(path)


def _stored(docs: DataFrame, id_col, text_col, budget) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, *_ADDED])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    def collapse(batches):
        return _collapse(batches, id_col, text_col, budget)

    return materialize(docs.mapInArrow(collapse, schema))


def _kept(stored: DataFrame, id_col, text_col, budget) -> DataFrame:
    def grace(batches):
        return _grace(batches, id_col, text_col, budget)

    contents = stored.filter(F.col(_ROWS).isNotNull()).repartition(F.col(_DIGEST))
    return contents.mapInArrow(grace, stored.schema)


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text",
             local_bytes=LOCAL_BYTES, table_bytes=TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns."""
    stored = _stored(docs, id_col, text_col, local_bytes)
    return _kept(stored, id_col, text_col, table_bytes).select(*docs.columns)


def copy_groups(docs: DataFrame, id_col="doc_id", text_col="text", hot_rows=HOT_ROWS,
                local_bytes=LOCAL_BYTES, table_bytes=TABLE_BYTES) -> DataFrame:
    """Every row: its id, keep_id, group_size, kept, text_sha256."""
    stored = _stored(docs.select(id_col, text_col), id_col, text_col, local_bytes)
    groups = materialize(_kept(stored, id_col, text_col, table_bytes).select(
        _DIGEST,
        F.col(id_col).alias("keep_id"),
        F.col(_ROW).alias("_dedup_keep"),
        F.col(_ROWS).alias("group_size"),
    ))
    members = stored.filter(F.col(_ROWS).isNull()).select(id_col, _ROW, _DIGEST)
    joined = meet_groups(members, groups, _DIGEST, "group_size", hot_rows)
    return joined.select(
        id_col,
        "keep_id",
        "group_size",
        (F.col(_ROW) == F.col("_dedup_keep")).alias("kept"),
        F.lower(F.hex(_DIGEST)).alias("text_sha256"),
    )
