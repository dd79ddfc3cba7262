"""Arrow batches of texts to lists of token ids, a slice at a time."""

import contextlib
import gc

import numpy as np
import pyarrow as pa

# Rows whose ids are Python objects at the same time.
SLICE_ROWS = 50
# Batches of texts between Spark and its Python workers; both sides hold whole ones.
BATCH_BYTES = 4 << 20
# Rows that the Parquet reader decodes at once, each column into one array that doubles as it grows.
READ_ROWS = 512


def small_batches(spark) -> None:
    """Ask for Arrow batches of at most BATCH_BYTES and for READ_ROWS rows a read in what follows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """Lists of ids from their bytes as 32-bit integers."""
    ends = np.cumsum([0, *map(len, packed)], dtype=np.int64) // 4
    flat = np.frombuffer(b"".join(packed), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


@contextlib.contextmanager
def _without_collector():
    """Many small objects without cycles: looking for cycles takes a third of the time."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


def by_slices(values: pa.Array, make) -> pa.Array:
    """Apply `make` to slices of a batch, so that only one is held as objects."""
    with _without_collector():
        parts = [make(values.slice(at, SLICE_ROWS).to_pylist()) for at in range(0, len(values), SLICE_ROWS)]
        return pa.concat_arrays(parts) if parts else make([])
