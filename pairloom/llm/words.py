"""Words of whole Arrow batches as 64-bit hashes, in numpy.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return. Hashes do not depend on the process, so tasks agree on them.
"""

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_GOLDEN = 0x9E3779B97F4A7C15
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finish)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit numbers."""
    steps = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(_GOLDEN)
    return mix(steps)


# One number per byte; A-Z count as a-z, blanks as nothing.
_VALUES = numbers(256, 1)
_VALUES[0x41:0x5B] = _VALUES[0x61:0x7B]
_VALUES[_BLANK] = 0
_powers = np.cumprod(np.full(64, _MULTIPLIER))


def _powers_upto(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(2 * n, _MULTIPLIER))
    return _powers


def chunks(texts: pa.Array, limit=CHUNK_BYTES):
    """(rows, bytes, bounds) of slices of about `limit` bytes; bounds has rows + 1 entries."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield slice(start, end), data[bounds[start] : bounds[end]], bounds[start : end + 1] - bounds[start]
        start = end


def split(data: np.ndarray, bounds: np.ndarray):
    """(hash of each word, first word of each row with the end appended, byte starts)."""
    blank = _BLANK[data]
    first = ~blank
    first[1:] &= blank[:-1]
    row_starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[row_starts] = ~blank[row_starts]
    starts = np.flatnonzero(first)
    firsts = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), firsts, starts
    lengths = np.diff(starts, append=len(data))
    within = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = _powers_upto(int(lengths.max()) + 1)
    terms = _VALUES[data[starts[0] :]] * powers[within]
    return mix(np.add.reduceat(terms, starts - starts[0])), firsts, starts
