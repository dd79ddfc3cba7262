"""Elias-Fano coded monotone sequences over memory-mapped arrays, queried in bulk.

A value is cut into low bits, stored packed, and a high part, stored in unary: bit
`high + index` is set. Zeros then mark where each high part begins. The number of ones
before each word of 64 bits makes both kinds of selection fast; a sequence holds up to
2^32 values.
"""

import os

import numpy as np

SLICE = 1 << 16
# Place of the k-th set bit of a byte.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_PLACE = np.argsort(1 - _BITS, axis=1, kind="stable").astype(np.uint8)
# Masks of every second bit, every second pair, every second four, the first and the top bit of each byte.
_PAIRS, _QUADS, _BYTES, _EACH, _TOPS = (
    np.uint64(byte * 0x0101010101010101) for byte in (0x55, 0x33, 0x0F, 0x01, 0x80))


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of a non-decreasing sequence of numbers below `universe`."""
    n = len(values)
    low_bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
    n_bits = n + (universe >> low_bits) + 2
    high = np.zeros(-(-n_bits // 64), np.uint64)
    low = np.zeros(-(-n * low_bits // 64) + 2, np.uint64)
    # In slices, as each value takes several numbers on its way.
    for begin in range(0, n, SLICE):
        some = np.asarray(values[begin : begin + SLICE], np.uint64)
        index = np.arange(begin, begin + len(some))
        at = (some >> np.uint64(low_bits)).astype(np.int64) + index
        np.bitwise_or.at(high, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        if not low_bits:
            continue
        part = some & np.uint64((1 << low_bits) - 1)
        offset = index * low_bits
        shift = (offset & 63).astype(np.uint64)
        np.bitwise_or.at(low, offset >> 6, part << shift)
        over = shift + np.uint64(low_bits) > 64
        np.bitwise_or.at(low, (offset[over] >> 6) + 1, part[over] >> (np.uint64(64) - shift[over]))
    ones = np.cumsum(np.bitwise_count(high), dtype=np.int64)
    before = np.append(0, ones).astype(np.uint32)
    return {"high": high, "low": low, "before": before, "shape": np.array([n, low_bits], np.int64)}


class EliasFano:
    def __init__(self, high, low, before, shape):
        self.high, self.low, self.before = high, low, before
        self.n, self.low_bits = (int(x) for x in shape)
        self.zeros = np.arange(len(before), dtype=np.int64) * 64 - before

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Bit positions of the set (or clear) bits with these ranks, from 0."""
        # In slices that stay in the processor's cache.
        parts = [self._select_some(rank[i : i + SLICE], ones) for i in range(0, len(rank), SLICE)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _select_some(self, rank, ones):
        counts = self.before if ones else self.zeros
        word = np.searchsorted(counts, rank.astype(counts.dtype), "right") - 1
        rest = (rank - counts[word]).astype(np.uint64)
        bits = self.high[word]
        if not ones:
            bits = ~bits
        # Set bits up to and with each byte of the word, all eight in one number.
        upto = bits - ((bits >> np.uint64(1)) & _PAIRS)
        upto = (upto & _QUADS) + ((upto >> np.uint64(2)) & _QUADS)
        upto = ((upto + (upto >> np.uint64(4))) & _BYTES) * _EACH
        # The top bit of each byte tells whether the place is beyond it.
        beyond = ((rest * _EACH | _TOPS) - upto) & _TOPS
        shift = np.bitwise_count(beyond).astype(np.uint64) << np.uint64(3)
        rest -= ((upto << np.uint64(8)) >> shift) & np.uint64(255)
        octet = (bits >> shift) & np.uint64(255)
        return word * 64 + shift.astype(np.int64) + _PLACE[octet, rest]

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.int64)
        offset = index * self.low_bits
        shift = (offset & 63).astype(np.uint64)
        first = self.low[offset >> 6] >> shift
        # A shift by 64 is undefined, so the second word is shifted in two steps.
        second = (self.low[(offset >> 6) + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return ((first | second) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def access(self, index: np.ndarray) -> np.ndarray:
        """Values at these places."""
        high = self._select(index, True) - index
        return (high << self.low_bits) | self._low(index)

    def _begin(self, high: np.ndarray) -> np.ndarray:
        """Number of values whose high part is below `high`."""
        found = np.zeros(len(high), np.int64)
        some = high > 0
        found[some] = self._select(high[some] - 1, False) - (high[some] - 1)
        return found

    def successor(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of the first value not below each given one, between begin and end."""
        high = values >> self.low_bits
        low = values & ((1 << self.low_bits) - 1)
        left = np.maximum(begin, self._begin(high))
        right = np.maximum(left, np.minimum(end, self._begin(high + 1)))
        active = np.flatnonzero(left < right)
        while len(active):
            middle = (left[active] + right[active]) >> 1
            below = self._low(middle) < low[active]
            left[active[below]] = middle[below] + 1
            right[active[~below]] = middle[~below]
            active = active[left[active] < right[active]]
        return left


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays so that a repeated or parallel attempt leaves the same whole files."""
    for key, array in arrays.items():
        path = os.path.join(folder, f"{name}.{key}.npy")
        part = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
        with open(part, "wb") as file:
            np.save(file, array)
        os.replace(part, path)


def load(folder: str, name: str, keys) -> dict[str, np.ndarray]:
    return {k: np.load(os.path.join(folder, f"{name}.{k}.npy"), mmap_mode="r") for k in keys}


def load_sequence(folder: str, name: str) -> EliasFano:
    return EliasFano(**load(folder, name, ("high", "low", "before", "shape")))
