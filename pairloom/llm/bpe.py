"""BPE encoding and decoding of vocabularies whose pieces mark the end of a word.

A word is a doubly linked list of symbols. A priority queue holds the merge rank of
each neighbouring pair; an entry whose symbols have changed meanwhile is stale and is
skipped when it comes up. Words repeat, so each worker remembers the ids of short ones.

Defined results: null and empty texts give no ids and an empty decoded text; special
strings in a text become their ids; repeated rows are encoded each; words of any
length are encoded whole (n log n); unknown symbols are left out, as the library does.
"""

import functools
import heapq
import itertools
import json
import re
import unicodedata
from array import array
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.batches import by_slices, id_lists

# Bound of the worker's memory: words up to this length, and twice so many of them.
CACHED_CHARS = 64
CACHE_ENTRIES = 150_000

ENCODED = "struct<ids:array<int>,decoded:string>"

# Blanks to `str.split` that are ordinary characters to the tokenizer.
_CONTROL = re.compile("[\x1c-\x1f]")
_RUST_BLANK = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the rest for 256, 257, ...
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class _Words(dict):
    """Remembers ids in two generations, so words in use outlive the rare ones."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode
        self._older = {}

    def __missing__(self, word):
        ids = self._older.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self._older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordBpe:
    """Encoder and decoder of one vocabulary file of the `tokenizers` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or spec["decoder"]:
            raise ValueError("expects a BPE vocabulary with an end-of-word suffix")
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if level["type"] != "ByteLevel" or level["use_regex"]:
            raise ValueError("expects words split by one pattern, then bytes")
        self.suffix = model["end_of_word_suffix"]
        self.vocab = model["vocab"]
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.strings = {i: s for s, i in (*self.vocab.items(), *special.items())}
        longest_first = sorted(special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, longest_first)) or "(?!)")
        self._find = regex.compile(split["pattern"]["Regex"]).findall
        # Ids of each byte inside a word and at its end; None where the vocabulary lacks it.
        self._inner = [self.vocab.get(s) for s in byte_symbols()]
        self._last = [self.vocab.get(s + self.suffix) for s in byte_symbols()]
        self._pieces = _Words(self._encode_piece)
        self.words = _Words(self._encode_word)

    def forget(self):
        """Drop the remembered words; results stay the same."""
        for held in (self._pieces, self.words):
            held.clear()
            held._older.clear()

    def _encode_piece(self, piece: str) -> bytes:
        *start, end = piece.encode()
        ids = [*map(self._inner.__getitem__, start), self._last[end]]
        return array("i", self.merge([i for i in ids if i is not None] if None in ids else ids)).tobytes()

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges in the order of their ranks, leftmost first."""
        size, rank_of, push = len(ids), self.ranks.get, heapq.heappush
        pairs = zip(ids, itertools.islice(ids, 1, None))
        queue = [(*found, at, pair) for at, pair in enumerate(pairs) if (found := rank_of(pair))]
        if not queue:
            return ids
        heapq.heapify(queue)
        before = list(range(-1, size))
        after = list(range(1, size + 1))
        while queue:
            _, merged, left, pair = heapq.heappop(queue)
            right = after[left]
            if right >= size or ids[left] != pair[0] or ids[right] != pair[1]:
                continue  # stale: one of the two was merged meanwhile
            ids[left], ids[right] = merged, -1
            after[left] = beyond = after[right]
            if beyond < size:
                before[beyond] = left
                pair = (merged, ids[beyond])
                if found := rank_of(pair):
                    push(queue, (*found, left, pair))
            ahead = before[left]
            if ahead >= 0:
                pair = (ids[ahead], merged)
                if found := rank_of(pair):
                    push(queue, (*found, ahead, pair))
        return [i for i in ids if i >= 0]

    def _encode_word(self, word: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self._find(word)))

    def _packed_plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        # The library lower-cases each character by itself, without a final sigma.
        text = text.replace("Σ", "σ").lower()
        split = _RUST_BLANK.split(text) if _CONTROL.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, split))

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers."""
        if not any(string in text for string in self.special):
            return self._packed_plain(text)
        found, start = [], 0
        for match in self._special.finditer(text):
            found.append(self._packed_plain(text[start : match.start()]))
            found.append(array("i", [self.special[match[0]]]).tobytes())
            start = match.end()
        found.append(self._packed_plain(text[start:]))
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids) -> str:
        """The vocabulary strings of the ids, one blank between them."""
        return " ".join(map(self.strings.__getitem__, ids))


@functools.lru_cache(maxsize=4)
def _coder(path: str) -> WordBpe:
    return WordBpe(path)


def encoded(text: Column, tokenizer: str) -> Column:
    """Ids of a text column."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        coder = _coder(tokenizer)
        return by_slices(texts, lambda part: id_lists([coder.packed(t) for t in part]))

    return encode(F.coalesce(text, F.lit("")))


def decoded(ids: Column, tokenizer: str) -> Column:
    """Text of a column of id lists; null ids give an empty text."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        coder = _coder(tokenizer)
        return by_slices(lists, lambda part: pa.array([coder.decode(x or ()) for x in part], pa.string()))

    return decode(ids)


def round_trip(docs: DataFrame, tokenizer: str, text="text", forget=False) -> DataFrame:
    """`docs` with the columns ids and decoded, made in one pass over the texts.

    With `forget`, a worker keeps no words after its task, for sessions with other stages to come.
    """

    def coded(part):
        coder = _coder(tokenizer)
        packed = [coder.packed(t) for t in part]
        ids = (np.frombuffer(p, np.int32).tolist() for p in packed)
        back = pa.array([coder.decode(i) for i in ids], pa.string())
        return pa.StructArray.from_arrays([id_lists(packed), back], ["ids", "decoded"])

    @F.arrow_udf(ENCODED)
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield by_slices(texts, coded)
        finally:
            if forget:
                _coder(tokenizer).forget()

    kept = docs.drop("ids", "decoded", "_coded")
    found = kept.withColumn("_coded", both(F.coalesce(F.col(text), F.lit(""))))
    return found.select(*kept.columns, "_coded.ids", "_coded.decoded")
