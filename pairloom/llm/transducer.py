"""Byte-level BPE as a lazily determinised transducer; decoding as a UTF-8 state machine.

A sequence of tokens is what BPE makes of its bytes exactly if the merges keep every two
neighbours apart. While a piece is read byte by byte, the encodings that may still come
form a tree: a node is a prefix of the piece with the last token of its encoding, which is
unique; it is open while a token from there may still end later. (This holds where earlier merges
make every token, which is checked.) This tree is the state of the
transducer. A byte moves every open node along the vocabulary's trie, adds the node of the
longer prefix and drops what leads to no open node. Tokens that all of the tree has in
common are emitted. A node is open for as many bytes as a token has at most, which bounds
the lookahead. States and transitions are built when a text first needs them and are
forgotten by generations when there are too many of them.

Defined results: null and empty texts give no ids and an empty decoded text; repeated rows
are encoded each; texts and pieces of any length are encoded whole, in time linear in their
bytes; special strings are ordinary text; null ids decode to an empty text, ids outside the
vocabulary are an error; bytes that are no UTF-8 decode to U+FFFD. Columns named ids or
decoded are replaced, all others are kept.
"""

import base64
import functools
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.batches import by_slices, id_lists, small_batches

# Bounds of a worker's memory: states with their transitions (twice so many, in generations), pairs of
# neighbours, remembered pieces (twice so many) and their length, steps of the decoder.
MAX_STATES = 120_000
MAX_PAIRS = 300_000
MAX_PIECES = 300_000
PIECE_CHARS = 24
MAX_STEPS = 200_000

CODED = "struct<ids:array<int>,decoded:string>"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 lines."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class _Node(dict):
    """A node of the vocabulary's trie: byte to (next node, the token that ends there or -1)."""

    __slots__ = ()
    # Nodes are told apart by identity.
    __hash__, __eq__ = object.__hash__, object.__eq__


class _State(dict):
    """Transitions by byte to (next state, tokens emitted).

    `leaves` holds (trie node, last token, tokens not yet emitted) of each open prefix, shorter
    ones first; the last one is all that has been read.
    """

    __slots__ = ("machine", "leaves")

    def __init__(self, machine, leaves):
        self.machine, self.leaves = machine, leaves

    def __missing__(self, byte):
        self[byte] = found = self.machine.step(self, byte)
        return found


class _Memory(dict):
    """Values of short keys in two generations, so those in use outlive the rare ones."""

    def __init__(self, make, most, longest):
        super().__init__()
        self._make, self._most, self._longest, self._older = make, most, longest, {}

    def __missing__(self, key):
        found = self._older.get(key)
        if found is None:
            found = self._make(key)
        if len(key) <= self._longest:
            if len(self) >= self._most:
                self._older = dict(self)
                self.clear()
            self[key] = found
        return found


# Values of a second byte that the first byte narrows down; others are 0x80 to 0xBF.
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def utf8_step(pending: bytes, byte: int) -> tuple[str, bytes]:
    """One step of the UTF-8 machine: the characters that end here, and the state after.

    The state is the begun character's bytes. A begun character that cannot go on, and a
    byte that cannot begin one, become U+FFFD.
    """
    if pending:
        low, high = _SECOND.get(pending[0], (0x80, 0xBF)) if len(pending) == 1 else (0x80, 0xBF)
        if not low <= byte <= high:
            text, state = utf8_step(b"", byte)
            return "\ufffd" + text, state
        pending += bytes([byte])
        if len(pending) == 2 + (pending[0] >= 0xE0) + (pending[0] >= 0xF0):
            return pending.decode(), b""
        return "", pending
    if byte < 0x80:
        return chr(byte), b""
    return ("", bytes([byte])) if 0xC2 <= byte <= 0xF4 else ("\ufffd", b"")


class Transducer:
    """Encoder and decoder of one rank file; texts are cut by `pattern` first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        if len(self.tokens) < len(ranks) or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("expects one rank per token and a token for every byte")
        self._find = regex.compile(pattern).findall
        self._after_all = max(self.tokens) + 1
        # The two parts whose merge makes a token.
        self._halves = {r: self.merge(t, r) for t, r in ranks.items() if len(t) > 1}
        unmade = [r for r, parts in self._halves.items() if len(parts) != 2 or max(parts) > r]
        if unmade:
            raise ValueError(f"tokens that no earlier merges make: {unmade[:5]}")
        self._root = self._plant(ranks)
        self._apart, self._steps, self._states, self._older = {}, {}, {}, {}
        # Text of tokens that lead the UTF-8 machine from its start back to it.
        steps = {token: self._decoder_step(b"", token) for token in self.tokens}
        self._whole = {token: text for token, (text, state) in steps.items() if not state}
        self._pieces = _Memory(self._encode_text_piece, MAX_PIECES, PIECE_CHARS)
        self._begin_states()

    @staticmethod
    def _plant(tokens: dict[bytes, int]) -> _Node:
        root = _Node()
        for token, rank in tokens.items():
            node = root
            for byte in token[:-1]:
                node = node.setdefault(byte, (_Node(), -1))[0]
            last = node.get(token[-1])
            node[token[-1]] = (last[0] if last else _Node(), rank)
        return root

    def merge(self, piece: bytes, below=None) -> list[int]:
        """BPE by its definition: the least rank first, leftmost among equals."""
        ranks = self.ranks
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            found = [r for r in pairs if r is not None and (below is None or r < below)]
            if not found:
                return [ranks[part] for part in parts]
            at = pairs.index(min(found))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges keep two neighbouring tokens apart.

        Takes the merges inside both back, the latest first. While two parts touch, their own
        merge must not come before the next merge that one of them takes part in; of equal
        ranks, the one further left comes first.
        """
        ranks, tokens, halves = self.ranks, self.tokens, self._halves
        joined_before = self._after_all
        while True:
            joined = ranks.get(tokens[left] + tokens[right])
            if joined is not None and joined < joined_before:
                return False
            of_left, of_right = halves.get(left), halves.get(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or of_left is not None and left > right:
                joined_before, left = left, of_left[1]
            else:
                joined_before, right = right + 1, of_right[0]

    def _state(self, leaves) -> _State:
        found = self._states.get(leaves)
        if found is None:
            if len(self._states) >= MAX_STATES:
                self._begin_states()
            found = self._states[leaves] = self._older.get(leaves) or _State(self, leaves)
        return found

    def _begin_states(self):
        """A new generation of states; those that it does not take over go with the one before."""
        for leaves, state in self._older.items():
            if self._states.get(leaves) is not state:
                state.clear()
        self._older, self._states = self._states, {}
        self._start = self._state(((self._root, -1, ()),))

    def step(self, state: _State, byte: int):
        """The state after one more byte, and the tokens that are certain by then."""
        known = self._apart
        leaves, longest = [], None
        for node, last, held in state.leaves:
            if byte not in node:
                continue
            children, token = node[byte]
            # The encoding is unique, so the other leaves need no look once it is found.
            if token >= 0 and longest is None:
                apart = known.get(last << 32 | token)
                if apart is None:
                    apart = self._kept_apart(last, token)
                if apart:
                    longest = (self._root, token, (*held, token))
            if children:
                leaves.append((children, last, held))
        if not longest:
            raise ValueError("these merges allow no encoding of a text")
        leaves.append(longest)
        certain = leaves[0][2]
        if not certain:
            return self._state(tuple(leaves)), ()
        # What the encodings of all open prefixes have in common is emitted.
        for _, _, held in leaves:
            if held[: len(certain)] != certain:
                same = [a == b for a, b in zip(certain, held)]
                certain = certain[: same.index(False) if False in same else len(same)]
        n = len(certain)
        return self._state(tuple([(node, last, held[n:]) for node, last, held in leaves])), certain

    def _kept_apart(self, left: int, right: int) -> bool:
        if len(self._apart) >= MAX_PAIRS:
            self._apart.clear()
        found = self._apart[left << 32 | right] = left < 0 or self.apart(left, right)
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        state, ids = self._start, []
        for byte in piece:
            state, emitted = state[byte]
            if emitted:
                ids += emitted
        return [*ids, *state.leaves[-1][2]]

    def _encode_text_piece(self, piece: str) -> bytes:
        return array("i", self.encode_piece(piece.encode())).tobytes()

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers."""
        return b"".join(map(self._pieces.__getitem__, self._find(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def _decoder_step(self, pending: bytes, token: int) -> tuple[str, bytes]:
        """The UTF-8 machine over the bytes of one token."""
        parts, state = [], pending
        for byte in self.tokens[token]:
            text, state = utf8_step(state, byte)
            parts.append(text)
        if len(self._steps) >= MAX_STEPS:
            self._steps.clear()
        found = self._steps[pending, token] = "".join(parts), state
        return found

    def decode_stream(self, ids):
        """Text of each token as soon as its characters are complete, then what is left."""
        state, known, whole = b"", self._steps, self._whole
        for token in ids:
            if not state and token in whole:
                yield whole[token]
                continue
            found = known.get((state, token))
            text, state = found if found is not None else self._decoder_step(state, token)
            yield text
        if state:
            yield "\ufffd"

    def decode(self, ids) -> str:
        try:
            return "".join(map(self._whole.__getitem__, ids))
        except KeyError:
            return "".join(self.decode_stream(ids))


@functools.lru_cache(maxsize=2)
def _machine(path: str, pattern: str) -> Transducer:
    return Transducer(read_ranks(path), pattern)


def encoded(text: Column, ranks: str, pattern: str) -> Column:
    """Ids of a text column."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        machine = _machine(ranks, pattern)
        return by_slices(texts, lambda part: id_lists([machine.packed(t) for t in part]))

    return encode(F.coalesce(text, F.lit("")))


def decoded(ids: Column, ranks: str, pattern: str) -> Column:
    """Text of a column of id lists."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        machine = _machine(ranks, pattern)
        return by_slices(lists, lambda part: pa.array([machine.decode(x or ()) for x in part], pa.string()))

    return decode(ids)


def round_trip(docs: DataFrame, ranks: str, pattern: str, text="text") -> DataFrame:
    """`docs` with the columns ids and decoded, made in one pass over the texts."""
    small_batches(docs.sparkSession)

    @F.arrow_udf(CODED)
    def both(texts: pa.Array) -> pa.Array:
        machine = _machine(ranks, pattern)

        def coded(part):
            packed = [machine.packed(t) for t in part]
            ids = (np.frombuffer(p, np.int32).tolist() for p in packed)
            back = pa.array([machine.decode(i) for i in ids], pa.string())
            return pa.StructArray.from_arrays([id_lists(packed), back], ["ids", "decoded"])

        return by_slices(texts, coded)

    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    coded = "_coded" + "_" * max(map(len, docs.columns))
    found = docs.withColumn(coded, both(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return found.select(*[f"`{c}`" for c in kept], f"{coded}.ids", f"{coded}.decoded")
