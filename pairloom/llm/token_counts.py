"""Token counts: a tokenizer's lengths, computed in Arrow batches, ids never leave.

Texts are cut where the tokenizer itself always cuts (before a blank that follows
a non-blank), so the counts of the pieces add up to the count of the text. Each
worker remembers the lengths of short pieces and hands the library only new ones, in
batches of about equal bytes.

Defined results: null and empty texts count 0; repeated rows are counted each; a text
without blanks is one piece of any length; other columns are carried along.
"""

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 256 * 1024
# Pieces up to this length are remembered; both bound the worker's memory.
CACHED_CHARS = 48
CACHE_ENTRIES = 1_500_000

_BLANK_PAIR = re.compile(r"\s ")
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")


def safe_pieces(text: str) -> list[str]:
    """Cut before each blank that follows a non-blank; joined, they are the text."""
    if not text.startswith(" ") and not _BLANK_PAIR.search(text):
        first, *rest = text.split(" ")
        return [first, *[" " + part for part in rest]]
    return _SAFE_CUT.split(text)


def byte_batches(texts, limit=BATCH_BYTES):
    """Lists of texts of about `limit` bytes; a longer text is a list of its own."""
    batch, held = [], 0
    for text in texts:
        size = len(text.encode())
        if batch and held + size > limit:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += size
    if batch:
        yield batch


class LengthCounter:
    """Counts tokens with the library of the file: `.json` or `.model`."""

    def __init__(self, path: str):
        self.lengths: dict[str, int] = {}
        self.cuts = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._batch = lambda texts: map(len, model.encode(texts, num_threads=1))
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._batch = lambda texts: map(
            len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        )
        self._encode = lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec.get("pre_tokenizer") or {}
        # Only this way of splitting is known to cut at every blank.
        self.cuts = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space", True)
            and spec.get("normalizer") is None
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"]
                        for t in spec.get("added_tokens", []))
        )
        line_end = self._encode("\n x")
        self.cuts = self.cuts and len(line_end) > 1
        self.line_end = line_end[0]

    def _learn(self, pieces) -> None:
        """Lengths of new pieces that start with a blank or are a text's first piece.

        Pieces without line ends are encoded many at a time: a line end before a
        blank is always one token, so it marks where the next piece begins.
        """
        known = self.lengths
        # A mark right after a letter or digit is always cut off as a token of its own.
        marked = [p for p in pieces if p[-1:] in (",", ".") and p[-2:-1].isalnum()]
        pieces = {*pieces, *(p[:-1] for p in marked)}.difference(marked, known)
        lines = [p for p in pieces if p[:1] == " " and "\n" not in p and "<|" not in p]
        for batch in byte_batches(lines):
            ids = np.array(self._encode("\n".join(batch)))
            ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
            counts = np.diff(ends, prepend=-1) - 1
            if len(counts) != len(batch):
                raise ValueError("a line end inside a batch was not a token of its own")
            known.update(zip(batch, counts.tolist()))
        for batch in byte_batches(p for p in pieces if p not in known):
            known.update(zip(batch, self._batch(batch)))
        known.update([(p, known[p[:-1]] + 1) for p in marked])

    def count(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            found = []
            for batch in byte_batches(texts):
                found.extend(self._batch(batch))
            return found
        if len(self.lengths) > CACHE_ENTRIES:
            self.lengths.clear()
        counts = []
        for batch in byte_batches(texts, 16 * BATCH_BYTES):
            cut = [safe_pieces(text) for text in batch]
            known = self.lengths
            self._learn({p for pieces in cut for p in pieces if p not in known})
            get = known.__getitem__
            counts.extend(sum(map(get, pieces)) for pieces in cut)
            for long in {p for pieces in cut for p in pieces if len(p) > CACHED_CHARS}:
                del known[long]
        return counts


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> LengthCounter:
    return LengthCounter(path)


def token_count(text: Column, tokenizer: str) -> Column:
    """Number of tokens of a text column; null counts 0."""

    @F.arrow_udf("bigint")
    def lengths(texts: pa.Array) -> pa.Array:
        return pa.array(_counter(tokenizer).count(texts.to_pylist()), pa.int64())

    return lengths(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, tokenizer: str, text="text", limit=1024) -> DataFrame:
    """`docs` with n_bytes, n_tokens and over_limit; same-named columns are replaced."""
    counted = docs.withColumns({
        "n_bytes": F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint"),
        "n_tokens": token_count(F.col(text), tokenizer),
    })
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
