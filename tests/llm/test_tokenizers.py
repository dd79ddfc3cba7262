import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.llm.bpe import WordBpe, decoded, encoded, round_trip
from pairloom.llm.queries import bpe_round_trip, token_lengths
from pairloom.llm.token_counts import LengthCounter, byte_batches, count_tokens, safe_pieces

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
DATA = "/root/testdata/sf0.001"
TEXTS = [
    "", " ", "  a", "a  b", "a\n b", "\n\n", "x <|endoftext|>y<|endoftext|>", "<|endoftext|> a",
    "it's  we'll", "a   b", "日本 語", "a \x1c b", "éx", "a" * 5000, " \t x", "x ", "x  ",
    "\u0085 y", "12 3a 4", "ΑΣ ΣΑΣ Σ", "İstanbul", "<|startoftext|>A  <|endoftext|>", "a, b. c.,",
    "don't 'S 'RE x's1", "\x1c\x1dab", "ﬁ Ⅷ ½ ①", "'s. 't, x'll.", "the cat " * 3000, "½. ², á,",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "n") for i, t in enumerate(TEXTS)] + [(None, None, "n"), (0, "a  b", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_ids_and_texts_equal_the_library(spark, docs):
    lib = Tokenizer.from_file(WORDS)
    for row in round_trip(docs, WORDS).collect():
        ids = lib.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == lib.decode(ids, skip_special_tokens=False)
    assert "n_tokens" in round_trip(docs, WORDS).columns
    apart = docs.select(encoded(docs.text, WORDS).alias("ids"))
    assert [r.d for r in apart.select(decoded(apart.ids, WORDS).alias("d")).collect()] == [
        r.decoded for r in round_trip(docs, WORDS).collect()]


def test_merge_order_and_stale_entries():
    bpe = WordBpe(WORDS)
    lib = Tokenizer.from_file(WORDS)
    for word in ("aaaaaaaaa", "ananananas", "mississippi", "zzzzzzzzzzzzzz", "the" * 400):
        assert bpe.encode(word) == lib.encode(word, add_special_tokens=False).ids


def test_counts_equal_the_library(spark, docs):
    lib = Tokenizer.from_file(BYTES)
    for row in count_tokens(docs, BYTES, limit=3).collect():
        text = row.text or ""
        assert row.n_tokens == len(lib.encode(text, add_special_tokens=False).ids)
        assert row.n_bytes == len(text.encode())
        assert row.over_limit == (row.n_tokens > 3)


def test_counts_with_sentencepiece(spark, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    for row in count_tokens(docs, path).collect():
        assert row.n_tokens == len(lib.encode(row.text or ""))


def test_pieces_join_to_the_text_and_batches_keep_all():
    for text in TEXTS:
        assert "".join(safe_pieces(text)) == text
        assert all(p[:1] == " " for p in safe_pieces(text)[1:])
    batches = list(byte_batches(TEXTS, 100))
    assert [t for b in batches for t in b] == TEXTS
    assert all(len(b) == 1 or sum(len(t.encode()) for t in b) <= 100 for b in batches)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr("pairloom.llm.bpe.CACHE_ENTRIES", 2)
    monkeypatch.setattr("pairloom.llm.token_counts.CACHE_ENTRIES", 2)
    lib, counter, bpe = Tokenizer.from_file(WORDS), LengthCounter(BYTES), WordBpe(WORDS)
    assert counter.count(TEXTS) == counter.count(TEXTS)
    for text in TEXTS:
        assert bpe.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_empty_table(spark, docs):
    none = docs.filter("doc_id < 0")
    assert round_trip(none, WORDS).count() == 0
    assert count_tokens(none, BYTES).count() == 0


def test_registered_queries_equal_the_library(spark):
    words, byte = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for row in bpe_round_trip(spark, DATA).collect():
        ids = words.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = words.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    for row in token_lengths(spark, DATA).collect():
        assert row.n_tokens == len(byte.encode(texts[row.doc_id], add_special_tokens=False).ids)


def test_round_trip_that_forgets_gives_the_same_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "One two, one two."), (2, None), (3, "")], "doc_id long, text string")
    kept, forgot = (round_trip(docs, path, forget=f).orderBy("doc_id").collect() for f in (False, True))
    assert kept == forgot and kept[0].ids
    coder = WordBpe(path)
    first = coder.packed("One two three")
    coder.forget()
    assert not coder.words and not coder._pieces and coder.packed("One two three") == first
