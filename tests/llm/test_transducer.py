import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from pairloom.llm import transducer
from pairloom.llm.queries import byte_bpe_round_trip

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    None, "", " ", "\n", "   \n\n  x", "a" * 3000, " " * 5000 + "x", "don't  we'll", "naïve café",
    "日本語のテキスト", "<|endoftext|> x", "\x00\x1f\x85", "é ​﻿", "12345 67 8", "👩‍👩‍👧 x👍",
    "-" * 700 + "=" * 333, "x " * 4000,
]


@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer(transducer.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=transducer.read_ranks(RANKS), special_tokens={},
    )


def test_pieces_equal_the_merges(machine):
    pick = random.Random(1)
    tokens = sorted(machine.ranks)
    for at in range(3000):
        if at % 2:
            piece = b"".join(pick.choice(tokens) for _ in range(pick.randint(1, 4)))[:60]
        else:
            piece = bytes(pick.choice(b"aaab  \n\xc3\xa9\xe4\xff-") for _ in range(pick.randint(1, 30)))
        assert machine.encode_piece(piece) == machine.merge(piece), piece


def test_small_vocabularies_where_merges_compete():
    pick = random.Random(2)
    for _ in range(150):
        ranks = {bytes([b]): b for b in range(256)}
        for _ in range(pick.randint(1, 14)):
            parts = [*map(bytes, ([97], [98])), *list(ranks)[256:]]
            token = pick.choice(parts) + pick.choice(parts)
            plain = object.__new__(transducer.Transducer)
            plain.ranks = {**ranks, token: len(ranks)}
            if token not in ranks and plain.merge(token) == [len(ranks)]:
                ranks[token] = len(ranks)
        own = transducer.Transducer(ranks, r"(?s).+")
        for _ in range(60):
            piece = bytes(pick.choice(b"ab") for _ in range(pick.randint(1, 24)))
            assert own.encode_piece(piece) == own.merge(piece), (ranks, piece)


def test_vocabularies_with_tokens_that_no_merges_make_are_refused():
    ranks = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="no earlier merges"):
        transducer.Transducer({**ranks, b"bb": 256, b"ab": 257, b"abbb": 258}, ".+")
    with pytest.raises(ValueError, match="every byte"):
        transducer.Transducer({b"a": 0}, ".+")


def test_states_and_memories_may_be_forgotten_at_any_time(monkeypatch, library):
    for name, most in (("MAX_STATES", 7), ("MAX_PAIRS", 5), ("MAX_PIECES", 3), ("MAX_STEPS", 2)):
        monkeypatch.setattr(transducer, name, most)
    small = transducer.Transducer(transducer.read_ranks(RANKS), public_tokenizers.PATTERN)
    for text in ODD[1:]:
        ids = library.encode_ordinary(text)
        assert small.encode(text) == ids
        assert small.decode(ids) == text
    assert len(small._states) <= 7 and len(small._older) <= 7


def test_tokens_come_after_bounded_lookahead(machine):
    longest = max(map(len, machine.ranks))
    state, read, sent = machine._start, 0, 0
    for byte in b" antidisestablishmentarianism" * 20:
        state, emitted = state[byte]
        read += 1
        sent += sum(len(machine.tokens[t]) for t in emitted)
        assert read - sent <= 2 * longest


def test_decoding_equals_the_library(machine, library):
    pick = random.Random(3)
    for at in range(3000):
        most = 50_256 if at % 2 else 256
        ids = [pick.randrange(most) for _ in range(pick.randint(0, 6))]
        assert machine.decode(ids) == library.decode(ids), ids
    parts = list(machine.decode_stream(machine.encode("né 日")))
    assert "".join(parts) == "né 日" and "�" not in "".join(parts)


def test_round_trip_of_odd_rows(spark, library):
    rows = [(i, text, "kept") for i, text in enumerate(ODD)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = transducer.round_trip(docs.withColumnRenamed("ids", "_coded"), RANKS, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "_coded", "ids", "decoded"]
    got = found.collect()
    assert len(got) == len(rows)
    for row in got:
        assert row["_coded"] == "kept"
        assert list(row["ids"]) == library.encode_ordinary(row["text"] or "")
        assert row["decoded"] == (row["text"] or "")
    back = found.withColumn("back", transducer.decoded(found["ids"], RANKS, public_tokenizers.PATTERN))
    assert back.filter("back <> decoded").count() == 0
    replaced = transducer.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert replaced.columns == ["doc_id", "text", "ids", "decoded"]
    assert transducer.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = byte_bpe_round_trip(spark, folder).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    for row in got:
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_whole_tokens_take_no_steps(machine, monkeypatch):
    monkeypatch.setattr(machine, "_steps", {})
    ids = machine.encode("one two three")
    assert "".join(machine.decode_stream(ids)) == "one two three"
    assert not machine._steps
