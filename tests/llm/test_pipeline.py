from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import regex
from test_ngram_join import brute_force
from tokenizers import Tokenizer

import corpus_pipeline
from pairloom.llm.queries import SOURCE_MIX_SQL

DATA = "/root/testdata/sf0.001"


def content(text):
    return "".join(c for c in text if c not in " \t\n\x0b\x0c\r")


def expected_rows(docs):
    """(doc_id, ids, decoded text) of the pipeline, by plain loops, SQL and the library."""
    docs = [d for d in docs if regex.search(r"\p{L}", d["text"] or "")]
    groups = defaultdict(list)
    for d in docs:
        groups[content(d["text"])].append(d)
    docs = [min(g, key=lambda d: (-len(d["text"]), d["doc_id"])) for g in groups.values()]
    classes = brute_force([(d["doc_id"], d["text"]) for d in docs])
    stays = {key for key, _, component in classes if key == component}
    docs = [d for d in docs if d["doc_id"] in stays]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(d["doc_id"], d["text"], d["source"]) for d in docs])
    mixed = {r[0]: r[4] // r[1] for r in con.execute(
        f"SELECT doc_id, size, source_size, target, taken FROM ({SOURCE_MIX_SQL})").fetchall() if r[1]}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = []
    for d in docs:
        ids = lib.encode(d["text"], add_special_tokens=False).ids
        rows += [(d["doc_id"], tuple(ids), lib.decode(ids, skip_special_tokens=False))] * mixed.get(d["doc_id"], 0)
    return Counter(rows)


def test_run_equals_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = corpus_pipeline.run(spark, DATA)
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found.collect())
    assert got == expected_rows(docs)


def test_odd_rows_and_no_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, key string"
    rows = [(1, "ein text mit worten und noch mehr", "de", "s", 1, "x", "k"), (1, "ein text mit worten und noch mehr", "de", "s", 1, "x", "k"),
            (None, "the text of a row without id", None, None, None, None, None), (2, None, "en", "s", 0, "x", "k"), (3, "", "en", None, 0, "x", "k"),
            (4, "12 34", "en", "t", 0, "x", "k"), (5, "the cat " * 20_000, "en", "t", 0, "x", "k"), (1, "an other text under one id", "en", "s", 1, "x", "k")]
    docs = spark.createDataFrame(rows, schema)
    for name, frame in (("odd", docs), ("none", docs.filter("doc_id < 0"))):
        for stage, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, frame, str(tmp_path))
            assert out.columns == docs.columns, stage
            path = str(tmp_path / f"{name}-{stage}")
            out.write.parquet(path)
            frame = spark.read.parquet(path)
            if name == "odd" and stage != "source_mix":
                assert {r.text for r in frame.collect()} == {r[1] for r in rows if regex.search(r"\p{L}", r[1] or "")}
        assert corpus_pipeline.encoded_documents(spark, frame, str(tmp_path)).count() == frame.count()


def test_lettered_documents_stay_where_no_language_could_be_learned(spark):
    rows = [(1, "plain words", None), (2, "123 456", None), (3, None, None), (4, "more words", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.known_language(spark, docs, None).collect()) == [1, 4]
