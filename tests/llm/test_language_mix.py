import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pairloom.llm import language_mix as lm

DATA = "/root/testdata/sf0.01"


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")


def test_held_out_accuracy_and_contract(spark):
    docs = documents(spark)
    rows = lm.identify_languages(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = documents(spark)
    changed = docs.withColumn("lang", F.when(lm.held_out(), "xx").otherwise(F.col("lang")))
    pick = ["doc_id", "lang_pred", "score"]
    first = {tuple(r) for r in lm.identify_languages(docs).select(pick).collect()}
    assert first == {tuple(r) for r in lm.identify_languages(changed.repartition(5)).select(pick).collect()}


def test_mixed_documents_get_shares(spark):
    docs = documents(spark)
    model = lm.train(docs)
    en = docs.filter("lang = 'en'").orderBy(F.length("text").desc()).first().text
    de = docs.filter("lang = 'de'").orderBy(F.length("text").desc()).first().text
    mixed = " ".join(en.split()[:120] + de.split()[:60])
    row = lm.predict(spark.createDataFrame([(mixed,)], "text string"), model).first()
    assert row.lang_pred == "en" and 0.55 < row.score < 0.8
    pure = lm.predict(spark.createDataFrame([(" ".join(en.split()[:120]),)], "text string"), model).first()
    assert pure.lang_pred == "en" and pure.score > 0.95


def test_em_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    sizes = [1, 4, 30]
    firsts = np.append(0, np.cumsum(sizes))
    fits = rng.random((firsts[-1], 3)) + 0.01
    got, values = lm._shares(fits, firsts, np.ones((3, 3), bool), np.ones((3, 3)), 6)
    for i, size in enumerate(sizes):
        mine, shares = fits[firsts[i] : firsts[i + 1]], np.full(3, 1 / 3)
        before = -np.inf
        for _ in range(6):
            value = np.log(mine @ shares).sum()
            assert value >= before - 1e-9
            before = value
            shares = np.array([sum(r[k] * shares[k] / (r @ shares) for r in mine) / size for k in range(3)])
        assert np.allclose(got[i], shares, atol=1e-6)
        assert np.isclose(values[i], np.log(mine @ shares).sum(), atol=1e-6)


def test_edge_rows(spark):
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("der hund und die katze", "de")] * 40)]
    edge = [(1000, None, "en"), (1001, "", None), (1002, "123 ... \n", "en"), (1003, "the the " * 60_000, None),
            (None, "der und die", None), (1004, "the mat", ""), (1004, "the mat", "")]
    docs = spark.createDataFrame([(*r, 9.0) for r in train + edge], "doc_id long, text string, lang string, score double")
    rows = lm.identify_languages(docs).collect()
    assert len(rows) == len(train) + len(edge)
    found = {r.doc_id: r for r in rows}
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert found[1003].lang_pred == "en" and found[None].lang_pred == "de" and found[None].held_out is False
    assert lm.identify_languages(docs.filter("doc_id < 0")).count() == 0
    nothing = lm.identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_words_next_to_row_edges():
    texts = pa.array(["ab", "cd ef", "", "gh"])
    ((_, data, bounds),) = lm.words.chunks(texts)
    starts, lengths, number, firsts = lm._distinct_words(data, bounds)
    seen = sorted(bytes(data[s : s + n]).decode() for s, n in zip(starts, lengths))
    assert seen == ["ab", "cd", "ef", "gh"]
    assert firsts.tolist() == [0, 1, 3, 3, 4]
