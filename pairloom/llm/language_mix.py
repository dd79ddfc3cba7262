"""Language identification: a mixture of languages per document, found by EM.

Training counts byte n-grams (1 to 4 bytes, word ends included) of the words of every
labelled text per language, hashed to a table of fixed size, so the model is as large
for any corpus. A document is a bag of words; a word's likelihood in a language is the
product of its n-grams' smoothed probabilities. Expectation maximisation estimates the
shares of the languages in each document, all documents of a chunk at once. Then
languages are dropped, weakest first, and the set with the best likelihood less a
penalty of `log(words) / 2 * penalty` per language is kept. The prediction is the language
with the largest share in that set; the score is that share.

Defined results: null, empty and letterless texts, and all texts if nothing was
learned, are `und` with score 0; ties go to the first language by code point; empty
language labels are labels like others; other columns are carried along.
"""

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import words

UNKNOWN = "und"
BUCKET_BITS = 15
ORDERS = (1, 2, 3, 4)
# Languages a model may hold: with 2^15 buckets of 4 bytes each, 64 MB.
MAX_LANGUAGES = 512
# Bytes of texts that are worked on at a time; each takes some tens of bytes of arrays.
CHUNK_BYTES = 1 << 18
ROUNDS = 8
PENALTY = 2.0
# A word's n-grams overlap, so their product overstates its evidence.
TEMPER = 0.35
# Least likelihood of a word beside its best language: one odd word, such as a name,
# cannot decide a document.
FLOOR = 1e-3

PREDICTED = "struct<lang_pred:string,score:double>"


def _word_grams(data, starts, lengths):
    """(bucket of each n-gram, number of the word it belongs to) of some words."""
    # Lower-cased bytes of the words, a blank before and after each.
    sizes = lengths + 2
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    within = np.arange(len(owner)) - begins[owner]
    inside = (within > 0) & (within <= lengths[owner])
    text = np.full(len(owner), 0x20, np.uint64)
    text[inside] = data[(starts[owner] + within - 1)[inside]]
    upper = (text >= 0x41) & (text <= 0x5A)
    text[upper] += np.uint64(0x20)
    left = sizes[owner] - within
    buckets, owners = [], []
    gram = np.zeros(len(text), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(text), np.uint64)
        shifted[: len(text) - order + 1] = text[order - 1 :]
        gram = (gram << np.uint64(8)) | shifted
        if order in ORDERS:
            whole = left >= order
            coded = words.mix(gram[whole] + np.uint64(order << 40))
            buckets.append((coded >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            owners.append(owner[whole])
    return np.concatenate(buckets), np.concatenate(owners)


def _distinct_words(data, bounds):
    """(bytes and lengths of the distinct words, word number of each token, first token of each row)."""
    hashes, firsts, starts = words.split(data, bounds)
    _, where, number = np.unique(hashes, return_index=True, return_inverse=True)
    blank = words._BLANK[data]
    ends = np.flatnonzero(~blank & np.append(blank[1:], True))
    # A row's last byte ends a word also where the next row goes on without a blank.
    edge = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    ends = np.union1d(ends, edge[~blank[edge]])
    return starts[where], ends[where] - starts[where] + 1, number, firsts


def _training_counts(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for rows, data, bounds in words.chunks(batch.column("text"), CHUNK_BYTES):
            starts, lengths, number, firsts = _distinct_words(data, bounds)
            if not len(starts):
                continue
            buckets, owners = _word_grams(data, starts, lengths)
            of_rows = langs[rows]
            token_lang = np.repeat(np.arange(len(of_rows)), np.diff(firsts))
            for lang in set(of_rows.tolist()):
                mine = (of_rows == lang)[token_lang]
                often = np.bincount(number[mine], minlength=len(starts))
                add = np.bincount(buckets, weights=often[owners], minlength=1 << BUCKET_BITS)
                counts[lang] = counts.get(lang, 0) + add
    for lang, table in counts.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([table.astype(np.int64).tobytes()], pa.binary())],
            names=["lang", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.int64) for c in table.column("counts").combine_chunks())
    return pa.table({"lang": table.column("lang").slice(0, 1), "counts": [total.tobytes()]})


def train(labelled: DataFrame):
    """(languages, log-probability of each bucket per language) from columns text, lang.

    Tasks send one table of fixed size per language they saw.
    """
    schema = "lang string, counts binary"
    counted = labelled.filter("text is not null and lang is not null").select("text", "lang")
    merged = counted.mapInArrow(_training_counts, schema).groupBy("lang").applyInArrow(_summed, schema)
    rows = sorted(merged.limit(MAX_LANGUAGES + 1).collect(), key=lambda row: row.lang)
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language labels")
    if not rows:
        return [], np.zeros((1 << BUCKET_BITS, 0), np.float32)
    counts = np.stack([np.frombuffer(row.counts, np.int64) for row in rows], axis=1) + 0.5
    return [row.lang for row in rows], np.log(counts / counts.sum(0)).astype(np.float32)


def _shares(likelihoods, firsts, allowed, start, rounds):
    """EM: shares of the allowed languages in each row, and the log-likelihoods.

    `likelihoods` has one row per token; rows of the result have tokens `firsts[i]` on.
    """
    counts = np.diff(firsts)
    row_of = np.repeat(np.arange(len(counts)), counts)
    shares = np.where(allowed, start, 0) + allowed * 1e-9
    shares /= shares.sum(1, keepdims=True)
    for turn in range(rounds + 1):
        joint = likelihoods * shares[row_of]
        total = joint.sum(1)
        if turn == rounds:
            break
        joint /= total[:, None]
        shares = np.add.reduceat(joint, firsts[:-1], axis=0) / counts[:, None]
    return shares, np.add.reduceat(np.log(total), firsts[:-1])


def infer(likelihoods, firsts, penalty=PENALTY, rounds=ROUNDS):
    """(best language, its share) of each row; every row has at least one token."""
    counts = np.diff(firsts)
    n, k = len(counts), likelihoods.shape[1]
    allowed = np.ones((n, k), bool)
    shares, fit = _shares(likelihoods, firsts, allowed, np.full((n, k), 1.0), rounds)
    cost = penalty * np.log(counts + 1) / 2
    best_value, best_shares = fit - cost * k, shares
    for left in range(k - 1, 0, -1):
        # Drop each row's weakest language; of equals, the last by code point.
        weakest = k - 1 - np.argmin(np.where(allowed, shares, np.inf)[:, ::-1], axis=1)
        allowed[np.arange(n), weakest] = False
        shares, fit = _shares(likelihoods, firsts, allowed, shares, rounds if left > 1 else 0)
        value = fit - cost * left
        better = value > best_value
        best_value = np.where(better, value, best_value)
        best_shares = np.where(better[:, None], shares, best_shares)
    chosen = best_shares.argmax(1)
    return chosen, best_shares[np.arange(n), chosen]


def _predict_batch(texts: pa.Array, lettered: pa.Array, langs, table) -> pa.Array:
    names = np.full(len(texts), UNKNOWN, object)
    scores = np.zeros(len(texts))
    known = np.array(lettered.to_pylist(), bool)
    # Arrays below hold a number per n-gram and language.
    limit = max(1 << 14, CHUNK_BYTES * 8 // max(8, len(langs)))
    for rows, data, bounds in words.chunks(texts, limit):
        starts, lengths, number, firsts = _distinct_words(data, bounds)
        counts = np.diff(firsts)
        some = known[rows] & (counts > 0)
        if not langs or not some.any():
            continue
        buckets, owners = _word_grams(data, starts, lengths)
        fits = np.zeros((len(starts), len(langs)))
        edges = np.flatnonzero(np.diff(owners, prepend=-1))
        # The n-grams of each order are sorted by word; sum each run, then add the runs.
        np.add.at(fits, owners[edges], np.add.reduceat(table[buckets], edges, axis=0))
        fits *= TEMPER
        relative = np.maximum(np.exp(fits - fits.max(1, keepdims=True)), FLOOR)
        tokens = np.repeat(some, counts)
        kept = np.append(0, np.cumsum(counts[some]))
        chosen, share = infer(relative[number[tokens]], kept)
        at = np.arange(rows.start, rows.stop)[some]
        names[at] = np.array(langs, object)[chosen]
        scores[at] = np.clip(share, 0.0, 1.0)
    return pa.StructArray.from_arrays(
        [pa.array(names.tolist(), pa.string()), pa.array(scores)], ["lang_pred", "score"])


def predict(docs: DataFrame, model, text="text") -> DataFrame:
    """`docs` with lang_pred and score."""
    langs, table = model
    # Of bounded size, see MAX_LANGUAGES.
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps((langs, table)))
    held = {}

    @F.arrow_udf(PREDICTED)
    def identify(texts: pa.Array, lettered: pa.Array) -> pa.Array:
        if not held:
            held["model"] = pickle.loads(shared.value)
        return _predict_batch(texts, lettered, *held["model"])

    kept = docs.drop("lang_pred", "score", "_found")
    column = F.coalesce(F.col(text), F.lit(""))
    found = kept.withColumn("_found", identify(column, column.rlike(r"\p{L}")))
    return found.select(*kept.columns, "_found.lang_pred", "_found.score")


def held_out(id_col="doc_id", folds=4, fold=2):
    """Whether the row is kept from training: by the checksum of its id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def identify_languages(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, lang) with held_out, lang_pred and score, learned from the rest."""
    marked = docs.withColumn("held_out", held_out())
    return predict(marked, train(marked.filter(~F.col("held_out"))))
