"""Language-model scores from an n-gram trie in Elias-Fano coded, memory-mapped levels.

Training counts words, then pairs of words that are both frequent enough, then
triples whose two pairs are; each level's count is pruned by the level below, so
a triple is never lost to that. Probabilities interpolate by absolute discounting:

    P(w | h) = (count(h w) - D) / count(h) + backoff(h) * P(w | shorter h)

where backoff(h) is the mass that the kept n-grams of h leave. At the bottom is the
add-0.1 unigram estimate. Log-probabilities are stored in 16 bits.

A level is a row of shards, each a range of (context, word) written by one task. A
shard has the monotone starts of each context's range (pointers) and the monotone
numbers `context * V + word` relative to its first context, both Elias-Fano coded. A
query finds its context's range by the pointers and the word in it by successor search.
Tasks map the files, so workers of one machine share them and memory stays free.

The files lie in the folder of `spark.checkpoint.dir`, which must be mounted on all
machines. Words are told apart by 64-bit hashes.

Defined results: A-Z count as a-z; null and empty texts are one end token; rows with a
null id train and are not held out; every copy of a row counts; without training rows all
scores are those of an empty vocabulary; other columns are carried along.
"""

import functools
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import elias_fano, words
from pairloom.llm.batches import small_batches
from pairloom.session import materialize, scratch_path

# The end token's hash; it also stands before the first word as a context.
END = 0x5EED
ADD = 0.1
DISCOUNT = 0.75
LEAST_COUNT = 2
CODES_PER_UNIT = 4000
SHARD_ROWS = 2_000_000
CHUNK_BYTES = 1 << 20
TALLY_ROWS = 500_000
# N-grams of a shard that are worked on at a time.
SLICE_ROWS = 200_000


def held_out(id_col="doc_id", folds=10, fold=0):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def _coded(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * CODES_PER_UNIT), 0, 65535).astype(np.uint16)


def _value(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) / -CODES_PER_UNIT


def token_hashes(data, bounds):
    """(hash of each token as int64, first token of each row with the end appended)."""
    hashes, firsts, _ = words.split(data, bounds)
    n = np.diff(firsts)
    starts = np.append(0, np.cumsum(n + 1))
    tokens = np.full(starts[-1], END, np.int64)
    is_word = np.ones(len(tokens), bool)
    is_word[starts[1:] - 1] = False
    tokens[is_word] = hashes.view(np.int64)
    return tokens, starts


class Tally:
    """Counts of keys, held as sorted arrays and handed on when they grow large."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys):
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > TALLY_ROWS:
            self._merge()
            if self.held > TALLY_ROWS // 2:
                yield from self.flush()

    def _merge(self):
        if len(self.keys) < 2:
            return
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        # The parts are sorted, which a stable sort makes use of.
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.counts, self.held = [keys[edges]], [np.add.reduceat(counts, edges)], len(edges)

    def flush(self):
        if self.held:
            self._merge()
            for at in range(0, self.held, 200_000):
                part = slice(at, at + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(self.keys[0][part]), pa.array(self.counts[0][part])], names=["key", "times"])
        self.keys, self.counts, self.held = [], [], 0


def _counted(batches, keys_of):
    tally = Tally()
    for batch in batches:
        for _, data, bounds in words.chunks(batch.column(0), CHUNK_BYTES):
            keys = keys_of(*token_hashes(data, bounds))
            if len(keys):
                yield from tally.add(keys)
    yield from tally.flush()


def _sums(batches, least):
    """Sums of `times` per key of rows sorted by key; keys below `least` go."""
    last_key, last_sum = None, 0

    def out(keys, sums):
        kept = sums >= least
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[kept]), pa.array(sums[kept])], names=["key", "times"])

    for batch in batches:
        keys, times = (batch.column(i).to_numpy() for i in (0, 1))
        if not len(keys):
            continue
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, sums = keys[edges], np.add.reduceat(times, edges)
        if last_key is not None:
            if keys[0] == last_key:
                sums[0] += last_sum
            else:
                keys, sums = np.append(last_key, keys), np.append(last_sum, sums)
        last_key, last_sum = keys[-1], sums[-1]
        yield out(keys[:-1], sums[:-1])
    if last_key is not None:
        yield out(np.array([last_key], np.int64), np.array([last_sum], np.int64))


def _counts(texts: DataFrame, keys_of, least=1) -> DataFrame:
    """Stored (key, times) of all keys that `keys_of` makes of the texts' tokens."""
    def local(batches):
        return _counted(batches, keys_of)

    def merged(batches):
        return _sums(batches, least)

    schema = "key long, times long"
    return materialize(texts.mapInArrow(local, schema).repartition("key").sortWithinPartitions(
        "key").mapInArrow(merged, schema))


def _sharded(counts: DataFrame, write):
    """Write sorted shards of the table; (first key, last key, rows, shard) of each, in order."""
    shards = max(1, -(-counts.count() // SHARD_ROWS))
    ranged = counts.repartitionByRange(shards, "key").sortWithinPartitions("key")

    def one(batches):
        shard = TaskContext.get().partitionId()
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        keys, times = (np.concatenate([b.column(i).to_numpy() for b in parts]) for i in (0, 1))
        del parts
        write(shard, keys, times)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(x)]) for x in (keys[0], keys[-1], len(keys), shard)],
            names=["first", "last", "rows", "shard"])

    # One row per shard of millions of n-grams.
    rows = ranged.mapInArrow(one, "first long, last long, rows long, shard long").collect()
    return sorted((r["first"], r["last"], r["rows"], r["shard"]) for r in rows)


class Level:
    """Shards of one level behind one numbering of their n-grams."""

    def __init__(self, folder, name, shards):
        self.folder, self.name, self.shards = folder, name, shards
        self.firsts = np.array([s[0] for s in shards], np.int64)
        self.offsets = np.append(0, np.cumsum([s[2] for s in shards])).astype(np.int64)
        self.size = int(self.offsets[-1])

    def file(self, shard):
        return f"{self.name}-{shard}"

    def by_shard(self, numbers):
        """(position of the shard, mask) for each shard that holds some of these n-grams."""
        place = np.searchsorted(self.offsets, numbers, "right") - 1
        for at in np.flatnonzero(np.bincount(place, minlength=1)):
            yield at, place == at

    def gather(self, key, numbers):
        """Stored values of n-grams by number; 0 where the number is negative."""
        found = np.zeros(len(numbers), np.float64)
        asked = np.flatnonzero(numbers >= 0)
        for at, mask in self.by_shard(numbers[asked]):
            mine = asked[mask]
            found[mine] = self.array(at, key)[numbers[mine] - self.offsets[at]]
        return found

    @functools.lru_cache(maxsize=None)
    def array(self, at, key):
        return elias_fano.load(self.folder, self.file(self.shards[at][3]), [key])[key]


class Vocabulary(Level):
    """Words: sorted hashes and their counts. A word's id is its place."""

    def ids(self, hashes):
        """Ids of these hashes, -1 for words that are not known."""
        unique, where = np.unique(hashes, return_inverse=True)
        ids = np.full(len(unique), -1, np.int64)
        for at in range(len(self.shards)):
            known = self.array(at, "hashes")
            first, last = np.searchsorted(unique, self.shards[at][:2])
            mine = slice(first, last + 1)
            place = np.minimum(np.searchsorted(known, unique[mine]), len(known) - 1)
            ids[mine] = np.where(known[place] == unique[mine], place + self.offsets[at], -1)
        return ids[where]


class Grams(Level):
    """N-grams as pairs of a context's number and a word's id."""

    def __init__(self, folder, name, shards, n_words):
        super().__init__(folder, name, shards)
        self.n_words = n_words

    @functools.lru_cache(maxsize=None)
    def sequences(self, at):
        name = self.file(self.shards[at][3])
        return [elias_fano.load_sequence(self.folder, f"{name}-{part}") for part in ("pointers", "grams")]

    def find(self, contexts, word_ids):
        """Numbers of these n-grams, -1 where one is not kept."""
        found = np.full(len(contexts), -1, np.int64)
        if not self.shards:
            return found
        asked = np.flatnonzero((contexts >= 0) & (word_ids >= 0))
        keys, where = np.unique(contexts[asked] * self.n_words + word_ids[asked], return_inverse=True)
        answer = np.full(len(keys), -1, np.int64)
        place = np.searchsorted(self.firsts, keys, "right") - 1
        for at in np.unique(place[place >= 0]):
            mine = np.flatnonzero(place == at)
            first, last = self.shards[at][0] // self.n_words, self.shards[at][1] // self.n_words
            mine = mine[keys[mine] // self.n_words <= last]
            if not len(mine):
                continue
            pointers, grams = self.sequences(at)
            context = keys[mine] // self.n_words - first
            # The keys are sorted, so each context is asked once.
            new = np.append(True, context[1:] != context[:-1])
            run, context = np.cumsum(new) - 1, context[new]
            begin, end = pointers.access(context)[run], pointers.access(context + 1)[run]
            some = begin < end
            mine, begin, end = mine[some], begin[some], end[some]
            value = keys[mine] - first * self.n_words
            index = grams.successor(value, begin, end)
            inside = index < end
            mine, index, value = mine[inside], index[inside], value[inside]
            hit = grams.access(index) == value
            answer[mine[hit]] = index[hit] + self.offsets[at]
        found[asked] = answer[where]
        return found


    def words_of(self, numbers):
        """Id of the last word of each of these n-grams."""
        found = np.empty(len(numbers), np.int64)
        for at, mask in self.by_shard(numbers):
            first = self.shards[at][0] // self.n_words
            value = self.sequences(at)[1].access(numbers[mask] - self.offsets[at])
            found[mask] = (value + first * self.n_words) % self.n_words
        return found


def write_grams(folder, name, keys, n_words):
    """Pointers and grams of one shard; `keys` are context * n_words + word, sorted."""
    first = int(keys[0]) // n_words
    contexts = keys // n_words - first
    size = int(contexts[-1]) + 1
    starts = np.searchsorted(contexts, np.arange(size + 1))
    pointers = elias_fano.encode(starts, len(keys) + 1)
    grams = elias_fano.encode(keys - first * n_words, size * n_words)
    elias_fano.save(folder, f"{name}-pointers", pointers)
    elias_fano.save(folder, f"{name}-grams", grams)


class Model:
    """What a task needs to score: small numbers and the mapped levels."""

    def __init__(self, folder, n_tokens, words_, pairs=None, triples=None):
        self.folder, self.n_tokens = folder, n_tokens
        self.parts = words_, pairs, triples
        self.open()

    def open(self):
        words_, pairs, triples = self.parts
        self.words = Vocabulary(self.folder, "words", words_)
        self.pairs = Grams(self.folder, "pairs", pairs or [], self.words.size)
        self.triples = Grams(self.folder, "triples", triples or [], self.words.size)
        self.scale = self.n_tokens + ADD * (self.words.size + 1)

    def __getstate__(self):
        return self.folder, self.n_tokens, self.parts

    def __setstate__(self, state):
        self.folder, self.n_tokens, self.parts = state
        self.open()

    def unigram(self, ids):
        counts = self.words.gather("times", ids)
        return counts, np.log10((counts + ADD) / self.scale)

    def contexts(self, tokens, starts):
        """(word ids, ids of the words before; the end token's before the first)."""
        ids = self.words.ids(tokens)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[starts[:-1]] = self.end_id
        return ids, before

    @functools.cached_property
    def end_id(self):
        return int(self.words.ids(np.array([END], np.int64))[0]) if self.words.size else -1

    def pair_before(self, pair, starts):
        """Number of the pair that ends at the word before; -1 before the first word."""
        before = np.full_like(pair, -1)
        before[1:] = pair[:-1]
        before[starts[:-1]] = -1
        return before

    def pair_keys(self, tokens, starts):
        ids, before = self.contexts(tokens, starts)
        frequent = self.words.gather("times", ids) >= LEAST_COUNT
        frequent &= self.words.gather("times", before) >= LEAST_COUNT
        return before[frequent] * self.words.size + ids[frequent]

    def triple_keys(self, tokens, starts):
        ids, before = self.contexts(tokens, starts)
        pair = self.pairs.find(before, ids)
        context = self.pair_before(pair, starts)
        kept = (pair >= 0) & (context >= 0)
        return context[kept] * self.words.size + ids[kept]

    def pair_log10(self, ids, before, pair, unigram):
        shorter = unigram + _value(self.words.gather("backoff", before))
        return np.where(pair >= 0, _value(self.pairs.gather("prob", pair)), shorter)

    def score(self, tokens, starts):
        """Per row: known tokens, base score, score."""
        ids, before = self.contexts(tokens, starts)
        _, unigram = self.unigram(ids)
        score = unigram
        if self.pairs.size:
            pair = self.pairs.find(before, ids)
            score = self.pair_log10(ids, before, pair, unigram)
            if self.triples.size:
                context = self.pair_before(pair, starts)
                # Training kept a triple only where it kept both of its pairs.
                triple = self.triples.find(context, np.where(pair >= 0, ids, -1))
                shorter = score + _value(self.pairs.gather("backoff", context))
                score = np.where(triple >= 0, _value(self.triples.gather("prob", triple)), shorter)
        at = starts[:-1]
        return (np.add.reduceat((ids >= 0).astype(np.int64), at), np.add.reduceat(unigram, at),
                np.add.reduceat(score, at))


def _write_backoffs(counts: DataFrame, n_words, level: Level, folder):
    """Backoff codes of all n-grams of a level: the mass that their kept n-grams leave."""
    offsets, shards, file = level.offsets, level.shards, level.file
    kept = counts.groupBy(F.expr(f"key div {n_words}").alias("context")).agg(
        F.sum(F.col("times") - DISCOUNT).alias("kept"))

    def one(key, table):
        at = key[0].as_py()
        codes = np.zeros(shards[at][2], np.uint16)
        for batch in table.to_batches(SLICE_ROWS):
            contexts = batch.column("context").to_numpy()
            left = 1 - batch.column("kept").to_numpy() / level.gather("times", contexts)
            codes[contexts - offsets[at]] = _coded(np.log10(np.maximum(left, 1e-12)))
        elias_fano.save(folder, file(shards[at][3]), {"backoff": codes})
        return pa.table({"shard": [at]})

    # Context numbers of a shard are a range of bounded size, so the shard follows from the bounds.
    shard = F.lit(0)
    for at in range(1, len(shards)):
        shard = F.when(F.col("context") >= int(offsets[at]), at).otherwise(shard)
    done = kept.withColumn("shard", shard.cast("long")).groupBy("shard").applyInArrow(one, "shard long")
    written = {r.shard for r in done.collect()}
    for at, (_, _, rows, number) in enumerate(shards):
        if at not in written:
            elias_fano.save(folder, file(number), {"backoff": np.zeros(rows, np.uint16)})


def _write_level(counts, model, contexts: Level, name, lower):
    """Write a level of n-grams; `lower` gives log10 P of the shorter n-gram of each."""
    folder, n_words = model.folder, model.words.size

    def write(shard, keys, times):
        file = f"{name}-{shard}"
        write_grams(folder, file, keys, n_words)
        codes = np.empty(len(keys), np.uint16)
        for at in range(0, len(keys), SLICE_ROWS):
            part = slice(at, at + SLICE_ROWS)
            context, word = keys[part] // n_words, keys[part] % n_words
            direct = (times[part] - DISCOUNT) / contexts.gather("times", context)
            backoff = 10 ** _value(contexts.gather("backoff", context))
            codes[part] = _coded(np.log10(direct + backoff * 10 ** lower(context, word)))
        elias_fano.save(folder, file, {"prob": codes, "times": times})

    return _sharded(counts, write)


def train(docs: DataFrame, text="text") -> Model:
    """A model of all rows of `docs`, its files in the shared folder."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ngram-trie")
    scheme, _, path = folder.rpartition("://") if "://" in folder else folder.rpartition(":")
    if scheme not in ("", "file"):
        raise ValueError("spark.checkpoint.dir must be a folder mounted on all machines")
    folder = path
    os.makedirs(folder, exist_ok=True)
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))

    counts = _counts(texts, lambda tokens, starts: tokens)
    n_tokens = counts.agg(F.sum("times")).first()[0] or 0

    def write_words(shard, keys, times):
        elias_fano.save(folder, f"words-{shard}", {"hashes": keys, "times": times})

    vocabulary = _sharded(counts, write_words)
    model = Model(folder, n_tokens, vocabulary)
    if not n_tokens:
        return model
    counts = _counts(texts, model.pair_keys, LEAST_COUNT)
    _write_backoffs(counts, model.words.size, model.words, folder)
    pairs = _write_level(counts, model, model.words, "pairs", lambda context, word: model.unigram(word)[1])
    model = Model(folder, n_tokens, vocabulary, pairs)
    if not pairs:
        return model
    if model.words.size * model.pairs.size >= 2**63:
        raise ValueError("too many pairs for one key; raise LEAST_COUNT")
    counts = _counts(texts, model.triple_keys, LEAST_COUNT)
    _write_backoffs(counts, model.words.size, model.pairs, folder)

    def pair_of(context, word):
        # The pair's own words: its second word is the one before.
        before = model.pairs.words_of(context)
        pair = model.pairs.find(before, word)
        return model.pair_log10(word, before, pair, model.unigram(word)[1])

    triples = _write_level(counts, model, model.pairs, "triples", pair_of)
    return Model(folder, n_tokens, vocabulary, pairs, triples)


def score_documents(docs: DataFrame, model: Model, text="text") -> DataFrame:
    """`docs` with n_tokens, n_known, train_tokens, base_score, score."""
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]

    @F.arrow_udf("struct<n_tokens:bigint,n_known:bigint,base_score:double,score:double>")
    def scored(texts: pa.Array) -> pa.Array:
        parts = []
        for _, data, bounds in words.chunks(texts, CHUNK_BYTES):
            tokens, starts = token_hashes(data, bounds)
            known, base, score = model.score(tokens, starts)
            parts.append(np.stack([np.diff(starts), known, base, score]))
        rows = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0))
        return pa.StructArray.from_arrays(
            [pa.array(rows[0].astype(np.int64)), pa.array(rows[1].astype(np.int64)),
             pa.array(rows[2]), pa.array(rows[3])],
            ["n_tokens", "n_known", "base_score", "score"])

    kept = docs.drop(*names, "_scored")
    found = kept.withColumn("_scored", scored(F.coalesce(F.col(text), F.lit(""))))
    return found.select(*kept.columns, "_scored.n_tokens", "_scored.n_known",
                        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
                        "_scored.base_score", "_scored.score")


def score_held_out(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with held_out and the scores of a model of the other rows."""
    small_batches(docs.sparkSession)
    marked = docs.withColumn("held_out", held_out())
    return score_documents(marked, train(marked.filter(~F.col("held_out"))))
