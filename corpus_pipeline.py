"""Documents from raw rows to token ids: language, copies, near copies, mix, encoding.

Each stage is written as Parquet and read again as the next one's documents. Rows
that a stage drops are gone for the later ones; a row that the mix takes twice is two rows.
"""

from pairloom.llm import bpe, grace_dedup, language_mix, ngram_join, pareto_mix
from pairloom.llm.batches import small_batches
from pairloom.llm.queries import table, vocabulary
from pairloom.session import materialize


def known_language(spark, docs, sf_dir):
    """Drops documents without text or letters; where nothing could be learned, lettered ones stay."""
    small_batches(spark)
    found = language_mix.identify_languages(docs)
    known = (found.lang_pred != language_mix.UNKNOWN) | found.text.rlike(r"\p{L}")
    return found.filter(known).select(*docs.columns)


def without_copies(spark, docs, sf_dir):
    small_batches(spark)
    return grace_dedup.keep_one(docs)


def without_near_copies(spark, docs, sf_dir):
    small_batches(spark)
    return ngram_join.keep_one_of_each(docs)


def mixed_sources(spark, docs, sf_dir):
    small_batches(spark)
    return pareto_mix.repeated(pareto_mix.mix(docs), docs.columns)


def encoded_documents(spark, docs, sf_dir):
    """The mixed documents with their token ids and the text these decode to."""
    small_batches(spark)
    return bpe.round_trip(docs, vocabulary("word_bpe_49k.json"), forget=True)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("source_mix", mixed_sources),
    ("bpe", encoded_documents),
]

# Learned language models and tokenizers are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    *stages, (_, last) = STAGES
    for _, stage in stages:
        docs = materialize(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
