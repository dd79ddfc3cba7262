"""Traced pairs to packed training sequences."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import draw, token_count
from pairloom.operators.training import (
    MAX_TOKENS,
    SYSTEM_PROMPT,
    chat_records,
    drop_truncated,
    has_trace,
    pack_sequences,
    trace_kept,
)
from pairloom.session import materialize

# A shard's line of narrow rows is summed in one task.
ROWS_PER_SHARD = 500_000


def even_shard(key, shards, seed=42):
    """Shard number of a row by a draw on its key, so no shard is larger than others."""
    return F.floor(draw(F.col(key), seed, "shard") * shards).cast("bigint")


def counted_texts(
    train: DataFrame, key="question_id", drop_prob=0.0, seed=42, counter=None,
    system_prompt=SYSTEM_PROMPT,
) -> DataFrame:
    """Stored rows: `key`, `_row`, the final `text`, its `n_tokens` and `full_tokens` with its trace.

    Every text is built and counted once: a text whose trace is dropped is counted with and
    without it, the others only with it. `_row` is unique, so keys may have copies.
    """
    rows = drop_truncated(train)
    kept = trace_kept(key, drop_prob, seed)
    full = chat_records(rows, system_prompt).withColumnRenamed("text", "_full").drop("messages")
    final = chat_records(full, system_prompt, kept)
    shorter = has_trace() & ~kept
    stored = materialize(final.select(
        key, F.monotonically_increasing_id().alias("_row"), "text", shorter.alias("_shorter"),
        token_count(F.col("_full"), counter).alias("full_tokens"),
        token_count(F.when(shorter, F.col("text")), counter).alias("_own_tokens"),
    ))
    n_tokens = F.when(F.col("_shorter"), F.col("_own_tokens")).otherwise(F.col("full_tokens"))
    return stored.select(key, "_row", "text", n_tokens.alias("n_tokens"), "full_tokens")


def training_sequences(
    train: DataFrame, key="question_id", drop_prob=0.0, seed=42, max_tokens=MAX_TOKENS,
    block=MAX_TOKENS, shards=None, counter=None, system_prompt=SYSTEM_PROMPT,
    rows_per_shard=ROWS_PER_SHARD,
) -> DataFrame:
    """Filter, format and pack training rows.

    The budget is checked on the text with its trace, before traces are dropped. Texts are stored
    once; only keys and token counts are shuffled to find the blocks, and the texts meet them in
    one join at the end. The number of shards follows from the number of rows, unless it is given.
    """
    stored = counted_texts(train, key, drop_prob, seed, counter, system_prompt)
    fits = stored.filter(F.col("full_tokens") <= max_tokens)
    shards = shards or max(1, -(-fits.count() // rows_per_shard))
    narrow = fits.select(key, "_row", even_shard(key, shards, seed).alias("shard"), "n_tokens")
    packed = pack_sequences(narrow, "shard", [key, "_row"], "n_tokens", block)
    texts = stored.select("_row", "text")
    return packed.join(texts, "_row").select(
        key, "shard", "text", "n_tokens", "end_token", "start_block", "end_block")
