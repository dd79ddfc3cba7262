"""Training records: filters, chat texts, trace dropping, packing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import chat
from pairloom.functions.text import draw, text_or_empty, token_count
from pairloom.operators.ordered import (
    HOT_ROWS,
    HOT_TEXT_ROWS,
    SEGMENT_ROWS,
    ordered_parts,
    ordered_text,
    running_total,
)
from pairloom.operators.parts import PART_BYTES, byte_parts

SYSTEM_PROMPT = "Answer the question."
MAX_TOKENS = 7168


def drop_truncated(df: DataFrame) -> DataFrame:
    """Rows whose trace is not flagged as truncated; no flag means it is not."""
    return df.filter(~F.coalesce(F.col("trace_truncated"), F.lit(False)))


def has_trace():
    return F.length(text_or_empty(F.col("thinking_trace_re"))) > 0


def chat_records(df: DataFrame, system_prompt=SYSTEM_PROMPT, keep_trace=None) -> DataFrame:
    """Add `messages` and their serialized `text`.

    `keep_trace` is an optional boolean column; where it is false the reasoning
    span is emptied but stays.
    """
    question = chat.question_text(F.col("title"), F.col("question_body"))
    answer = chat.assistant_text(F.col("enriched_answer"), F.col("thinking_trace_re"), keep_trace)
    with_messages = df.withColumn("messages", chat.messages(system_prompt, question, answer))
    return with_messages.withColumn("text", chat.chat_serialize(F.col("messages")))


def full_tokens(df: DataFrame, system_prompt=SYSTEM_PROMPT, counter=None) -> DataFrame:
    """Add `n_tokens` of the whole chat text, trace included."""
    counted = chat_records(df, system_prompt)
    counted = counted.withColumn("n_tokens", token_count(F.col("text"), counter))
    return counted.select(*df.columns, "n_tokens")


def within_budget(
    train: DataFrame, max_tokens=MAX_TOKENS, counter=None, system_prompt=SYSTEM_PROMPT
) -> DataFrame:
    """Training rows whose whole chat text fits the budget."""
    fits = full_tokens(train, system_prompt, counter).filter(F.col("n_tokens") <= max_tokens)
    return fits.select(*train.columns)


def train_profile(
    train: DataFrame, max_tokens=MAX_TOKENS, counter=None, system_prompt=SYSTEM_PROMPT
) -> DataFrame:
    """Counts before and after the budget: raw, kept, with and without trace, too long."""
    kept = F.col("n_tokens") <= max_tokens
    return full_tokens(train, system_prompt, counter).agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(kept).alias("kept"),
        F.count_if(kept & has_trace()).alias("with_trace"),
        F.count_if(kept & ~has_trace()).alias("without_trace"),
        F.count_if(~kept).alias("too_long"),
    )


def trace_kept(key, prob=0.0, seed=42):
    """False with probability `prob`, by a draw on the row's key."""
    return draw(F.col(key), seed, "drop") >= F.lit(float(prob))


def drop_trace(df: DataFrame, key="question_id", prob=0.0, seed=42) -> DataFrame:
    """Add `trace_dropped`: a trace exists and its draw is below `prob`."""
    return df.withColumn("trace_dropped", has_trace() & ~trace_kept(key, prob, seed))


def training_texts(
    df: DataFrame, key="question_id", prob=0.0, seed=42, system_prompt=SYSTEM_PROMPT
) -> DataFrame:
    """Final chat texts with traces dropped at random, repeatably."""
    return chat_records(df, system_prompt, trace_kept(key, prob, seed))


def serialize_turns(
    turns: DataFrame, by="conv_id", order_by="turn", turn=chat.turn_text,
    hot_rows=HOT_TEXT_ROWS, slices=None,
) -> DataFrame:
    """Turn rows (role, text) to one serialized text per conversation."""
    rows = turns.select(by, order_by, "role", "text")
    return ordered_text(
        rows, [by], [order_by], lambda get, number: turn(get("role"), get("text")), "chat",
        hot_rows=hot_rows, slices=slices,
    )


def turn_parts(
    turns: DataFrame, by="conv_id", order_by="turn", turn=chat.turn_text,
    part_rows=SEGMENT_ROWS, hot_rows=HOT_ROWS, slices=None,
) -> DataFrame:
    """The texts of `serialize_turns` in numbered parts, for conversations of any size."""
    rows = turns.select(by, order_by, "role", "text")
    return ordered_parts(
        rows, [by], [order_by], lambda get, number: turn(get("role"), get("text")), "chat",
        part_rows=part_rows, hot_rows=hot_rows, slices=slices,
    )


def turn_byte_parts(
    turns: DataFrame, by="conv_id", order_by="turn", turn=chat.turn_text, part_bytes=PART_BYTES,
    hot_rows=HOT_ROWS, slices=None,
) -> DataFrame:
    """The texts of `serialize_turns` in parts of bounded bytes, for turns of any size."""
    rows = turns.select(by, order_by, "role", "text")
    return byte_parts(
        rows, [by], [order_by], lambda get, number: turn(get("role"), get("text")), "chat",
        part_bytes=part_bytes, hot_rows=hot_rows, slices=slices,
    )


def supervised_turns(turns: DataFrame, by="conv_id", counter=None) -> DataFrame:
    """Tokens per conversation that count for the loss, and tokens that do not."""
    counted = turns.select(
        by, chat.is_assistant(F.col("role")).alias("_own"),
        token_count(F.col("text"), counter).alias("_n"),
    )
    zero = F.lit(0).cast("bigint")
    return counted.groupBy(by).agg(
        F.sum(F.when(F.col("_own"), F.col("_n")).otherwise(zero)).alias("supervised"),
        F.sum(F.when(~F.col("_own"), F.col("_n")).otherwise(zero)).alias("masked"),
    )


def pack_sequences(
    df: DataFrame, shard, order_by, tokens, block=MAX_TOKENS, hot_rows=HOT_ROWS, slices=None
) -> DataFrame:
    """Place the rows of each shard end to end and cut the line into blocks.

    `order_by` is a column or a list of them. The rows are sorted with all their columns, so
    they should be narrow.

    Adds the first and last block a row falls into and the running end position.
    Every shard restarts at 0. Rows without tokens lie in the block they touch.
    """
    placed = running_total(
        df, [shard], [order_by] if isinstance(order_by, str) else order_by, F.col(tokens),
        "end_token", hot_rows=hot_rows, slices=slices,
    )
    # `div` keeps long positions exact.
    return placed.withColumns({
        "start_block": F.expr(f"(end_token - `{tokens}`) div {int(block)}L"),
        "end_block": F.expr(
            f"greatest(end_token - 1, end_token - `{tokens}`) div {int(block)}L"
        ),
    })
