"""Request tables for enrichment and traces.

The model calls are a table boundary: requests go out, responses come back.
Templates are parameters; the default ones only label their slots.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import clean_html
from pairloom.operators.ordered import HOT_ROWS, HOT_TEXT_ROWS, SEGMENT_ROWS
from pairloom.operators.requests import (
    NO_COMMENTS,
    cap_pending,
    comment_block,
    comment_parts,
    fill_template,
    pair_texts,
    resume_pending,
)
from pairloom.session import materialize

# Neutral frames: what a model is to do with the slots is for the caller to say.
ENRICH_TEMPLATE = (
    "[title]\n{title}\n\n[question]\n{body}\n\n[comments]\n{comments}\n\n[answer]\n{answer}\n"
)
TRACE_TEMPLATE = "[question]\n{question}\n\n[answer]\n{answer}\n"


def _pending(pairs, processed, max_items):
    """Ids of the pending pairs, stored: every branch of a request table starts from them."""
    pending = pairs.select("ParentId", "Id")
    if processed is not None:
        pending = resume_pending(pending, processed)
    return cap_pending(materialize(pending), max_items)


def _cleaned(pending, posts):
    """Record fields of pending pairs; texts are cleaned after the joins.

    Only the posts that are named go into the joins: a semi join on ids may be broadcast, an
    outer join with all bodies on its right may not.
    """
    ids = pending.select(F.col("ParentId").alias("_named")).union(pending.select("Id")).distinct()
    named = posts.join(ids, posts["Id"] == ids["_named"], "left_semi")
    return pair_texts(pending, named, default="").select(
        F.col("ParentId").alias("question_id"),
        F.col("Id").alias("answer_id"),
        clean_html(F.col("Title")).alias("title"),
        clean_html(F.col("QuestionBody")).alias("question_body"),
        clean_html(F.col("AnswerBody")).alias("original_answer"),
        F.col("Tags").alias("tags"),
    )


def _target_ids(pending):
    return pending.select(F.col("ParentId").alias("PostId"))


def _slots(**more):
    fields = {"title": "title", "body": "question_body", "answer": "original_answer"}
    return {slot: F.col(column) for slot, column in {**fields, **more}.items()}


def enrich_requests(
    pairs: DataFrame, posts: DataFrame, comments: DataFrame, template=ENRICH_TEMPLATE,
    processed: DataFrame = None, max_items=None, hot_rows=HOT_TEXT_ROWS,
) -> DataFrame:
    """One request per pair that is still pending, with the texts of its record."""
    pending = _pending(pairs, processed, max_items)
    records = _cleaned(pending, posts)
    blocks = comment_block(comments, _target_ids(pending), hot_rows)
    blocks = blocks.withColumnRenamed("PostId", "_post")
    joined = records.join(blocks, records["question_id"] == blocks["_post"], "left")
    shown = joined.withColumn("_comments", F.coalesce("comment_block", F.lit(NO_COMMENTS)))
    prompt = fill_template(template, **_slots(comments="_comments"))
    return shown.select(*records.columns, prompt.alias("prompt"))


def enrich_request_parts(
    pairs: DataFrame, posts: DataFrame, comments: DataFrame, template=ENRICH_TEMPLATE,
    processed: DataFrame = None, max_items=None, part_rows=SEGMENT_ROWS, hot_rows=HOT_ROWS,
) -> DataFrame:
    """The prompts of `enrich_requests` in parts, for questions with any number of comments.

    The parts of a request in order are its prompt: the template up to the
    comments, the comments, and the rest of the template. Only ids meet the
    comment parts, so no text is repeated per part.
    """
    if template.count("{comments}") != 1:
        raise ValueError("the template needs one {comments} slot")
    pending = _pending(pairs, processed, max_items)
    head, _, tail = template.partition("{comments}")
    records = _cleaned(pending, posts)
    keys = ["question_id", "answer_id"]
    ends = records.select(
        *keys,
        F.explode(F.array(
            F.struct(F.lit(0).alias("section"), fill_template(head, **_slots()).alias("text")),
            F.struct(F.lit(2).alias("section"), fill_template(tail, **_slots()).alias("text")),
        )).alias("end"),
    ).select(*keys, "end.section", F.lit(0).cast("bigint").alias("part"), "end.text")

    parts = comment_parts(comments, _target_ids(pending), part_rows, hot_rows)
    parts = parts.withColumnRenamed("PostId", "_post")
    asked = pending.select(F.col("ParentId").alias(keys[0]), F.col("Id").alias(keys[1]))
    middle = asked.join(parts, asked["question_id"] == parts["_post"], "left").select(
        *keys, F.lit(1).alias("section"), F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("comment_block", F.lit(NO_COMMENTS)).alias("text"),
    )
    return ends.unionByName(middle)


def trace_requests(
    enriched: DataFrame, template=TRACE_TEMPLATE, processed: DataFrame = None, max_items=None
) -> DataFrame:
    """One trace request per enriched pair that is still pending."""
    pending = enriched
    if processed is not None:
        pending = resume_pending(pending, processed, "question_id")
    pending = cap_pending(pending, max_items, "question_id", zero_is_no_cap=False)
    prompt = fill_template(
        template, question=F.col("question_body"), answer=F.col("enriched_answer")
    )
    return pending.withColumn("prompt", prompt)
