"""Request side of enrichment: lookups, resume, caps, comment texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pairloom.functions.text import text_or_empty
from pairloom.operators.ordered import (
    HOT_ROWS,
    HOT_TEXT_ROWS,
    SEGMENT_ROWS,
    first_rows,
    ordered_parts,
    ordered_text,
)
from pairloom.operators.parts import PART_BYTES, byte_parts
from pairloom.operators.selection import smallest
from pairloom.operators.votes import answers, questions

NO_COMMENTS = "None"


def target_posts(posts: DataFrame, comments: DataFrame, targets: DataFrame):
    """Questions, answers and question comments that the targets name.

    `targets` has ParentId and Id. Semi joins: the optimizer broadcasts the ids
    when their measured size allows, and shuffles otherwise.
    """
    question_ids = targets.select(F.col("ParentId").alias("_qid"))
    answer_ids = targets.select(F.col("Id").alias("_aid"))
    qs, ans = questions(posts), answers(posts)
    return (
        qs.join(question_ids, qs["Id"] == question_ids["_qid"], "left_semi"),
        ans.join(answer_ids, ans["Id"] == answer_ids["_aid"], "left_semi"),
        comments.join(question_ids, comments["PostId"] == question_ids["_qid"], "left_semi"),
    )


def pair_texts(pairs: DataFrame, posts: DataFrame, default=None) -> DataFrame:
    """Pairs with the title, body and tags of the question and the answer's body.

    A text that is not found, or null, becomes `default` (null by default).
    """
    q = questions(posts).select(
        F.col("Id").alias("_qid"), "Title", F.col("Body").alias("QuestionBody"), "Tags"
    )
    a = answers(posts).select(F.col("Id").alias("_aid"), F.col("Body").alias("AnswerBody"))
    joined = pairs.join(q, pairs["ParentId"] == q["_qid"], "left")
    joined = joined.join(a, joined["Id"] == a["_aid"], "left")
    if default is not None:
        # A question that exists but has no tags keeps its null.
        missing = F.col("_qid").isNull()
        joined = joined.withColumn(
            "Tags", F.when(missing, F.lit(default)).otherwise(F.col("Tags"))
        ).fillna(default, ["Title", "QuestionBody", "AnswerBody"])
    kept = [pairs[c] for c in pairs.columns]
    return joined.select(*kept, "Title", "QuestionBody", "Tags", "AnswerBody")


def resume_pending(pairs: DataFrame, processed: DataFrame, key="ParentId") -> DataFrame:
    """Pairs whose key an earlier run has not processed.

    `processed` has one id column. A key repeated within this run is kept.
    """
    done = processed.select(F.col(processed.columns[0]).alias("_done"))
    return pairs.join(done, pairs[key] == done["_done"], "left_anti")


def cap_pending(pending: DataFrame, n, order_by="ParentId", zero_is_no_cap=True) -> DataFrame:
    """At most `n` requests of this run; None means all.

    The enrichment step reads 0 as no cap, the trace step
    (`zero_is_no_cap=False`) as nothing. Requests with the least ids are issued; the cap's id is found
    by counting, so `pending` is read a few times by its key and then filtered.
    """
    if n is None or (n == 0 and zero_is_no_cap):
        return pending
    if isinstance(pending.schema[order_by].dataType, IntegralType):
        return smallest(pending, order_by, n)
    return first_rows(pending, [order_by], n)


def _comment_rows(comments: DataFrame) -> DataFrame:
    return comments.filter(F.col("PostId").isNotNull()).select(
        "PostId", F.col("CreationDate").isNull().alias("_undated"),
        "CreationDate", "Text", "Score",
    )


def _comment_line(get, number):
    def shown(name):
        return F.coalesce(get(name).cast("string"), F.lit("None"))

    return F.concat(
        F.lit("[comment_"), number.cast("string"), F.lit("] (score="),
        shown("Score"), F.lit("): "), shown("Text"), F.lit("\n"),
    )


def comment_block(
    comments: DataFrame, targets: DataFrame = None, hot_rows=HOT_TEXT_ROWS, slices=None
) -> DataFrame:
    """Comments of each post as one numbered text, ordered by creation date.

    Dates are compared as text; a comment without one comes last. `targets`
    (with a PostId) restricts the posts.
    """
    return ordered_text(
        _comment_rows(comments), ["PostId"], ["_undated", "CreationDate"], _comment_line,
        "comment_block", keep=targets, hot_rows=hot_rows, slices=slices,
    )


def comment_parts(
    comments: DataFrame, targets: DataFrame = None, part_rows=SEGMENT_ROWS, hot_rows=HOT_ROWS,
    slices=None,
) -> DataFrame:
    """The texts of `comment_block` in numbered parts, for posts of any size."""
    return ordered_parts(
        _comment_rows(comments), ["PostId"], ["_undated", "CreationDate"], _comment_line,
        "comment_block", keep=targets, part_rows=part_rows, hot_rows=hot_rows, slices=slices,
    )


def comment_byte_parts(
    comments: DataFrame, targets: DataFrame = None, part_bytes=PART_BYTES, hot_rows=HOT_ROWS,
    slices=None,
) -> DataFrame:
    """The texts of `comment_block` in parts of bounded bytes, for posts and comments of any size."""
    return byte_parts(
        _comment_rows(comments), ["PostId"], ["_undated", "CreationDate"], _comment_line,
        "comment_block", keep=targets, part_bytes=part_bytes, hot_rows=hot_rows, slices=slices,
    )


def fill_template(template: str, **slots):
    """Text of a template whose `{slot}` marks are replaced by columns.

    Slot texts are never searched for further marks.
    """
    parts, rest = [], template
    while rest:
        found = [(rest.find("{%s}" % name), name) for name in slots]
        found = min(((at, name) for at, name in found if at >= 0), default=None)
        if found is None:
            parts.append(F.lit(rest))
            break
        at, name = found
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(text_or_empty(slots[name]))
        rest = rest[at + len(name) + 2:]
    return F.concat(*parts)
