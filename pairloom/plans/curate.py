"""Dump tables to curated question-answer pairs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.quality import has_image
from pairloom.functions.text import html_text_length
from pairloom.operators.votes import (
    answers,
    questions,
    top_answer_ids,
    up_down_votes,
    vote_counts,
    vote_quality,
    with_vote_counts,
)
from pairloom.session import materialize


def curate_pairs(
    posts: DataFrame, votes: DataFrame, min_upvotes=5, max_downvote_ratio=0.3,
    min_text=300, fill_nulls=True,
) -> DataFrame:
    """Question and its most upvoted answer, where both pass every filter.

    The best answer is chosen before its votes are checked: when it fails, the
    question is dropped and the runner-up is not tried.

    Votes, joins and the choice of the answer run on narrow rows: a question is
    reduced to its visible length in the scan, an answer to its votes. Votes are read and counted
    once, and the counts are stored for both kinds of posts. Only the bodies of answers
    are shuffled, once, to meet the survivors, behind cheap conditions that every final
    row meets (no image; raw length not below the wanted visible length). With posts
    bucketed on Id even that join moves no text.
    """
    qs, ans = questions(posts), answers(posts)
    quality = {"min_upvotes": min_upvotes, "max_downvote_ratio": max_downvote_ratio}
    body = F.col("Body")

    def usable(rows):
        rows = rows.filter(~has_image(body))
        return rows.filter(F.length(body) >= min_text) if min_text > 0 else rows

    lengths = usable(qs).select("Id", html_text_length(body).alias("QuestionLength"))
    lengths = lengths.filter(F.col("QuestionLength") >= min_text)
    counts = materialize(vote_counts(up_down_votes(votes)))

    good = vote_quality(with_vote_counts(lengths, counts), **quality)
    good = good.select(F.col("Id").alias("_question"), "QuestionLength")
    narrow = ans.select("Id", "ParentId", "Score", body.isNotNull().alias("has_body"))
    top = vote_quality(top_answer_ids(with_vote_counts(narrow, counts), fill_nulls), **quality)
    # One row per question on both sides, so this join cannot skew.
    top = top.join(good, top["ParentId"] == good["_question"])

    if min_text > 0:
        # A chosen answer without a body has length 0 and cannot pass.
        top = top.filter(F.col("BodyId") == F.col("Id"))
        texts, how = usable(ans), "inner"
    else:
        texts, how = ans, "left"
    texts = texts.select(F.col("Id").alias("_answer"), body)
    pairs = top.join(texts, top["BodyId"] == texts["_answer"], how)

    own_body = F.when(F.col("BodyId") == F.col("Id"), body)
    pairs = pairs.filter(~has_image(own_body)).select(
        "ParentId", "Id", "Body", "Score", "Upvotes", "Downvotes", "QuestionLength",
        html_text_length(own_body).alias("AnswerLength"),
    )
    return pairs.filter(F.col("AnswerLength") >= min_text)
