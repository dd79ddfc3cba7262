"""Votes, posts and the best answer of each question."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.quality import has_image, vote_ok
from pairloom.functions.text import html_text_length

QUESTION, ANSWER = "1", "2"
UPVOTE, DOWNVOTE = 2, 3


def questions(posts: DataFrame) -> DataFrame:
    rows = posts.filter(F.col("PostTypeId") == QUESTION)
    return rows.select("Id", "Title", "Body", "Tags", "Score")


def answers(posts: DataFrame) -> DataFrame:
    rows = posts.filter(F.col("PostTypeId") == ANSWER)
    return rows.select("Id", "ParentId", "Body", "Score")


def split_posts(posts: DataFrame):
    """Questions and answers; posts of any other type belong to neither."""
    return questions(posts), answers(posts)


def up_down_votes(votes: DataFrame) -> DataFrame:
    """Keep upvotes and downvotes, with the type as a number."""
    kind = F.col("VoteTypeId").cast("string")
    rows = votes.filter(kind.isin(str(UPVOTE), str(DOWNVOTE)))
    return rows.select("PostId", kind.cast("int").alias("VoteTypeId"))


def vote_counts(votes: DataFrame) -> DataFrame:
    """Upvotes and downvotes per post: one aggregate, combined before its shuffle."""
    return votes.groupBy("PostId").agg(
        F.count_if(F.col("VoteTypeId") == UPVOTE).alias("Upvotes"),
        F.count_if(F.col("VoteTypeId") == DOWNVOTE).alias("Downvotes"),
    )


def post_vote_counts(posts: DataFrame, votes: DataFrame) -> DataFrame:
    """Posts with their vote counts; a post without votes counts 0."""
    return with_vote_counts(posts, vote_counts(votes))


def with_vote_counts(posts: DataFrame, counts: DataFrame) -> DataFrame:
    """`post_vote_counts` from votes that are counted already."""
    counts = counts.withColumnRenamed("PostId", "_post")
    joined = posts.join(counts, posts["Id"] == counts["_post"], "left").drop("_post")
    return joined.fillna(0, ["Upvotes", "Downvotes"])


def vote_quality(scored: DataFrame, min_upvotes=5, max_downvote_ratio=0.3) -> DataFrame:
    return scored.filter(vote_ok(min_upvotes, max_downvote_ratio))


def answers_of_good_questions(all_answers: DataFrame, good: DataFrame) -> DataFrame:
    """Answers whose question is among `good` (a table with an `Id`)."""
    ids = good.select(F.col("Id").alias("_question"))
    return all_answers.join(ids, all_answers["ParentId"] == ids["_question"], "left_semi")


def top_answer_ids(scored: DataFrame, fill_nulls=True) -> DataFrame:
    """Best answer per question without its text: most upvotes, then lowest Id.

    A maximum of narrow structs instead of a sorted window, so a question with
    a third of all answers is reduced on the map side. `BodyId` names the answer
    that supplies the body. With `fill_nulls` a missing body or score comes from
    the next answer in the order that has one.
    `scored` has ParentId, Id, Score, Upvotes, Downvotes and either `has_body`
    or `Body`.
    """
    if "has_body" not in scored.columns:
        scored = scored.withColumn("has_body", F.col("Body").isNotNull())
    rank = [F.col("Upvotes").alias("up"), (-F.col("Id")).alias("neg_id")]
    best = F.max(F.struct(*rank, F.col("Downvotes").alias("down"), F.col("Score").alias("score")))
    picked = [best.alias("top")]
    score, body_id = F.col("top.score"), -F.col("top.neg_id")
    if fill_nulls:
        with_score = F.when(
            F.col("Score").isNotNull(), F.struct(*rank, F.col("Score").alias("score"))
        )
        with_body = F.when(F.col("has_body"), F.struct(*rank))
        picked += [F.max(with_score).alias("scored"), F.max(with_body).alias("bodied")]
        score, body_id = F.col("scored.score"), -F.col("bodied.neg_id")
    # A missing ParentId names no question.
    groups = scored.filter(F.col("ParentId").isNotNull()).groupBy("ParentId").agg(*picked)
    return groups.select(
        "ParentId",
        (-F.col("top.neg_id")).alias("Id"),
        body_id.alias("BodyId"),
        score.alias("Score"),
        F.col("top.up").alias("Upvotes"),
        F.col("top.down").alias("Downvotes"),
    )


def top_answer(scored: DataFrame, fill_nulls=True, bodies: DataFrame = None) -> DataFrame:
    """Best answer per question with its body.

    `bodies` (Id, Body) defaults to `scored`; pass the unscored posts to avoid
    counting votes twice.
    """
    top = top_answer_ids(scored, fill_nulls)
    texts = (scored if bodies is None else bodies).select(F.col("Id").alias("_id"), "Body")
    joined = top.join(texts, top["BodyId"] == texts["_id"], "left")
    return joined.select("ParentId", "Id", "Body", "Score", "Upvotes", "Downvotes")


def no_images(posts: DataFrame) -> DataFrame:
    return posts.filter(~has_image(F.col("Body")))


def drop_image_pairs(pairs: DataFrame, posts: DataFrame) -> DataFrame:
    """Drop pairs with an image on either side.

    Bodies are tested in the scan; only the ids of posts with images move.
    """
    imaged = posts.filter(has_image(F.col("Body")))
    for key, side in (("ParentId", questions(imaged)), ("Id", answers(imaged))):
        ids = side.select(F.col("Id").alias("_imaged"))
        pairs = pairs.join(ids, pairs[key] == ids["_imaged"], "left_anti")
    return pairs


def pair_lengths(pairs: DataFrame, posts: DataFrame) -> DataFrame:
    """Add the visible lengths of both sides; null for a post that is missing.

    Bodies become lengths in the scan; only those move.
    """
    sides = (("ParentId", "QuestionLength", questions(posts)), ("Id", "AnswerLength", answers(posts)))
    for key, name, side in sides:
        lengths = text_lengths(side).toDF("_post", name)
        pairs = pairs.join(lengths, pairs[key] == lengths["_post"], "left").drop("_post")
    return pairs


def min_length(pairs: DataFrame, n=300) -> DataFrame:
    """Both visible lengths at least `n`."""
    return pairs.filter((F.col("QuestionLength") >= n) & (F.col("AnswerLength") >= n))


def text_lengths(posts: DataFrame) -> DataFrame:
    return posts.select("Id", html_text_length(F.col("Body")).alias("TextLength"))


def duplicate_ids(posts: DataFrame, key="Id") -> DataFrame:
    """Data-quality check: keys that occur more than once, with their counts."""
    counts = posts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)
