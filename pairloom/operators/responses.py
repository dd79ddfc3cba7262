"""Response side of the model calls: status, merge, accumulation, audit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import strip, token_count

OK, TRUNCATED, QUOTA, FAILED = "ok", "truncated", "quota", "failed"
# Error texts that mean the quota is used up.
QUOTA_ERRORS = "quota|insufficient|429"


def is_truncated(finish_reason):
    return F.coalesce(finish_reason == "length", F.lit(False))


def response_status(finish_reason, error):
    return (
        F.when(F.lower(error).rlike(QUOTA_ERRORS), QUOTA)
        .when(error.isNotNull(), FAILED)
        .when(is_truncated(finish_reason), TRUNCATED)
        .otherwise(OK)
    )


def with_status(responses: DataFrame) -> DataFrame:
    return responses.withColumn(
        "status", response_status(F.col("finish_reason"), F.col("error"))
    )


def response_status_counts(responses: DataFrame) -> DataFrame:
    return with_status(responses).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def processed_ids(responses: DataFrame) -> DataFrame:
    """Ids that are never asked again: answered ones, even when truncated."""
    done = with_status(responses).filter(F.col("status").isin(OK, TRUNCATED))
    return done.select("question_id").distinct()


def merge_enriched(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Enriched pairs from requests and their complete responses.

    Truncated and failed responses give no record. Both sides have one row per
    question.
    """
    complete = with_status(responses).filter(F.col("status") == OK)
    answers = complete.select("question_id", F.col("content").alias("enriched_answer"))
    return requests.join(answers, "question_id").select(
        "question_id", "answer_id", "title", "question_body", "original_answer",
        "enriched_answer", "tags",
    )


def merge_traces(enriched: DataFrame, responses: DataFrame) -> DataFrame:
    """Enriched pairs with their traces; truncated traces are kept and flagged."""
    usable = responses.filter(F.col("error").isNull() & F.col("content").isNotNull())
    traces = usable.select(
        "question_id",
        strip(F.col("content")).alias("thinking_trace_re"),
        is_truncated(F.col("finish_reason")).alias("trace_truncated"),
    )
    joined = enriched.join(traces, "question_id")
    return joined.select(*enriched.columns, "thinking_trace_re", "trace_truncated")


def accumulate(old: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier and new outputs together; repeated rows stay."""
    return old.unionByName(new)


def with_trace(traced: DataFrame) -> DataFrame:
    return traced.filter(F.length("thinking_trace_re") > 0)


def token_audit(traced: DataFrame, counter=None) -> DataFrame:
    """One row of token statistics over non-empty traces; no row without any.

    The exact median keeps a count per distinct trace length, not the rows.
    """
    flagged = F.coalesce(F.col("trace_truncated"), F.lit(False)).alias("flag")
    counts = with_trace(traced).select(
        token_count(F.col("thinking_trace_re"), counter).alias("t"), flagged
    )
    stats = counts.agg(
        F.count(F.lit(1)).alias("total_traces"),
        F.count_if(F.col("flag")).alias("truncated_count"),
        F.round(F.avg("t"), 2).alias("avg_tokens"),
        F.floor(F.percentile("t", F.lit(0.5))).cast("bigint").alias("median_tokens"),
        F.min("t").alias("min_tokens"),
        F.max("t").alias("max_tokens"),
        F.sum("t").alias("total_tokens"),
    )
    return stats.filter(F.col("total_traces") > 0)


def truncated_ids(traced: DataFrame) -> DataFrame:
    return with_trace(traced).filter("trace_truncated").select("question_id")
