"""Scored results of two models to reports and judge requests."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.judging import judge_pairs, judge_pending
from pairloom.operators.scoring import model_comparison, model_summary


def model_results(results: DataFrame, model) -> DataFrame:
    return results.filter(F.col("model") == model)


def reports(results: DataFrame):
    """`(summary, comparison)` of the models `base` and `ft`."""
    return model_summary(results, models=("base", "ft")), model_comparison(results)


def judge_requests(
    results: DataFrame, verdicts: DataFrame = None, seed=42, expected=None
) -> DataFrame:
    """Blind judge requests for pairs without a stored verdict.

    With `expected` there are none until both models have that many results.
    """
    base, tuned = model_results(results, "base"), model_results(results, "ft")
    pairs = judge_pairs(base, tuned, seed)
    if expected is not None:
        for side in (base, tuned):
            pairs = pairs.filter(side.agg(F.count(F.lit(1))).scalar() >= expected)
    return pairs if verdicts is None else judge_pending(pairs, verdicts)
