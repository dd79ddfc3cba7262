"""Blind comparison of two models: pairing, prompts, verdicts, rates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import draw, strip
from pairloom.functions.verdicts import BASE, TIE, TUNED, other_model, unblind, verdict
from pairloom.operators.requests import fill_template

# A neutral frame; the last line names the fixed forms that `verdict` reads.
JUDGE_TEMPLATE = (
    "[question]\n{question}\n\n[reference]\n{reference}\n\n"
    "[answer A]\n{answer_a}\n\n[answer B]\n{answer_b}\n\n"
    "Verdict: A | Verdict: B | Verdict: Tie\n"
)


def place_blind(pairs: DataFrame, key="item_pos", seed=42) -> DataFrame:
    """Put the tuned model in place A or B by a draw on the row's key."""
    tuned_first = draw(F.col(key), seed, "place") < 0.5
    model_a = F.when(tuned_first, F.lit(TUNED)).otherwise(F.lit(BASE))
    tuned, base = F.col("tuned_answer"), F.col("base_answer")
    return pairs.withColumns({
        "model_a": model_a,
        "model_b": other_model(model_a),
        "answer_a": F.when(tuned_first, tuned).otherwise(base),
        "answer_b": F.when(tuned_first, base).otherwise(tuned),
    })


def judge_prompt(question, reference, answer_a, answer_b, template=JUDGE_TEMPLATE):
    return fill_template(
        template, question=question, reference=reference, answer_a=answer_a, answer_b=answer_b
    )


def judge_pairs(base: DataFrame, tuned: DataFrame, seed=42, template=JUDGE_TEMPLATE) -> DataFrame:
    """Judge requests for positions both models have, with two non-empty answers."""
    b = base.filter(F.length("predicted_answer") > 0).select(
        "item_pos", "question", "reference_answer", F.col("predicted_answer").alias("base_answer")
    )
    t = tuned.filter(F.length("predicted_answer") > 0).select(
        "item_pos", F.col("predicted_answer").alias("tuned_answer")
    )
    placed = place_blind(b.join(t, "item_pos"), "item_pos", seed)
    prompt = judge_prompt(
        F.col("question"), F.col("reference_answer"), F.col("answer_a"), F.col("answer_b"), template
    )
    return placed.select(
        "item_pos", "question", "model_a", "model_b", "answer_a", "answer_b",
        prompt.alias("prompt"),
    )


def judge_pending(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Judge requests whose position has no stored verdict."""
    return pairs.join(verdicts.select("item_pos"), "item_pos", "left_anti")


def verdicts(pairs: DataFrame, responses: DataFrame) -> DataFrame:
    """Verdict records from judge requests and responses (item_pos, explanation).

    A failed call, without a text or with an error (where there is such a column), gives
    no record, so its item is asked again. A text without a verdict line gives three false.
    """
    said = responses.filter(F.col("explanation").isNotNull())
    if "error" in responses.columns:
        said = said.filter(F.col("error").isNull())
    joined = pairs.join(said.select("item_pos", "explanation"), "item_pos").withColumn(
        "judge_explanation", strip(F.col("explanation"))
    )
    winner = unblind(verdict(F.col("judge_explanation")), F.col("model_a"))
    return joined.withColumn("winner", winner).select(
        "item_pos", "question", "model_a", "model_b", "answer_a", "answer_b",
        (F.col("winner") == TUNED).alias("ft_won"),
        (F.col("winner") == BASE).alias("base_won"),
        (F.col("winner") == TIE).alias("tie"),
        "judge_explanation",
    )


def judge_rates(records: DataFrame) -> DataFrame:
    """Wins, ties and their percentages of all records, unparsable ones included."""
    flags = ("ft_won", "base_won", "tie")
    total = F.count(F.lit(1))

    def rate(flag):
        # Without records the rate is 0.
        return F.when(total > 0, F.count_if(F.col(flag)) / total * 100).otherwise(0.0)

    return records.agg(
        total.alias("total"),
        *[F.count_if(F.col(flag)).alias(f"{flag}_count") for flag in flags],
        *[rate(flag).alias(f"{flag}_rate") for flag in flags],
    )
