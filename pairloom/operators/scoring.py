"""Evaluation items, prompts, scored outputs and model reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import answers as A
from pairloom.functions.chat import TURN_END, TURN_START, turn_text
from pairloom.functions.text import text_or_empty, token_count
from pairloom.operators.ordered import first_rows, with_position
from pairloom.session import materialize

# The prompt in force by default, and the letters of the choices.
DEFAULT_SYSTEM_PROMPT = "You are a helpful AI assistant."
LETTERS = ("A", "B", "C", "D")
CHOICE_SYSTEM_PROMPT = (
    "Choices are labelled A, B, C and D. Put the label you choose into \\boxed{}."
)


def eval_items(items: DataFrame, max_items=100, order_by=None) -> DataFrame:
    """The first `max_items` items, all of them for None.

    Items without a stored position are numbered in the order of `order_by`;
    only the top of that order is, not the whole table.
    """
    if max_items is None:
        return items if "item_pos" in items.columns else with_position(items, order_by)
    if "item_pos" not in items.columns:
        return with_position(first_rows(items, order_by, max_items), order_by)
    return items.filter(F.col("item_pos") < max_items)


def mcq_items(items: DataFrame) -> DataFrame:
    """Multiple-choice items laid out as a question text and a reference letter."""
    lines = [F.lit("\n\n")]
    for i, letter in enumerate(LETTERS):
        lines += [
            F.lit(f"{letter}) "), text_or_empty(F.get("choices", F.lit(i))),
            F.lit("\n" if i < 3 else ""),
        ]
    letters = F.array(*[F.lit(letter) for letter in LETTERS])
    return items.select(
        F.lit(A.MULTIPLE_CHOICE).alias("benchmark"), "item_pos",
        F.concat("question", *lines).alias("question"),
        F.get(letters, F.col("answer")).alias("reference"),
    )


def open_items(items: DataFrame) -> DataFrame:
    """Held-out pairs as items; the reference is the enriched answer."""
    return items.select(
        F.lit(A.OPEN_QA).alias("benchmark"), "item_pos",
        F.col("question_body").alias("question"), F.col("enriched_answer").alias("reference"),
    )


def math_items(items: DataFrame) -> DataFrame:
    """Word problems as items; the reference is the marked number of the answer."""
    return items.select(
        F.lit(A.MATH).alias("benchmark"), "item_pos", "question",
        A.reference_answer(F.col("answer").cast("string")).alias("reference"),
    )


def eval_prompts(items: DataFrame, system_prompt=DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """Add `prompt`. Multiple choice swaps its own system prompt in for the default."""
    system = F.lit(system_prompt)
    if system_prompt == DEFAULT_SYSTEM_PROMPT:
        choice = F.col("benchmark") == A.MULTIPLE_CHOICE
        system = F.when(choice, F.lit(CHOICE_SYSTEM_PROMPT)).otherwise(system)
    prompt = F.concat(
        turn_text(F.lit("system"), system), turn_text(F.lit("user"), F.col("question")),
        F.lit(TURN_START + "assistant\n"),
    )
    return items.withColumn("prompt", prompt)


STOP = TURN_END


def eval_pending(items: DataFrame, results: DataFrame) -> DataFrame:
    """Items without a stored result of the same benchmark, model and position."""
    done = results.select("benchmark", "model", "item_pos")
    return items.join(done, ["benchmark", "model", "item_pos"], "left_anti")


def extract_answers(outputs: DataFrame, strict=False) -> DataFrame:
    """Add trace, answer part and prediction to raw outputs with a `benchmark`."""
    parts = outputs.withColumns({
        "thinking_trace": A.thinking_trace(F.col("raw_output")),
        "answer_part": A.answer_part(F.col("raw_output")),
    })
    answer = F.col("answer_part")
    stated = (
        F.when(A.unclosed(F.col("raw_output")), F.lit(None).cast("string"))
        .when(F.col("benchmark") == A.OPEN_QA, answer)
        .when(F.col("benchmark") == A.MULTIPLE_CHOICE, A.mcq_answer(answer))
        .otherwise(A.stated_answer(answer, strict))
    )
    # A column of its own, so the search above is not repeated below.
    parts = parts.withColumn("_stated", stated)
    is_number = ~F.col("benchmark").isin(A.OPEN_QA, A.MULTIPLE_CHOICE)
    predicted = F.when(is_number, A.clean_number(F.col("_stated"))).otherwise(F.col("_stated"))
    return parts.withColumn("predicted_answer", predicted).drop("_stated")


def score_outputs(outputs: DataFrame, items: DataFrame, counter=None, strict=False,
                  benchmark=None) -> DataFrame:
    """Evaluation results from raw outputs and their items (question, reference).

    Only raw outputs meet the items; answers are parts of them and are extracted after the join,
    so that no text moves twice. Outputs of a single `benchmark` need no such column: its name
    joins no shuffle, so a query that scores them against several benchmarks moves them once.
    """
    given = outputs.select("model", "item_pos", "time_seconds", "raw_output",
                           *(["benchmark"] if benchmark is None else []))
    if benchmark is None:
        met = given.join(items, ["benchmark", "item_pos"])
    else:
        mine = items.filter(F.col("benchmark") == benchmark).drop("benchmark")
        met = given.join(mine, "item_pos").withColumn("benchmark", F.lit(benchmark))
    parts = extract_answers(met, strict)
    return parts.select(
        "benchmark", "model", "item_pos", "question",
        F.col("reference").alias("reference_answer"), "predicted_answer",
        A.exact_match(
            F.col("reference"), F.col("predicted_answer"), F.col("benchmark"), strict
        ).alias("is_correct"),
        token_count(F.col("thinking_trace"), counter).alias("thinking_tokens"),
        token_count(F.col("answer_part"), counter).alias("answer_tokens"),
        "time_seconds", "raw_output",
    )


BASE, TUNED = "base", "ft"
REPORTED = {
    "correct": "is_correct", "think_tokens": "thinking_tokens", "ans_tokens": "answer_tokens",
    "time": "time_seconds",
}


def union_models(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """Results of both models in one table, told apart by `model`."""
    named = base.withColumn("model", F.lit(BASE))
    return named.unionByName(tuned.withColumn("model", F.lit(TUNED)))


def model_summary(results: DataFrame, by=("model",), models=None) -> DataFrame:
    """Accuracy in percent over scored items, and mean tokens and seconds.

    Models named in `models` are reported with zeros when they have no results.
    """
    def mean(col):
        return F.coalesce(F.avg(col), F.lit(0.0))

    summary = results.groupBy(*by).agg(
        (mean(F.col("is_correct").cast("int")) * 100).alias("accuracy"),
        mean("thinking_tokens").alias("avg_thinking_tokens"),
        mean("answer_tokens").alias("avg_answer_tokens"),
        mean("time_seconds").alias("avg_time_seconds"),
    )
    if models is None:
        return summary
    named = results.sparkSession.createDataFrame([(m,) for m in models], "model string")
    return named.join(summary, "model", "left").fillna(0.0)


def model_comparison(results: DataFrame) -> DataFrame:
    """Both models of one result table side by side by position, rows of only one included.

    One conditional aggregate per position, so the results are read and scored once. The
    question text comes from the base results. Without results of one model there is no report.
    """
    def of(model, value):
        return F.max(F.when(F.col("model") == model, value))

    values = F.struct(*REPORTED.values())
    rows = results.filter(F.col("model").isin(BASE, TUNED)).groupBy("item_pos").agg(
        of(BASE, F.struct("question")).alias("asked"),
        of(BASE, values).alias(BASE), of(TUNED, values).alias(TUNED),
    )
    rows = materialize(rows)
    both = rows.agg(*[F.count(F.col(model)) for model in (BASE, TUNED)]).first()
    return rows.filter(F.lit(all(both))).select(
        "item_pos", "asked.question",
        *[F.col(f"{m}.{c}").alias(f"{m}_{name}") for m in (BASE, TUNED) for name, c in REPORTED.items()],
    )


def compare_models(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """`model_comparison` of two tables with the results of one model each."""
    return model_comparison(union_models(base, tuned))
