"""The steps from dump files to reports, each from paths to paths.

A step that asks a model ends with a request table; the step after it starts from
the response table an external client has filled. Rerunning a step asks or appends
only what earlier runs have not.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.operators import responses as R
from pairloom.operators import scoring
from pairloom.operators.judging import judge_pending, judge_rates, verdicts
from pairloom.operators.requests import resume_pending
from pairloom.operators.selection import file_positions
from pairloom.operators.splits import split_exact, split_summary
from pairloom.operators.training import MAX_TOKENS, drop_truncated, train_profile, training_texts
from pairloom.operators.votes import duplicate_ids
from pairloom.plans.curate import curate_pairs
from pairloom.plans.enrich import ENRICH_TEMPLATE, TRACE_TEMPLATE, enrich_requests, trace_requests
from pairloom.plans.evaluate import judge_requests, reports
from pairloom.plans.train import training_sequences
from pairloom.session import materialize
from pairloom.sources import readers, writers

ITEMS = {
    "mmlu_ee": scoring.mcq_items,
    "ee_qa": scoring.open_items,
    "gsm8k": scoring.math_items,
}
# The blocks of files, in order.
FILE_BLOCK = ["_file", "_block"]


def _existing(read):
    """What `read` returns, or None where nothing was written yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _dump(spark, data_dir, name) -> DataFrame:
    """A dump file, parsed once into a columnar table; plans read it several times."""
    read = {"Posts": readers.read_posts, "Votes": readers.read_votes, "Comments": readers.read_comments}
    return materialize(read[name](spark, f"{data_dir}/{name}.xml"))


def _posts(spark, data_dir) -> DataFrame:
    """The dump's posts. Their ids must be unique: every lookup by id relies on it."""
    posts = _dump(spark, data_dir, "Posts")
    copies = [r[0] for r in duplicate_ids(posts.filter("Id IS NOT NULL")).limit(5).collect()]
    if copies:
        raise ValueError(f"posts with the same Id, for example {copies}")
    return posts


def curate(spark: SparkSession, data_dir, pairs_path, csv_path=None, **limits):
    """Dump to curated pairs (Parquet; CSV only as an export). `limits` are those of `curate_pairs`."""
    posts, votes = _posts(spark, data_dir), _dump(spark, data_dir, "Votes")
    curate_pairs(posts, votes, **limits).write.mode("overwrite").parquet(pairs_path)
    if csv_path is not None:
        writers.write_pairs(readers.read_pairs(spark, pairs_path, "parquet"), csv_path)


def ask_enrichment(
    spark, pairs_path, data_dir, processed_path, requests_path, max_items=None,
    template=ENRICH_TEMPLATE,
):
    """Curated pairs not processed yet to enrichment requests (Parquet)."""
    requests = enrich_requests(
        readers.read_pairs(spark, pairs_path, "parquet"),
        _posts(spark, data_dir),
        _dump(spark, data_dir, "Comments"),
        template,
        _existing(lambda: readers.read_ids(spark, processed_path)),
        max_items,
    )
    requests.write.parquet(requests_path)


def _new_responses(spark, responses_path, done):
    answered = readers.read_jsonl(spark, responses_path, schemas.RESPONSES, "fail")
    return answered if done is None else resume_pending(answered, done, "question_id")


def record_enrichment(spark, requests_path, responses_path, enriched_path, processed_path) -> DataFrame:
    """Append enriched pairs (JSON lines), then the ids that are done; return the outcomes.

    Truncated responses are done without a record; failed ones are asked again. Records and ids
    of a run go under its id, which follows from the responses: a run that ended between the
    two writes is written again over itself, and counts only once it has its ids.
    """
    done = _existing(lambda: readers.read_ids(spark, processed_path))
    answered = materialize(_new_responses(spark, responses_path, done))
    requests = spark.read.parquet(requests_path)
    ids = R.processed_ids(answered)
    if not ids.isEmpty():
        run = writers.run_id(answered)
        writers.append_run(R.merge_enriched(requests, answered), ids, enriched_path, processed_path, run)
    return R.response_status_counts(answered)


def _enriched(spark, enriched_path, processed_path) -> DataFrame:
    """Enriched pairs of the runs that have their ids as well."""
    return readers.read_runs(spark, enriched_path, processed_path, schemas.ENRICHED_PAIRS)


def ask_traces(
    spark, enriched_path, processed_path, traced_path, requests_path, max_items=None,
    template=TRACE_TEMPLATE,
):
    """Enriched pairs without a stored trace to trace requests (Parquet)."""
    enriched = _enriched(spark, enriched_path, processed_path)
    done = _existing(lambda: readers.ids_from_output(spark, traced_path))
    trace_requests(enriched, template, done, max_items).write.parquet(requests_path)


def record_traces(spark, enriched_path, processed_path, responses_path, traced_path) -> DataFrame:
    """Append traced pairs (JSON lines), truncated ones flagged; return the outcomes."""
    done = _existing(lambda: readers.ids_from_output(spark, traced_path))
    enriched = _enriched(spark, enriched_path, processed_path)
    answered = materialize(_new_responses(spark, responses_path, done))
    writers.append_jsonl(R.merge_traces(enriched, answered), traced_path)
    return R.response_status_counts(answered)


def audit(spark, traced_path, counter=None):
    """`(token statistics, truncated ids)` of all traced pairs."""
    traced = readers.read_jsonl(spark, traced_path, schemas.TRACED_PAIRS)
    return R.token_audit(traced, counter), R.truncated_ids(traced)


def split(spark, traced_path, train_path, eval_path, eval_size=10, seed=42) -> DataFrame:
    """Write both sets (JSON lines) and return their sizes."""
    traced = readers.read_jsonl(spark, traced_path, schemas.TRACED_PAIRS, "fail")
    writers.write_split(*split_exact(traced, "question_id", eval_size, seed), train_path, eval_path)
    stored = [readers.read_jsonl(spark, p, schemas.TRACED_PAIRS, "fail") for p in (train_path, eval_path)]
    return split_summary(*stored)


def prepare_training(
    spark, train_path, eval_path, sequences_path, eval_texts_path, max_tokens=MAX_TOKENS, **options
) -> DataFrame:
    """Write packed training texts and evaluation texts (Parquet); return the profile.

    The token budget holds for training rows only. `options` are those of
    `training_sequences`.
    """
    train, held_out = (
        drop_truncated(readers.read_jsonl(spark, path, schemas.TRACED_PAIRS, "fail"))
        for path in (train_path, eval_path)
    )
    training_sequences(train, max_tokens=max_tokens, **options).write.parquet(sequences_path)
    training_texts(held_out).select("question_id", "text").write.parquet(eval_texts_path)
    return train_profile(train, max_tokens, options.get("counter"))


def _items(spark, benchmark, items_path, stored_path, max_items, fmt) -> DataFrame:
    """Items with their position in the set, numbered once and stored.

    Later runs read what the first one stored, so outputs meet the item they were asked for.
    """
    stored = _existing(lambda: spark.read.parquet(stored_path))
    if stored is None:
        items = readers.read_benchmark(spark, benchmark, items_path, fmt)
        placed = materialize(items.select(
            "*", F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        ))
        numbered = file_positions(placed, FILE_BLOCK, "_row")
        ITEMS[benchmark](numbered).write.parquet(stored_path)
        stored = spark.read.parquet(stored_path)
    return scoring.eval_items(stored, max_items)


def ask_outputs(
    spark, benchmark, items_path, stored_items_path, results_path, prompts_path, max_items=100,
    system_prompt=scoring.DEFAULT_SYSTEM_PROMPT, models=("base", "ft"), fmt="json",
):
    """Prompts (Parquet) of items that a model has no stored result for.

    The items of the set are stored with their positions (Parquet) by the first call.
    """
    items = _items(spark, benchmark, items_path, stored_items_path, max_items, fmt)
    named = items.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    stored = _existing(lambda: readers.read_results(spark, results_path))
    pending = named if stored is None else scoring.eval_pending(named, stored)
    scoring.eval_prompts(pending, system_prompt).write.parquet(prompts_path)


def record_outputs(
    spark, benchmark, stored_items_path, outputs_path, results_path, counter=None, strict=False,
):
    """Score model outputs (Parquet) and append them to the stored results.

    The outputs decide which of the stored items are scored.
    """
    items = spark.read.parquet(stored_items_path)
    outputs = spark.read.parquet(outputs_path).filter(F.col("benchmark") == benchmark)
    stored = _existing(lambda: readers.read_results(spark, results_path))
    if stored is not None:
        outputs = scoring.eval_pending(outputs, stored)
    writers.append_results(scoring.score_outputs(outputs, items, counter, strict), results_path)


def _results(spark, results_path, benchmark):
    return readers.read_results(spark, results_path).filter(F.col("benchmark") == benchmark)


def ask_judge(spark, results_path, verdicts_path, requests_path, expected=None, seed=42):
    """Blind judge requests (Parquet) for open questions without a verdict."""
    stored = _existing(lambda: readers.read_jsonl(spark, verdicts_path, schemas.VERDICTS, "fail"))
    results = _results(spark, results_path, "ee_qa")
    judge_requests(results, stored, seed, expected).write.parquet(requests_path)


def record_verdicts(spark, requests_path, responses_path, verdicts_path) -> DataFrame:
    """Append parsed and unblinded verdicts (JSON lines); return the rates of all stored.

    Positions that have a verdict are left as they are; failed calls store none.
    """
    said = readers.read_jsonl(spark, responses_path, schemas.JUDGE_RESPONSES, "fail")
    stored = _existing(lambda: readers.read_jsonl(spark, verdicts_path, schemas.VERDICTS, "fail"))
    requests = spark.read.parquet(requests_path)
    if stored is not None:
        requests = judge_pending(requests, stored)
    writers.write_verdicts(verdicts(requests, said), verdicts_path)
    return judge_rates(readers.read_jsonl(spark, verdicts_path, schemas.VERDICTS, "fail"))


def report(spark, benchmark, results_path, comparison_path) -> DataFrame:
    """Write the side-by-side comparison (CSV, in item order) and return the model summary."""
    summary, comparison = reports(_results(spark, results_path, benchmark))
    writers.write_comparison(comparison.orderBy("item_pos"), comparison_path)
    return summary
