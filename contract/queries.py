"""Registered queries: each runs an operator over the whole given tables."""

from pyspark.sql import functions as F

from contract import fixtures as fx
from pairloom import schemas
from pairloom.functions import answers as A
from pairloom.functions import chat
from pairloom.functions.text import clean_html
from pairloom.operators import judging, requests, responses, scoring, splits, training, votes
from pairloom.operators.selection import positions
from pairloom.plans.curate import curate_pairs
from pairloom.plans.enrich import enrich_request_parts, enrich_requests, trace_requests
from pairloom.plans.evaluate import judge_requests
from pairloom.plans.train import even_shard, training_sequences
from pairloom.session import scratch_path
from pairloom.sources import readers, writers
from pairloom.streaming.resume import stream_trace_requests

RATIO = 0.5
BUDGET = 512
QUERIES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def _scored(spark, d, **kw):
    return votes.post_vote_counts(fx.posts(spark, d, **kw), votes.up_down_votes(fx.votes(spark, d)))


def _scored_answers(spark, d, **kw):
    counted = votes.answers(fx.posts(spark, d, **kw))
    return votes.post_vote_counts(counted, votes.up_down_votes(fx.votes(spark, d)))


def _top(spark, d, **kw):
    bodies = votes.answers(fx.posts(spark, d, **kw))
    return votes.top_answer(_scored_answers(spark, d, **kw), bodies=bodies)


def _good(spark, d):
    qs = votes.questions(fx.posts(spark, d)).select("Id")
    counted = votes.post_vote_counts(qs, votes.up_down_votes(fx.votes(spark, d)))
    return votes.vote_quality(counted, max_downvote_ratio=RATIO)


# --- curation ---------------------------------------------------------------


@query
def curate_pairs_(spark, d):
    return curate_pairs(fx.posts(spark, d), fx.votes(spark, d), max_downvote_ratio=RATIO)


@query
def posts_by_type(spark, d):
    qs, ans = votes.split_posts(fx.posts(spark, d))
    qs = qs.withColumn("kind", F.lit("question"))
    ans = ans.withColumn("kind", F.lit("answer"))
    return qs.unionByName(ans, allowMissingColumns=True)


@query
def votes_up_down(spark, d):
    return votes.up_down_votes(fx.votes(spark, d))


@query
def vote_counts(spark, d):
    return votes.vote_counts(votes.up_down_votes(fx.votes(spark, d)))


@query
def post_vote_counts(spark, d):
    return _scored(spark, d).select("Id", "PostTypeId", "Score", "Upvotes", "Downvotes")


@query
def vote_quality(spark, d):
    return votes.vote_quality(_scored(spark, d)).select("Id", "Upvotes", "Downvotes")


@query
def no_images(spark, d):
    return votes.no_images(fx.posts(spark, d)).select("Id", "Body")


@query
def html_text_length(spark, d):
    return votes.text_lengths(fx.posts(spark, d))


@query
def min_text_length(spark, d):
    return votes.min_length(votes.pair_lengths(fx.pairs(spark, d), fx.posts(spark, d)))


@query
def drop_image_pairs(spark, d):
    return votes.drop_image_pairs(fx.pairs(spark, d), fx.posts(spark, d))


@query
def answers_of_good_questions(spark, d):
    ans = votes.answers(fx.posts(spark, d)).select("Id", "ParentId", "Score")
    return votes.answers_of_good_questions(ans, _good(spark, d))


@query
def top_answer(spark, d):
    return _top(spark, d)


@query
def top_answer_filled(spark, d):
    return _top(spark, d, null_bodies=True)


@query
def duplicate_ids(spark, d):
    return votes.duplicate_ids(fx.pairs(spark, d), "ParentId")


# --- requests ---------------------------------------------------------------


@query
def target_posts(spark, d):
    scored = _scored_answers(spark, d)
    targets = votes.top_answer_ids(scored)
    qs, ans, com = requests.target_posts(fx.posts(spark, d), fx.comments(spark, d), targets)
    parts = [
        qs.select(F.lit("question").alias("kind"), "Id"),
        ans.select(F.lit("answer").alias("kind"), "Id"),
        com.select(F.lit("comment").alias("kind"), F.col("PostId").alias("Id")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("kind", "Id").agg(F.count(F.lit(1)).alias("n"))


@query
def pair_texts(spark, d):
    return requests.pair_texts(fx.pairs(spark, d), fx.posts(spark, d))


@query
def resume_pending(spark, d):
    return requests.resume_pending(fx.pairs(spark, d), fx.processed(spark, d))


@query
def pending_capped(spark, d):
    pending = requests.resume_pending(fx.pairs(spark, d), fx.processed(spark, d))
    return requests.cap_pending(pending, 50, order_by="Id")


@query
def comment_block(spark, d):
    return requests.comment_block(fx.comments(spark, d))


@query
def comment_parts(spark, d):
    return requests.comment_parts(fx.comments(spark, d), part_rows=20)


@query
def clean_html_(spark, d):
    pages = fx.table(spark, d, "pages")
    return pages.select("page_id", clean_html(F.col("html")).alias("text"))


@query
def enrich_requests_(spark, d):
    return enrich_requests(
        fx.pairs(spark, d), fx.posts(spark, d), fx.comments(spark, d),
        processed=fx.processed(spark, d),
    )


@query
def enrich_request_parts_(spark, d):
    return enrich_request_parts(
        fx.pairs(spark, d), fx.posts(spark, d), fx.comments(spark, d),
        processed=fx.processed(spark, d), part_rows=20,
    )


@query
def trace_requests_(spark, d):
    return trace_requests(fx.enriched(spark, d), processed=fx.processed(spark, d))


# --- responses --------------------------------------------------------------


def _merged(spark, d):
    asked = fx.enriched(spark, d).drop("enriched_answer")
    return responses.merge_enriched(asked, fx.responses(spark, d))


@query
def merge_enriched(spark, d):
    return _merged(spark, d)


@query
def merge_traces(spark, d):
    return responses.merge_traces(fx.enriched(spark, d), fx.responses(spark, d))


@query
def response_status_counts(spark, d):
    return responses.response_status_counts(fx.responses(spark, d))


@query
def processed_ids(spark, d):
    return responses.processed_ids(fx.responses(spark, d))


@query
def accumulated_pairs(spark, d):
    return responses.accumulate(fx.enriched(spark, d), _merged(spark, d))


@query
def token_audit(spark, d):
    return responses.token_audit(fx.traced(spark, d))


@query
def truncated_ids(spark, d):
    return responses.truncated_ids(fx.traced(spark, d))


# --- splits -----------------------------------------------------------------


def _split(spark, d):
    return splits.split_exact(fx.traced(spark, d), "question_id")


@query
def split_eval(spark, d):
    return _split(spark, d)[1]


@query
def split_train(spark, d):
    return _split(spark, d)[0]


@query
def split_summary(spark, d):
    return splits.split_summary(*_split(spark, d))


@query
def split_leaks(spark, d):
    """The leak check on a broken split: every third row is lost, every second evaluated."""
    traced, key = fx.traced(spark, d), F.col("question_id")
    return splits.split_leak_check(traced.filter(key % 3 != 0), traced.filter(key % 2 == 0), traced, "question_id")


@query
def split_differences(spark, d):
    """What a split that loses, doubles and changes rows differs in from the whole."""
    whole = fx.traced(spark, d).select("question_id", "title", "enriched_answer")
    key = F.col("question_id")
    broken = whole.filter(key % 35 != 0).withColumn(
        "title", F.when(key % 77 == 0, F.lit("changed")).otherwise(F.col("title")))
    broken = broken.unionByName(broken.filter(key % 39 == 0))
    return splits.table_differences(whole, broken, "question_id")


@query
def split_leak_check(spark, d):
    return splits.split_leak_check(*_split(spark, d), fx.traced(spark, d), "question_id")


# --- training ---------------------------------------------------------------


@query
def drop_truncated(spark, d):
    return training.drop_truncated(fx.traced(spark, d))


@query
def chat_records(spark, d):
    return training.chat_records(fx.traced(spark, d)).select("question_id", "text")


@query
def token_budget(spark, d):
    kept = training.within_budget(fx.traced(spark, d), BUDGET)
    return training.full_tokens(kept).select("question_id", "n_tokens")


@query
def train_profile(spark, d):
    return training.train_profile(fx.traced(spark, d), BUDGET)


@query
def drop_trace(spark, d):
    flagged = training.drop_trace(fx.traced(spark, d), prob=0.3)
    return flagged.select("question_id", "trace_dropped")


@query
def training_texts(spark, d):
    return training.training_texts(fx.traced(spark, d), prob=0.3).select("question_id", "text")


@query
def chat_serialize(spark, d):
    return training.serialize_turns(fx.table(spark, d, "conversations"))


@query
def turn_parts(spark, d):
    return training.turn_parts(fx.table(spark, d, "conversations"), part_rows=3)


@query
def supervised_tokens(spark, d):
    return training.supervised_turns(fx.table(spark, d, "conversations"))


@query
def record_supervision(spark, d):
    records = training.chat_records(fx.traced(spark, d))
    return records.select(
        "question_id",
        chat.supervised_tokens(F.col("messages")).alias("supervised"),
        chat.masked_tokens(F.col("messages")).alias("masked"),
    )


@query
def pack_sequences(spark, d):
    sized = training.full_tokens(fx.traced(spark, d)).select(
        "question_id", even_shard("question_id", 16).alias("shard"), "n_tokens"
    )
    return training.pack_sequences(sized, "shard", "question_id", "n_tokens", BUDGET)


@query
def training_sequences_(spark, d):
    return training_sequences(fx.traced(spark, d), drop_prob=0.3, max_tokens=BUDGET, block=BUDGET)


# --- evaluation -------------------------------------------------------------


def _open_items(spark, d):
    held_out = fx.traced(spark, d).withColumnRenamed("question_id", "item_pos")
    return scoring.open_items(held_out)


def _math_items(spark, d):
    return scoring.math_items(fx.math_references(spark, d))


def _results(spark, d, benchmark, items):
    return scoring.score_outputs(fx.outputs(spark, d), items, benchmark=benchmark)


def _math_results(spark, d):
    return _results(spark, d, A.MATH, _math_items(spark, d))


def _open_results(spark, d):
    return _results(spark, d, A.OPEN_QA, _open_items(spark, d))


def _of(results, model):
    return results.filter(F.col("model") == model)


@query
def mcq_items(spark, d):
    return scoring.mcq_items(fx.choice_items(spark, d))


@query
def eval_items(spark, d):
    return scoring.eval_items(fx.choice_items(spark, d)).select("item_pos", "question")


@query
def item_position(spark, d):
    docs = fx.table(spark, d, "documents").select("source", "doc_id")
    return positions(docs, ["source", "doc_id"]).select("doc_id", "item_pos")


@query
def eval_prompts(spark, d):
    items = scoring.mcq_items(fx.choice_items(spark, d))
    items = items.unionByName(_math_items(spark, d)).unionByName(_open_items(spark, d))
    return scoring.eval_prompts(items).drop("question")


@query
def predicted_answer(spark, d):
    outputs = fx.outputs(spark, d).withColumn("benchmark", F.lit(A.MATH))
    return scoring.extract_answers(outputs).select(
        "model", "item_pos", "thinking_trace", "answer_part", "predicted_answer"
    )


@query
def mcq_answer(spark, d):
    return fx.letters(spark, d).select("doc_id", A.mcq_answer(F.col("raw_output")).alias("answer"))


@query
def reference_answer(spark, d):
    return _math_items(spark, d).select("item_pos", "reference")


@query
def exact_match(spark, d):
    return _math_results(spark, d).select(
        "model", "item_pos", "reference_answer", "predicted_answer", "is_correct"
    )


@query
def score_outputs(spark, d):
    return _math_results(spark, d).unionByName(_open_results(spark, d))


@query
def model_summary(spark, d):
    results = _math_results(spark, d).unionByName(_open_results(spark, d))
    summary = scoring.model_summary(results, ("benchmark", "model"))
    keys = ("benchmark", "model")
    return summary.select(
        *keys, *[F.round(c, 6).alias(c) for c in summary.columns if c not in keys]
    )


def _report(spark, d):
    results = _math_results(spark, d)
    return scoring.model_comparison(results)


@query
def model_results(spark, d):
    """Results of both models, unnamed on their own, in one table."""
    results = _math_results(spark, d)
    sides = [_of(results, model).drop("model") for model in ("base", "ft")]
    return scoring.union_models(*sides).select("model", "item_pos", "predicted_answer", "is_correct")


@query
def mcq_scored(spark, d):
    """Multiple choice from raw outputs to scores."""
    outputs = fx.letters(spark, d).select(
        F.lit(A.MULTIPLE_CHOICE).alias("benchmark"), F.lit("base").alias("model"),
        F.col("doc_id").alias("item_pos"), "raw_output", F.lit(1.5).alias("time_seconds"),
    )
    results = scoring.score_outputs(outputs, scoring.mcq_items(fx.choice_items(spark, d)))
    return results.drop("raw_output", "question", "time_seconds")


@query
def compare_models(spark, d):
    return _report(spark, d)


@query
def eval_pending(spark, d):
    items = _math_items(spark, d).withColumn("model", F.lit("ft"))
    stored = fx.outputs(spark, d).withColumn("benchmark", F.lit(A.MATH))
    return scoring.eval_pending(items, stored)


# --- judging ----------------------------------------------------------------


def _judge_pairs(spark, d):
    return judge_requests(_open_results(spark, d))


def _verdicts(spark, d):
    return judging.verdicts(_judge_pairs(spark, d), fx.explanations(spark, d))


@query
def judge_pairs(spark, d):
    return _judge_pairs(spark, d)


@query
def judge_pending(spark, d):
    stored = fx.processed(spark, d).withColumnRenamed("question_id", "item_pos")
    pending = judge_requests(_open_results(spark, d), stored)
    return pending.select("item_pos", "model_a", "model_b")


@query
def verdicts(spark, d):
    return _verdicts(spark, d)


@query
def judge_rates(spark, d):
    return judging.judge_rates(_verdicts(spark, d))


# --- files written and read back -------------------------------------------


def _dump(df, path):
    """A dump file as the source publishes it: one `<row/>` per line."""
    attributes = [F.col(c).cast("string").alias(f"_{c}") for c in df.columns]
    writer = df.select(*attributes).write.format("xml")
    writer.option("rootTag", "rows").option("rowTag", "row").save(path)
    return path


@query
def xml_posts(spark, d):
    return readers.read_posts(spark, _dump(fx.posts(spark, d), scratch_path(spark, "posts")))


@query
def xml_votes(spark, d):
    return readers.read_votes(spark, _dump(fx.votes(spark, d), scratch_path(spark, "votes")))


@query
def xml_comments(spark, d):
    path = _dump(fx.comments(spark, d), scratch_path(spark, "comments"))
    return readers.read_comments(spark, path)


@query
def csv_pairs(spark, d):
    path = scratch_path(spark, "pairs")
    pairs = votes.pair_lengths(_top(spark, d), fx.posts(spark, d))
    writers.write_pairs(pairs.select(*schemas.CURATED_PAIRS.names), path)
    return readers.read_pairs(spark, path)


@query
def jsonl_records(spark, d):
    path = scratch_path(spark, "records")
    writers.append_jsonl(fx.traced(spark, d), path)
    return readers.read_jsonl(spark, path, schemas.TRACED_PAIRS)


@query
def processed_id_file(spark, d):
    path = scratch_path(spark, "ids")
    writers.append_ids(fx.processed(spark, d), path)
    return readers.read_ids(spark, path)


@query
def output_ids(spark, d):
    path = scratch_path(spark, "output")
    writers.append_jsonl(fx.enriched(spark, d), path)
    return readers.ids_from_output(spark, path)


@query
def split_files(spark, d):
    paths = {part: scratch_path(spark, part) for part in ("train", "eval")}
    writers.write_split(*_split(spark, d), paths["train"], paths["eval"])
    parts = [
        readers.read_jsonl(spark, path, schemas.TRACED_PAIRS, "fail").withColumn("part", F.lit(part))
        for part, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def benchmark_files(spark, d):
    path = scratch_path(spark, "items")
    writers.append_jsonl(fx.choice_items(spark, d).drop("item_pos"), path)
    items = readers.read_benchmark(spark, A.MULTIPLE_CHOICE, path)
    return items.select("question", F.array_join("choices", "").alias("joined"), "answer")


@query
def benchmark_math_files(spark, d):
    path = scratch_path(spark, "items")
    writers.append_jsonl(fx.math_references(spark, d).drop("item_pos"), path)
    return readers.read_benchmark(spark, A.MATH, path)


@query
def benchmark_open_files(spark, d):
    path = scratch_path(spark, "items")
    writers.append_jsonl(fx.traced(spark, d), path)
    return readers.read_benchmark(spark, A.OPEN_QA, path)


@query
def result_files(spark, d):
    path = scratch_path(spark, "results")
    results = _math_results(spark, d)
    writers.append_results(_of(results, "base"), path)
    writers.append_results(_of(results, "ft"), path)
    return readers.read_results(spark, path)


@query
def verdict_files(spark, d):
    path = scratch_path(spark, "verdicts")
    writers.write_verdicts(_verdicts(spark, d), path)
    return readers.read_jsonl(spark, path, schemas.VERDICTS, "fail")


@query
def comparison_file(spark, d):
    path = scratch_path(spark, "comparison")
    report = _report(spark, d)
    writers.write_comparison(report, path)
    reader = spark.read.schema(report.schema).option("header", True)
    return reader.option("multiLine", True).option("escape", '"').csv(path)


@query
def streamed_trace_requests(spark, d):
    source, out, log = (scratch_path(spark, n) for n in ("enriched", "requests", "offsets"))
    writers.append_jsonl(fx.enriched(spark, d), source)
    stream_trace_requests(spark, source, out, log).awaitTermination()
    return readers.read_jsonl(spark, out, trace_requests(fx.enriched(spark, d)).schema, "fail")


# A trailing underscore only keeps a name apart from the function it calls.
QUERIES = {name.rstrip("_"): build for name, build in QUERIES.items()}
