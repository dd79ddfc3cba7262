"""Table operators on small tables, with copies and one very large group."""

from itertools import accumulate as running
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.operators import judging, responses, scoring, training, votes
from pairloom.operators.ordered import first_rows, running_total, with_position
from pairloom.operators.requests import (
    cap_pending,
    comment_block,
    comment_parts,
    fill_template,
    pair_texts,
    resume_pending,
    target_posts,
)
from pairloom.operators.splits import split_exact, split_leak_check, split_summary
from pairloom.plans.curate import curate_pairs
from pairloom.plans.enrich import enrich_request_parts, enrich_requests, trace_requests
from pairloom.plans.evaluate import judge_requests, reports
from pairloom.plans.train import even_shard, training_sequences

POSTS = "Id bigint, PostTypeId string, ParentId bigint, Title string, Body string, Tags string, Score bigint"
COMMENTS = "PostId bigint, Score bigint, Text string, CreationDate string"
LONG = "x" * 300


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def make_votes(spark, counts):
    """{post: (up, down)} to vote rows, with an ignored type among them."""
    listed = [(p, "2") for p, (up, _) in counts.items() for _ in range(up)]
    listed += [(p, "3") for p, (_, down) in counts.items() for _ in range(down)]
    listed += [(p, "1") for p in counts] * 10
    return spark.createDataFrame(listed, "PostId bigint, VoteTypeId string")


def post(i, parent=None, body=LONG, score=1, kind=None):
    kind = kind or ("1" if parent is None else "2")
    return (i, kind, parent, f"T{i}", body, "<a>", score)


# --- curation ---------------------------------------------------------------


def curated(spark, posts, counts, **kw):
    table = spark.createDataFrame(posts, POSTS)
    return rows(curate_pairs(table, make_votes(spark, counts), **kw).drop("Body"), "ParentId")


def test_best_answer_has_no_fallback(spark):
    posts = [post(1), post(11, 1), post(12, 1), post(2), post(21, 2)]
    # 11 leads but has too many downvotes; 12 would pass.
    counts = {1: (5, 0), 11: (9, 8), 12: (8, 0), 2: (5, 1), 21: (5, 1)}
    assert curated(spark, posts, counts) == [(2, 21, 1, 5, 1, 300, 300)]


def test_ties_take_the_lowest_id(spark):
    posts = [post(1), post(12, 1), post(11, 1), post(13, 1)]
    counts = {1: (5, 0), 11: (6, 0), 12: (6, 1), 13: (5, 0)}
    assert curated(spark, posts, counts) == [(1, 11, 1, 6, 0, 300, 300)]


def test_images_lengths_and_types_are_filtered(spark):
    posts = [
        post(1, body=LONG + "<img>"), post(11, 1), post(2), post(21, 2, LONG + "<img"),
        post(3, body="<p>" + "x" * 299 + "</p>"), post(31, 3), post(4), post(41, 4, None),
        post(5, kind="4"), post(51, 5), post(6), post(61, 6, "<b>" + LONG + "</b>"), post(7),
    ]
    counts = {i: (5, 0) for i in (1, 11, 2, 21, 3, 31, 4, 41, 5, 51, 6, 61, 7)}
    assert curated(spark, posts, counts) == [(6, 61, 1, 5, 0, 300, 300)]
    shorter = curated(spark, posts, counts, min_text=0)
    assert [r[0] for r in shorter] == [3, 4, 6]
    assert shorter[1] == (4, 41, 1, 5, 0, 300, 0)


def test_missing_values_are_filled_from_the_next_answer(spark):
    posts = [post(1), post(11, 1, None, None), post(12, 1, None, 7), post(13, 1, "b", 8)]
    scored = votes.post_vote_counts(
        votes.answers(spark.createDataFrame(posts, POSTS)),
        make_votes(spark, {11: (3, 0), 12: (2, 0), 13: (1, 0)}),
    )
    assert rows(votes.top_answer(scored)) == [(1, 11, "b", 7, 3, 0)]
    assert rows(votes.top_answer(scored, fill_nulls=False)) == [(1, 11, None, None, 3, 0)]


def test_no_votes_no_pairs(spark):
    assert curated(spark, [post(1), post(11, 1)], {}) == []


def test_a_third_of_answers_on_one_question(spark):
    answers = spark.range(3000).select(
        (F.col("id") + 10_000).alias("Id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("ParentId"),
        F.lit("b").alias("Body"), F.lit(1).cast("bigint").alias("Score"),
        (F.col("id") * 7919 % 1000).alias("Upvotes"), F.lit(0).cast("bigint").alias("Downvotes"),
    )
    top = dict(rows(votes.top_answer_ids(answers).select("ParentId", "Id")))
    best = {}
    for r in answers.collect():
        rank = (-r["Upvotes"], r["Id"])
        best[r["ParentId"]] = min(best.get(r["ParentId"], rank), rank)
    assert top == {parent: i for parent, (_, i) in best.items()}


def test_duplicate_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (1,)], "Id bigint")
    assert rows(votes.duplicate_ids(df)) == [(1, 2)]


# --- ordered work over hot groups ------------------------------------------


def skewed(spark, n=900):
    """A third of the rows in group 0, the rest in groups of two."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id").bitwiseAND(F.lit(-2))).alias("g"),
        (F.col("id") * 7919 % 1009).alias("o"), (F.col("id") % 13).alias("v"),
    )


@pytest.mark.parametrize("hot_rows", [1_000_000, 50, 0])
def test_running_total(spark, hot_rows):
    df = skewed(spark)
    got = running_total(df, ["g"], ["o"], F.col("v"), "t", hot_rows=hot_rows, slices=5)
    want = []
    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append((r["o"], r["v"]))
    for g, members in groups.items():
        members.sort()
        totals = running(v for _, v in members)
        want += [(g, o, v, t) for (o, v), t in zip(members, totals)]
    assert Counter(rows(got)) == Counter(want)


@pytest.mark.parametrize("hot_rows", [1_000_000, 0])
def test_positions(spark, hot_rows):
    df = spark.range(500).select((F.col("id") * 7919 % 1009).alias("k"))
    got = rows(with_position(df, ["k"], hot_rows=hot_rows, slices=7), "k")
    assert [p for _, p in got] == list(range(500))
    assert with_position(df.limit(0), ["k"], hot_rows=hot_rows).count() == 0


def test_first_rows(spark):
    df = spark.range(300).select((F.col("id") * 7919 % 1009).alias("k"))
    want = sorted(r[0] for r in df.collect())[:40]
    for top_k_rows in (1_000, 0):
        assert [r[0] for r in first_rows(df, ["k"], 40, top_k_rows).orderBy("k").collect()] == want


def comment_rows(spark, n=400):
    """A third on post 4, several with equal dates, some without date or text."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit(4)).otherwise(i % 40 * 4).alias("PostId"),
        F.when(i % 7 != 0, i % 5).alias("Score"),
        F.when(i % 11 != 0, F.concat(F.lit("c"), i.cast("string"))).alias("Text"),
        F.when(i % 17 != 0, F.concat(F.lit("2024-01-"), F.lpad((i * 31 % 29).cast("string"), 2, "0")))
        .alias("CreationDate"),
    )


def expected_blocks(comments):
    groups = {}
    for r in comments.collect():
        groups.setdefault(r["PostId"], []).append(r)
    blocks = {}
    for p, members in groups.items():
        members.sort(key=lambda r: (
            r["CreationDate"] is None, r["CreationDate"] or "", r["Text"] is not None, r["Text"] or "",
            r["Score"] is not None, r["Score"] or 0,
        ))
        blocks[p] = "".join(
            f"[comment_{n}] (score={r['Score']}): {r['Text']}\n" for n, r in enumerate(members, 1)
        )
    return blocks


# The last case has groups above the text limit that are not hot.
@pytest.mark.parametrize("hot_rows, groups", [(1_000_000, 10_000), (30, 10_000), (0, 10_000), (30, 1)])
def test_comment_blocks(spark, hot_rows, groups, monkeypatch):
    monkeypatch.setattr("pairloom.operators.ordered.SEGMENT_ROWS", 16)
    monkeypatch.setattr("pairloom.operators.ordered.MAX_HOT_GROUPS", groups)
    comments = comment_rows(spark)
    want = expected_blocks(comments)
    assert dict(rows(comment_block(comments, hot_rows=hot_rows, slices=5))) == want
    targets = spark.createDataFrame([(4,), (8,), (8,), (9_999,)], "PostId bigint")
    some = comment_block(comments, targets, hot_rows=hot_rows, slices=5)
    assert dict(rows(some)) == {p: want[p] for p in (4, 8)}


@pytest.mark.parametrize("hot_rows", [1_000_000, 30, 0])
def test_comment_parts_make_up_the_blocks(spark, hot_rows):
    comments = comment_rows(spark)
    want = expected_blocks(comments)
    targets = spark.createDataFrame([(4,), (8,), (8,), (9_999,)], "PostId bigint")
    for keep, wanted in ((None, set(want)), (targets, {4, 8})):
        parts = comment_parts(comments, keep, part_rows=7, hot_rows=hot_rows, slices=5).collect()
        texts = {}
        for r in sorted(parts, key=lambda r: (r["PostId"], r["part"])):
            assert r["comment_block"].count("[comment_") <= 7
            texts[r["PostId"]] = texts.get(r["PostId"], "") + r["comment_block"]
        assert texts == {p: want[p] for p in wanted}


@pytest.mark.parametrize("hot_rows", [1_000_000, 30])
def test_request_parts_make_up_the_prompts(spark, hot_rows):
    comments = comment_rows(spark)
    posts = spark.createDataFrame(
        [post(4, body="<p>q</p>"), post(5, 4, "a"), post(8), post(9, 8), post(3), post(2, 3)], POSTS
    )
    pairs = spark.createDataFrame([(4, 5), (8, 9), (3, 2)], "ParentId bigint, Id bigint")
    prompts = {r["question_id"]: r["prompt"] for r in enrich_requests(pairs, posts, comments).collect()}
    parts = enrich_request_parts(pairs, posts, comments, part_rows=7, hot_rows=hot_rows).collect()
    texts = {}
    for r in sorted(parts, key=lambda r: (r["section"], r["part"])):
        texts[r["question_id"]] = texts.get(r["question_id"], "") + r["text"]
    assert texts == prompts and len(parts) > 20


def test_comments_without_post_are_left_out(spark):
    df = spark.createDataFrame([(None, 1, "a", "d"), (1, None, None, None)], COMMENTS)
    assert rows(comment_block(df)) == [(1, "[comment_1] (score=None): None\n")]


@pytest.mark.parametrize("hot_rows", [1_000_000, 0])
def test_turns(spark, hot_rows):
    turns = spark.createDataFrame(
        [(1, 2, "user", "c"), (1, 0, "system", "a"), (1, 1, None, None), (2, 0, "user", "z")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    got = dict(rows(training.serialize_turns(turns, hot_rows=hot_rows, slices=2)))
    assert got == {
        1: "<|im_start|>system\na<|im_end|>\n<|im_start|>\n<|im_end|>\n<|im_start|>user\nc<|im_end|>\n",
        2: "<|im_start|>user\nz<|im_end|>\n",
    }


@pytest.mark.parametrize("hot_rows", [1_000_000, 0])
def test_packing(spark, hot_rows):
    df = spark.createDataFrame(
        [(0, 1, 6), (0, 2, 4), (0, 3, 0), (0, 4, 25), (1, 5, 3)], "s int, id int, n bigint"
    )
    packed = training.pack_sequences(df, "s", "id", "n", block=10, hot_rows=hot_rows, slices=3)
    assert rows(packed.select("id", "end_token", "start_block", "end_block"), "id") == [
        (1, 6, 0, 0), (2, 10, 0, 0), (3, 10, 1, 1), (4, 35, 1, 3), (5, 3, 0, 0),
    ]


def test_shards_are_even(spark):
    sizes = spark.range(8000).groupBy(even_shard("id", 8).alias("s")).count().collect()
    assert len(sizes) == 8 and all(850 < r["count"] < 1150 for r in sizes)


# --- splits -----------------------------------------------------------------


def check_split(df, key, size):
    train, held_out = split_exact(df, key, size)
    everything = Counter(rows(df))
    assert Counter(rows(train)) + Counter(rows(held_out)) == everything
    assert held_out.count() == size
    again = split_exact(df.repartition(3), key, size)
    assert Counter(rows(again[1])) == Counter(rows(held_out))
    return train, held_out


def test_split(spark):
    df = spark.range(200).withColumn("t", F.col("id") * 2)
    train, held_out = check_split(df, "id", 10)
    assert rows(split_summary(train, held_out), "split") == [
        ("eval", 10), ("total", 200), ("train", 190)
    ]
    assert split_leak_check(train, held_out, df, "id").count() == 0
    leak = split_leak_check(train.limit(100), held_out.unionByName(train.limit(1)), df, "id")
    assert leak.count() > 0
    other = split_exact(df, "id", 10, seed=7)[1]
    assert rows(other) != rows(held_out)


@pytest.mark.parametrize("size", [1, 10, 60, 99])
def test_split_keeps_copies(spark, size):
    # A third of the rows share one key, half of those in every column, and one has no key.
    i = F.col("id")
    df = spark.range(100).select(
        F.when(i == 50, F.lit(None)).when(i % 3 == 0, F.lit(0)).otherwise(i).alias("k"),
        F.when(i % 6 == 0, F.lit(0)).otherwise(i).alias("t"),
    )
    check_split(df, "k", size)


def test_split_needs_a_row_to_train(spark):
    with pytest.raises(ValueError):
        split_exact(spark.range(10), "id", 10)
    train, held_out = split_exact(spark.range(11), "id", 10)
    assert train.count() == 1 and held_out.count() == 10


# --- requests and responses -------------------------------------------------


def test_templates_do_not_rescan_texts(spark):
    df = spark.createDataFrame([("{b}", "{a}", None)], "a string, b string, c string")
    text = fill_template("{c}<{a}|{b}>{d}", a=F.col("a"), b=F.col("b"), c=F.col("c"))
    assert df.select(text).first()[0] == "<{b}|{a}>{d}"


def test_resume_and_cap(spark):
    pairs = spark.createDataFrame([(3, 30), (1, 10), (1, 11), (2, 20)], "ParentId bigint, Id bigint")
    done = spark.createDataFrame([(2,), (2,), (9,)], "question_id bigint")
    pending = resume_pending(pairs, done)
    assert rows(pending, "Id") == [(1, 10), (1, 11), (3, 30)]
    asked = pending.select(F.col("ParentId"))
    assert resume_pending(resume_pending(pairs, asked), done).count() == 0
    assert cap_pending(pending, 2, "Id").count() == 2
    assert cap_pending(pending, 0).count() == cap_pending(pending, None).count() == 3
    assert cap_pending(pending, 0, zero_is_no_cap=False).count() == 0


def test_requests(spark):
    posts = spark.createDataFrame(
        [(1, "1", None, "T&amp;1", "<p>q</p>", None, 1), (10, "2", 1, None, "<b>a</b>", None, 1)], POSTS
    )
    comments = spark.createDataFrame([(1, 2, "<i>c</i>", "d"), (10, 1, "on the answer", "d")], COMMENTS)
    pairs = spark.createDataFrame([(1, 10), (2, 20)], "ParentId bigint, Id bigint")
    asked = enrich_requests(pairs, posts, comments, "{title}|{body}|{comments}|{answer}")
    assert rows(asked, "question_id") == [
        (1, 10, "T&1", "q", "a", None, "T&1|q|[comment_1] (score=2): <i>c</i>\n|a"),
        (2, 20, "", "", "", "", "||None|"),
    ]
    looked_up = pair_texts(pairs, posts)
    assert rows(looked_up, "Id")[1] == (2, 20, None, None, None, None)
    q, a, c = target_posts(posts, comments, pairs)
    assert (q.count(), a.count(), c.count()) == (1, 1, 1)


RESPONSES = [
    (1, " t1\n", "stop", None), (2, "t2", "length", None), (3, None, None, "HTTP 429"),
    (4, None, None, "Insufficient credit"), (5, None, None, "reset"), (6, "t6", None, None),
    (7, None, "length", "QUOTA exceeded"),
]


def test_responses(spark):
    answered = spark.createDataFrame(
        RESPONSES, "question_id bigint, content string, finish_reason string, error string"
    )
    assert rows(responses.response_status_counts(answered), "status") == [
        ("failed", 1), ("ok", 2), ("quota", 3), ("truncated", 1)
    ]
    assert rows(responses.processed_ids(answered), "question_id") == [(1,), (2,), (6,)]
    asked = spark.createDataFrame(
        [(i, i * 10, "t", "q", "a", None) for i in range(1, 9)],
        "question_id bigint, answer_id bigint, title string, question_body string, "
        "original_answer string, tags string",
    )
    enriched = responses.merge_enriched(asked, answered)
    assert [(r[0], r[5]) for r in rows(enriched, "question_id")] == [(1, " t1\n"), (6, "t6")]
    traced = responses.merge_traces(asked, answered)
    assert [(r[0], r[-2], r[-1]) for r in rows(traced, "question_id")] == [
        (1, "t1", False), (2, "t2", True), (6, "t6", False)
    ]
    assert rows(responses.truncated_ids(traced)) == [(2,)]
    both = responses.accumulate(enriched, enriched)
    assert both.count() == 4
    # A second run asks only what failed.
    left = trace_requests(asked.withColumn("enriched_answer", F.lit("e")), "{question}",
                          responses.processed_ids(answered))
    assert [r["question_id"] for r in left.orderBy("question_id").collect()] == [3, 4, 5, 7, 8]


def test_token_audit(spark):
    traced = spark.createDataFrame(
        [(1, "a b c", False), (2, "a", True), (3, "", True), (4, None, None), (5, "a b c d", None),
         (6, "a b", False)],
        "question_id bigint, thinking_trace_re string, trace_truncated boolean",
    )
    assert rows(responses.token_audit(traced)) == [(4, 1, 2.5, 2, 1, 4, 10)]
    assert rows(responses.token_audit(traced.limit(0))) == []


# --- training ---------------------------------------------------------------

TRACED = "question_id bigint, title string, question_body string, enriched_answer string, thinking_trace_re string, trace_truncated boolean"


def test_training_records(spark):
    df = spark.createDataFrame(
        [(1, "t", "b", "a", "z " * 50, False), (2, "t", "b", "a", None, None), (3, "t", "b", "a", "z", True)],
        TRACED,
    )
    assert training.drop_truncated(df).count() == 2
    profile = training.train_profile(df, max_tokens=30)
    assert rows(profile) == [(3, 2, 1, 1, 1)]
    kept = training.within_budget(df, 30)
    assert [r["question_id"] for r in kept.orderBy("question_id").collect()] == [2, 3]
    assert training.drop_trace(df, prob=1.0).filter("trace_dropped").count() == 2
    assert training.drop_trace(df, prob=0.0).filter("trace_dropped").count() == 0
    texts = dict(rows(training.training_texts(df, prob=1.0).select("question_id", "text")))
    assert "<think></think>\n\na" in texts[1] and "<think>" not in texts[2]


def test_training_sequences_keep_every_token(spark):
    df = spark.range(300).select(
        F.col("id").alias("question_id"), F.lit("t").alias("title"), F.lit("b").alias("question_body"),
        F.lit("a b c").alias("enriched_answer"), F.lit("z").alias("thinking_trace_re"),
        F.lit(False).alias("trace_truncated"),
    )
    packed = training_sequences(df, shards=4, block=64)
    ends = packed.groupBy("shard").agg(F.max("end_token").alias("e"), F.sum("n_tokens").alias("n"))
    assert packed.count() == 300 and ends.filter("e <> n").count() == 0


# --- evaluation and judging -------------------------------------------------

RESULTS = "benchmark string, model string, item_pos bigint, question string, reference_answer string, predicted_answer string, is_correct boolean, thinking_tokens bigint, answer_tokens bigint, time_seconds double, raw_output string"


def result(model, pos, correct=None, answer="x"):
    return ("ee_qa", model, pos, f"q{model}{pos}", "r", answer, correct, pos, 2 * pos, 1.5, "o")


def test_reports(spark):
    df = spark.createDataFrame(
        [result("base", 1, True), result("base", 2, False), result("base", 3), result("ft", 2),
         result("ft", 4)], RESULTS,
    )
    summary, comparison = reports(df)
    assert rows(summary, "model") == [("base", 50.0, 2.0, 4.0, 1.5), ("ft", 0.0, 3.0, 6.0, 1.5)]
    got = rows(comparison.select("item_pos", "question", "base_correct", "ft_think_tokens"), "item_pos")
    assert got == [
        (1, "qbase1", True, None), (2, "qbase2", False, 2), (3, "qbase3", None, None), (4, None, None, 4)
    ]
    one, alone = reports(df.filter("model = 'ft'"))
    assert rows(one, "model")[0] == ("base", 0.0, 0.0, 0.0, 0.0)
    assert alone.count() == 0 and alone.columns == comparison.columns
    both = scoring.union_models(df.filter("model = 'base'"), df.filter("model = 'ft'"))
    assert Counter(rows(both.select("model", "item_pos"))) == Counter(rows(df.select("model", "item_pos")))


def test_eval_items_and_pending(spark):
    items = spark.range(250).select(F.col("id").alias("k"), F.lit("q").alias("question"))
    first = scoring.eval_items(items, 100, ["k"])
    assert rows(first.select("k", "item_pos"), "k") == [(i, i) for i in range(100)]
    asked = first.withColumn("benchmark", F.lit("b")).withColumn("model", F.lit("m"))
    assert scoring.eval_pending(asked, asked.filter("k < 60")).count() == 40
    assert scoring.eval_pending(asked, asked).count() == 0


def test_prompts_swap_only_the_default(spark):
    items = spark.createDataFrame(
        [("mmlu_ee", 0, "q"), ("gsm8k", 1, "q")], "benchmark string, item_pos bigint, question string"
    )
    default = [r["prompt"] for r in scoring.eval_prompts(items).orderBy("item_pos").collect()]
    assert "\\boxed{}" in default[0] and scoring.DEFAULT_SYSTEM_PROMPT in default[1]
    own = [r["prompt"] for r in scoring.eval_prompts(items, "mine").collect()]
    assert set(own) == {
        "<|im_start|>system\nmine<|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"
    }


def test_judging(spark):
    base = [result("base", i, answer=f"b{i}") for i in range(40)]
    tuned = [result("ft", i, answer=f"t{i}") for i in range(38)]
    base[0], tuned[1] = result("base", 0, answer=""), result("ft", 1, answer=None)
    results = spark.createDataFrame(base + tuned, RESULTS)
    pairs = judge_requests(results)
    assert pairs.count() == judge_requests(results, expected=38).count() == 36
    assert judge_requests(results, expected=39).count() == 0
    for r in pairs.collect():
        first = "t" if r["model_a"] == "Fine-Tuned" else "b"
        assert r["answer_a"] == f"{first}{r['item_pos']}" and r["model_a"] != r["model_b"]
        assert r["prompt"].index(r["answer_a"]) < r["prompt"].index(r["answer_b"])
    assert pairs.select("model_a").distinct().count() == 2
    said = spark.createDataFrame(
        [(i, ["Verdict: A", "Verdict: B", "Verdict: tie", "none"][i % 4]) for i in range(40)],
        "item_pos bigint, explanation string",
    )
    records = judging.verdicts(pairs, said)
    rates = judging.judge_rates(records).first()
    errors = records.filter("NOT ft_won AND NOT base_won AND NOT tie").count()
    assert rates["total"] == 36 == (
        rates["ft_won_count"] + rates["base_won_count"] + rates["tie_count"] + errors
    )
    assert errors == 9 and rates["tie_rate"] == 25.0
    assert judge_requests(results, records).count() == 0
    empty = judging.judge_rates(records.limit(0)).first()
    assert empty["total"] == 0 and empty["ft_won_rate"] == 0.0


# --- skew -------------------------------------------------------------------


def test_hot_key_of_a_join_is_split(spark):
    answers = spark.range(60_000).select(
        F.col("id").alias("Id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("ParentId"),
        F.sha2(F.col("id").cast("string"), 512).alias("Body"),
    )
    good = spark.range(0, 60_000, 2).withColumnRenamed("id", "Id")
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        kept = votes.answers_of_good_questions(answers, good)
        assert len(kept.collect()) == 20_000 + 20_000
        assert "skew" in kept._jdf.queryExecution().executedPlan().toString().lower()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_outputs_move_before_their_answers_are_extracted(spark):
    outputs = spark.createDataFrame(
        [("ee_qa", "base", 1, "<think>a b</think>c", 1.0)],
        "benchmark string, model string, item_pos long, raw_output string, time_seconds double")
    items = spark.createDataFrame(
        [("ee_qa", 1, "q", "c")], "benchmark string, item_pos long, question string, reference string")
    scored = scoring.score_outputs(outputs, items)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "</think>" in plan and "</think>" not in plan.split("Join", 1)[1]
    row = scored.first()
    assert (row.predicted_answer, row.thinking_tokens, row.answer_tokens) == ("c", 2, 1)


def test_outputs_scored_against_two_benchmarks_move_once(spark, tmp_path):
    rows = [("base", 1, "<think>a</think>Final Answer: 5", 1.0), ("ft", 1, "5", 2.0), ("ft", 2, "7", 3.0),
            ("ft", None, "8", 1.0)]
    spark.createDataFrame(rows, "model string, item_pos long, raw_output string, time_seconds double").write.parquet(
        str(tmp_path / "outputs"))
    stored = spark.read.parquet(str(tmp_path / "outputs"))
    outputs = stored.filter("model = 'base'").unionByName(stored.filter("model = 'ft'"))
    items = {b: spark.createDataFrame([(b, 1, "q", "5"), (b, 3, "q", "6"), ("other", 2, "q", "7")],
                                      "benchmark string, item_pos long, question string, reference string")
             for b in ("gsm8k", "ee_qa")}

    def scored(**how):
        found = [scoring.score_outputs(
            outputs if how else outputs.withColumn("benchmark", F.lit(b)), items[b],
            **{k: b for k in how}) for b in items]
        return found[0].unionByName(found[1])

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        once = scored(benchmark=True)
        assert once.columns == scored().columns
        got = sorted(map(str, once.collect()))
        assert len(got) == 4 and got == sorted(map(str, scored().collect()))
        plan = once._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
