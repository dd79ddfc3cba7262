"""Files: dumps, CSV, JSON lines, id lists, streams, landed tables."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.operators.requests import resume_pending
from pairloom.operators.votes import post_vote_counts, split_posts
from pairloom.plans.enrich import trace_requests
from pairloom.sources import readers, writers
from pairloom.streaming.resume import stream_trace_requests

DUMP = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" Title="A &amp;amp; B" Body="&lt;p&gt;x&#xA;y&lt;/p&gt; " Tags="" Score="5" />
  <row Id=" 2 " PostTypeId="2" ParentId="1" Body="" Score="+5" />
  <row Id="x9" PostTypeId="2" ParentId="" Body="b" Score="5.0" />
  <row Id="4" PostTypeId="4" Body="wiki" />
  <row Id="5" Body="no type" />
</posts>
"""


def test_dump(spark, tmp_path):
    (tmp_path / "Posts.xml").write_text(DUMP)
    posts = readers.read_posts(spark, str(tmp_path / "Posts.xml"))
    assert posts.count() == 4
    qs, ans = split_posts(posts)
    assert [tuple(r) for r in qs.collect()] == [(1, "A &amp; B", "<p>x\ny</p> ", "", 5)]
    got = sorted((tuple(r) for r in ans.collect()), key=str)
    assert got == sorted([(2, 1, "", 5), (None, None, "b", None)], key=str)


def test_rows_may_share_lines_and_span_them(spark, tmp_path):
    (tmp_path / "v.xml").write_text(
        '\ufeff<?xml version="1.0"?><rows><row PostId="1" VoteTypeId="2"/>\n<row PostId="2" VoteTypeId="2"/>'
        '<row PostId="3"\n VoteTypeId="3" Note="a > b"></row><rowid PostId="9" VoteTypeId="2"/>\n'
        '<row\nPostId="4" VoteTypeId="2" /><row PostId="5" VoteTypeId="5"/><row/></rows>\n',
        encoding="utf-8",
    )
    votes = readers.read_votes(spark, str(tmp_path / "v.xml"))
    assert sorted(tuple(r) for r in votes.collect()) == [(1, 2), (2, 2), (3, 3), (4, 2)]


def test_malformed_rows_are_not_lost_silently(spark, tmp_path):
    (tmp_path / "v.xml").write_text('<d>\n<row PostId="1 VoteTypeId="2"/>\n<row PostId="2" VoteTypeId="2"/>\n</d>\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_votes(spark, str(tmp_path / "v.xml")).collect()


def test_dump_is_split_among_tasks(spark, tmp_path):
    lines = "".join(f'  <row PostId="{i}" VoteTypeId="2" />\n' for i in range(40_000))
    (tmp_path / "Votes.xml").write_text(f"<votes>\n{lines}</votes>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        votes = readers.read_votes(spark, str(tmp_path / "Votes.xml"))
        assert votes.rdd.getNumPartitions() > 3
        assert votes.select("PostId").distinct().count() == votes.count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_keeps_bodies(spark, tmp_path):
    bodies = ['a "quoted", b', "line\nbreak\r\n", " spaced ", "back\\slash\\", 'end"', "ünï"]
    pairs = spark.createDataFrame(
        [(9 - i, i, body, 1, 2, 3, 4, 5) for i, body in enumerate(bodies)], schemas.CURATED_PAIRS
    )
    path = str(tmp_path / "pairs")
    writers.write_pairs(pairs, path)
    back = readers.read_pairs(spark, path)
    assert back.exceptAll(pairs).count() == 0 and back.count() == len(bodies)


LINES = '{"question_id": 1, "title": "a"}\n\nnot json\n{"question_id": 2, "title": {"k": 1}}\n[1]\n{"question_id": 3\n{"question_id": "x", "title": "c"}\n'


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(LINES)
    path = str(tmp_path / "a.jsonl")
    records = readers.read_jsonl(spark, path, schemas.ENRICHED_PAIRS)
    got = [(r["question_id"], r["title"]) for r in records.collect()]
    assert got == [(1, "a"), (2, '{"k":1}'), (None, "c")]
    assert records.count() == 3
    ids = readers.ids_from_output(spark, path)
    assert sorted(r[0] for r in ids.collect()) == [1, 2]
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_jsonl(spark, path, schemas.ENRICHED_PAIRS, "fail").collect()
    with pytest.raises(ValueError):
        readers.read_jsonl(spark, path, schemas.ENRICHED_PAIRS, "other")


def test_appends_and_ids(spark, tmp_path):
    path, ids = str(tmp_path / "out"), str(tmp_path / "ids")
    one = spark.createDataFrame([(1, 10, None, "q", "a", "e", None)], schemas.ENRICHED_PAIRS)
    for _ in range(2):
        writers.append_jsonl(one, path)
        writers.append_ids(one.select("question_id"), ids)
    raw = spark.read.text(path).first()[0]
    assert '"title":null' in raw and '"tags":null' in raw
    assert readers.read_jsonl(spark, path, schemas.ENRICHED_PAIRS, "fail").exceptAll(one).count() == 1
    done = readers.read_ids(spark, ids)
    assert [r[0] for r in done.collect()] == [1, 1]
    assert resume_pending(one, done, "question_id").count() == 0


def test_id_list_ignores_blanks(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("7\n\n  8 \n")
    assert [r[0] for r in readers.read_ids(spark, str(tmp_path / "ids.txt")).collect()] == [7, 8]


def test_results_prune_by_model(spark, tmp_path):
    path = str(tmp_path / "results")
    row = ("b", "m1", 0, "q", "r", "p", True, 1, 2, 0.5, "o")
    writers.append_results(spark.createDataFrame([row], schemas.EVAL_RESULTS), path)
    writers.append_results(spark.createDataFrame([("b", "m2", *row[2:])], schemas.EVAL_RESULTS), path)
    results = readers.read_results(spark, path).filter("model = 'm2'")
    assert results.count() == 1 and len(results.inputFiles()) == 2
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model" in plan


def test_benchmark_sets(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"question": "q", "choices": ["a", "b", "c", "d"], "answer": 2}\n')
    row = readers.read_benchmark(spark, "mmlu_ee", str(tmp_path / "c.jsonl")).first()
    assert row["choices"][row["answer"]] == "c"
    parquet = str(tmp_path / "m")
    spark.createDataFrame([("q", "#### 1")], schemas.MATH_ITEMS).write.parquet(parquet)
    assert readers.read_benchmark(spark, "gsm8k", parquet, "parquet").count() == 1


def test_stream_issues_only_what_is_new(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = schemas.ENRICHED_PAIRS

    def land(*ids):
        rows = [(i, i * 10, "t", f"q{i}", "a", "e", None) for i in ids]
        writers.append_jsonl(spark.createDataFrame(rows, schema), source)

    def run():
        stream_trace_requests(spark, source, out, log, "{question}").awaitTermination()
        return sorted(r["prompt"] for r in spark.read.json(out).collect())

    land(1, 2)
    assert run() == ["q1", "q2"]
    assert run() == ["q1", "q2"]
    land(3)
    assert run() == ["q1", "q2", "q3"]


def test_landed_posts_join_without_moving_texts(spark, tmp_path):
    posts = spark.range(2000).select(
        F.col("id").alias("Id"), F.lit("1").alias("PostTypeId"), F.lit("x" * 50).alias("Body")
    )
    spark.sql(f"CREATE DATABASE landing LOCATION '{tmp_path}'")
    try:
        writers.land_posts(posts, "landing.posts", 4)
        votes = spark.range(500).select(F.col("id").alias("PostId"), F.lit(2).alias("VoteTypeId"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = post_vote_counts(spark.table("landing.posts"), votes)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # One exchange, of the votes.
        assert plan.count("Exchange") == 1
        assert joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE landing CASCADE")


def test_lines_with_json_blanks_are_kept_by_batch_and_stream(spark, tmp_path):
    lines = ['\t{"question_id": 1}', ' \t {"question_id": 2, "title": "t"}', '{"question_id": "x", "title": "u"}', "[1]", "", "{bad"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    batch = readers.read_jsonl(spark, str(tmp_path / "in"), schemas.ENRICHED_PAIRS)
    rows = sorted((r["question_id"] or 0, r["title"]) for r in batch.collect())
    assert rows == [(0, "u"), (1, None), (2, "t")]
    query = stream_trace_requests(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark"))
    query.awaitTermination()
    seen = spark.read.schema("question_id long, title string").json(str(tmp_path / "out"))
    assert sorted((r["question_id"] or 0, r["title"]) for r in seen.collect()) == rows


def test_lines_of_repeated_texts_are_stored_packed(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    body = " ".join(str(i * i) for i in range(500))
    rows = [(i, i, "t", f"{body} {i}", f"{body} {i}", f"{body} {i}", None) for i in range(40)]
    records = spark.createDataFrame(rows, schemas.ENRICHED_PAIRS)
    writers.append_jsonl(records, source)
    stream_trace_requests(spark, source, out, log).awaitTermination()
    for path, texts in ((source, 3), (out, 5)):
        size = sum(f.stat().st_size for f in (tmp_path / path).iterdir() if f.name.startswith("part-"))
        assert 0 < size < len(body) * len(rows) * texts / 3
    assert readers.read_jsonl(spark, source, schemas.ENRICHED_PAIRS, "fail").exceptAll(records).count() == 0
    asked = readers.read_jsonl(spark, out, trace_requests(records).schema, "fail")
    assert sorted(asked.collect()) == sorted(trace_requests(records).collect())
