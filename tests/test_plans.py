"""Physical plans, with broadcast joins switched off as they would be on large inputs."""

import re

import pytest

import __spark_entry__ as contract
from contract import fixtures as fx
from pairloom.plans import curate

DATA = "/root/testdata/sf0.001"
QUERIES = contract.QUERIES
# These write files while the query is built.
WRITERS = {n for n in QUERIES if n.endswith(("_file", "_files")) or n.startswith(("xml_", "csv_", "jsonl_"))}
WRITERS |= {"output_ids", "streamed_trace_requests"}
# One row of totals.
ONE_TASK = {"judge_rates", "token_audit", "train_profile"}


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_pairwise_joins_and_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert not re.search("NestedLoop|Cartesian", text)
    assert ("SinglePartition" in text) == (name in ONE_TASK)
    python = text.count("EvalPython")
    assert python == (1 if name in ("clean_html", "enrich_requests", "enrich_request_parts") else 0)


def test_curation_moves_ids_only_until_the_end(spark):
    text = plan(QUERIES["curate_pairs"](spark, DATA))
    assert "Window" not in text
    # Votes were read and counted once, for both kinds of posts.
    assert "l_partkey" not in text and "partial_count" not in text
    stored = [s for s in re.findall(r"ReadSchema: (\S+)", text) if "Upvotes" in s]
    assert stored == ["struct<PostId:bigint,Upvotes:bigint,Downvotes:bigint>"] * 2


def test_votes_of_both_kinds_are_counted_once(spark):
    scans = []
    real = curate.materialize
    curate.materialize = lambda df: scans.append(plan(df)) or real(df)
    try:
        QUERIES["curate_pairs"](spark, DATA)
    finally:
        curate.materialize = real
    assert len(scans) == 1 and scans[0].count("l_partkey:bigint") == 1
    assert "partial_count" in scans[0]


def test_a_split_and_a_cap_are_filters(spark):
    for name in ("split_train", "split_eval", "pending_capped"):
        text = plan(QUERIES[name](spark, DATA))
        assert not re.search("TakeOrdered|Sort .*text|rangepartitioning|GlobalLimit", text), name
        # The inputs' own spreading of a small file is the only exchange.
        if name != "pending_capped":
            assert text.count("Exchange") == text.count("REPARTITION_BY_NUM"), name


def test_texts_meet_their_blocks_in_the_last_join(spark):
    text = plan(QUERIES["training_sequences"](spark, DATA))
    narrow = [s for s in re.findall(r"ReadSchema: (\S+)", text) if "full_tokens" in s]
    wide = [s for s in re.findall(r"ReadSchema: (\S+)", text) if "text:string" in s]
    assert len(narrow) == 1 and "text:string" not in narrow[0] and wide == ["struct<_row:bigint,text:string>"]


def test_both_models_are_scored_once(spark):
    assert "raw_output" not in plan(QUERIES["compare_models"](spark, DATA))


def test_columns_are_pruned_in_the_scan(spark):
    counts = plan(QUERIES["response_status_counts"](spark, DATA))
    assert "ReadSchema: struct<doc_id:bigint>" in counts
    audit = plan(QUERIES["token_audit"](spark, DATA))
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in audit


def test_spread_leaves_large_inputs_alone(spark):
    few, many = spark.range(10).coalesce(1), spark.range(0, 100, 1, 64)
    assert fx.spread(many) is many
    assert fx.spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
