"""Spark derivations of the library's inputs from the given tables.

`contract/twins.py` states the same derivations in SQL.
"""

from pyspark.sql import functions as F

from pairloom.session import configure
from pairloom.sources.readers import spread


TEXT_KEYS = {
    "documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"],
}


_tables = {}


def table(spark, sf_dir, name):
    """A given table; its schema and files are looked up once per session."""
    key = (id(spark), sf_dir, name)
    if key not in _tables:
        df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
        _tables[key] = spread(df, *TEXT_KEYS[name]) if name in TEXT_KEYS else df
    return _tables[key]


def posts(spark, sf_dir, null_bodies=False):
    d = table(spark, sf_dir, "documents")
    is_question = F.col("doc_id") % 4 == 0
    image = F.when(F.col("doc_id") % 7 == 0, '<img src="x.png">').otherwise("")
    body = F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>\n"), image)
    if null_bodies:
        body = F.when(F.col("doc_id") % 9 != 0, body)
    return d.select(
        F.col("doc_id").alias("Id"),
        F.when(is_question, "1").otherwise("2").alias("PostTypeId"),
        F.when(~is_question, F.col("doc_id") - F.col("doc_id") % 4).alias("ParentId"),
        F.concat_ws(" ", F.lit("On"), "source", F.col("doc_id").cast("string")).alias("Title"),
        body.alias("Body"),
        F.concat(F.lit("<"), "lang", F.lit("><"), "source", F.lit(">")).alias("Tags"),
        (F.col("n_chars") % 10).alias("Score"),
    )


def votes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    kind = (
        F.when(F.col("l_quantity") > 45, "1")
        .when(F.col("l_returnflag") == "A", "3")
        .otherwise("2")
    )
    return li.select(F.col("l_partkey").alias("PostId"), kind.alias("VoteTypeId"))


def comments(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    score = F.regexp_extract("props", r"(\d+)", 1).try_cast("bigint")
    return e.select(
        (F.col("user_id") * 4).alias("PostId"),
        F.when(F.col("event_type") != "error", score).alias("Score"),
        F.col("props").alias("Text"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("CreationDate"),
    )


def pairs(spark, sf_dir):
    """Every answer with its question: the input of enrichment."""
    p = posts(spark, sf_dir).filter(F.col("PostTypeId") == "2")
    return p.select("ParentId", "Id")


def processed(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("question_id"))


def responses(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("question_id"),
        F.col("text").alias("content"),
        F.when(F.col("doc_id") % 6 == 0, "length").otherwise("stop").alias("finish_reason"),
        F.when(F.col("doc_id") % 11 == 0, "Error code: 429")
        .when(F.col("doc_id") % 13 == 0, "Connection reset")
        .alias("error"),
    )


def traced(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    trace = F.when(F.col("doc_id") % 8 == 0, "").otherwise(
        F.concat(F.lit("Consider "), "source", F.lit(": "), "text")
    )
    return d.select(
        F.col("doc_id").alias("question_id"),
        (F.col("doc_id") + 1).alias("answer_id"),
        F.col("source").alias("title"),
        F.col("text").alias("question_body"),
        F.col("text").alias("original_answer"),
        F.concat(F.lit("**"), "source", F.lit("** "), "text").alias("enriched_answer"),
        F.col("lang").alias("tags"),
        trace.alias("thinking_trace_re"),
        (F.col("doc_id") % 10 == 0).alias("trace_truncated"),
    )


def enriched(spark, sf_dir):
    return traced(spark, sf_dir).drop("thinking_trace_re", "trace_truncated")


def choice_items(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    quarter = F.floor((F.length("text") + 3) / 4).cast("int")

    def part(i):
        return F.substring(F.col("text"), F.lit(i) * quarter + 1, quarter)

    return b.select(
        F.col("item_id").alias("item_pos"),
        F.col("text").alias("question"),
        F.array(*[part(i) for i in range(4)]).alias("choices"),
        (F.col("item_id") % 4).cast("int").alias("answer"),
    )


def math_references(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 5
    tail = (
        F.when(k == 0, "1,234.50")
        .when(k == 2, F.col("doc_id").cast("string"))
        .otherwise(F.col("n_chars").cast("string"))
    )
    answer = F.when(k == 4, F.col("text")).otherwise(
        F.concat(F.col("text"), F.lit(" #### "), tail)
    )
    return d.select(
        F.col("doc_id").alias("item_pos"),
        F.col("text").alias("question"),
        answer.alias("answer"),
    )


def outputs(spark, sf_dir):
    """Raw outputs of two models; positions of the second are shifted by 7."""
    d = table(spark, sf_dir, "documents")

    def of(model, turn, shift):
        k = (F.col("doc_id") + turn) % 5
        raw = (
            F.when(k == 0, F.concat(F.lit("<think>"), "text", F.lit("</think>\n\nFinal Answer: 1,234.50.")))
            .when(k == 1, F.concat(F.lit("<think>"), "text"))
            .when(k == 2, F.concat("text", F.lit(" \\boxed{"), F.col("doc_id").cast("string"), F.lit("}")))
            .when(k == 3, F.concat(F.lit("The answer is "), F.col("n_chars").cast("string"), F.lit(".")))
            .otherwise(F.col("text"))
        )
        return d.select(
            F.lit(model).alias("model"),
            (F.col("doc_id") + shift).alias("item_pos"),
            raw.alias("raw_output"),
            (F.col("n_chars") / 100.0).alias("time_seconds"),
        )

    return of("base", 0, 0).unionByName(of("ft", 1, 7))


def letters(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 4
    raw = (
        F.when(k == 0, F.concat("text", F.lit(" \\boxed{b}")))
        .when(k == 1, F.concat("text", F.lit(" so it is C")))
        .when(k == 2, F.concat("text", F.lit(" so it is C, no \\boxed{d}.")))
        .otherwise(F.col("text"))
    )
    return d.select("doc_id", raw.alias("raw_output"))


def explanations(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 5
    tail = (
        F.when(k == 0, "\nVerdict: A")
        .when(k == 1, "\nVerdict: B\nVerdict: A")
        .when(k == 2, "\nverdict:  tie")
        .when(k == 3, "\nVerdict: Both")
        .otherwise("")
    )
    return d.select(
        F.col("doc_id").alias("item_pos"),
        F.concat("text", tail).alias("explanation"),
    )
