"""Dump XML, CSV, JSON lines, id lists and benchmark sets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pairloom import schemas
from pairloom.operators.votes import up_down_votes


ROW_TAG = "<row"


def read_rows(spark: SparkSession, path, fields) -> DataFrame:
    """`row` elements of a dump file, one column per wanted attribute.

    The file is cut at the opening of each element, which cannot occur inside an
    attribute, so large files are split among tasks whatever their line breaks.
    A malformed element fails the read.
    """
    schema = StructType([StructField(f"_{name}", StringType()) for name in fields])
    pieces = spark.read.option("lineSep", ROW_TAG).text(path)
    # Leaves out the file's head and elements whose name only starts alike.
    bodies = pieces.filter(F.col("value").rlike(r"\A[\s/>]"))
    element = F.concat(F.lit(ROW_TAG), F.col("value"))
    row = F.from_xml(element, schema, {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"})
    rows = bodies.select(row.alias("row"))
    return rows.select(*[_typed(name) for name in fields])


def spread(df: DataFrame, *keys) -> DataFrame:
    """Use all cores on a table that arrives in fewer tasks than there are cores.

    A file of one row group is one task, however much work its rows need. Large
    tables have more tasks than cores and are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def _typed(name):
    column = F.col(f"row._{name}")
    return (column.try_cast("bigint") if name in schemas.BIGINT_FIELDS else column).alias(name)


def read_posts(spark, path) -> DataFrame:
    posts = read_rows(spark, path, schemas.POST_FIELDS)
    return posts.filter(F.col("PostTypeId").isNotNull())


def read_votes(spark, path) -> DataFrame:
    return up_down_votes(read_rows(spark, path, schemas.VOTE_FIELDS))


def read_comments(spark, path) -> DataFrame:
    comments = read_rows(spark, path, schemas.COMMENT_FIELDS)
    return comments.filter(F.col("PostId").isNotNull())


def read_pairs(spark, path, fmt="csv") -> DataFrame:
    """Curated pairs from Parquet or CSV; in CSV quotes are doubled and bodies hold newlines.

    A CSV file with such bodies is read by one task, so steps exchange Parquet.
    """
    reader = spark.read.schema(schemas.CURATED_PAIRS)
    if fmt != "csv":
        return reader.format(fmt).load(path)
    return reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_jsonl(spark, path, schema, mode="skip") -> DataFrame:
    """JSON lines with a fixed schema; blank lines are ignored.

    `skip` leaves out lines that are not a JSON object; a field of the wrong
    type becomes null. `fail` raises on any malformed line.
    """
    if mode == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if mode != "skip":
        raise ValueError(f"unknown mode {mode!r}")
    return parse_json_lines(spark.read.text(path), schema)


def parse_json_lines(lines: DataFrame, schema) -> DataFrame:
    """The `skip` form of `read_jsonl` for lines that are already read, also of a stream."""
    bad = "_bad"
    parsed_schema = StructType([*schema.fields, StructField(bad, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    # Blanks of JSON; the parser takes them before an object as well.
    lines = lines.filter(F.ltrim("value", F.lit(" \t\r\n")).startswith("{"))
    parsed = lines.select("value", F.from_json("value", parsed_schema, options).alias("r"))
    # Only flagged lines are parsed a second time.
    usable = F.col(f"r.{bad}").isNull() | F.try_parse_json("value").isNotNull()
    return parsed.filter(usable).select(*[F.col(f"r.{f.name}") for f in schema.fields])


def read_runs(spark, records_path, ids_path, schema) -> DataFrame:
    """Records of the runs (`writers.append_run`) that have both records and ids."""
    complete = spark.read.text(ids_path).select("run").distinct()
    lines = spark.read.text(records_path).join(complete, "run", "left_semi")
    return parse_json_lines(lines.select("value"), schema)


def read_ids(spark, path) -> DataFrame:
    """One integer per line; blank lines are ignored."""
    lines = spark.read.text(path).select(F.trim("value").alias("value"))
    ids = lines.filter(F.length("value") > 0)
    return ids.select(F.col("value").cast("bigint").alias("question_id"))


def ids_from_output(spark, path) -> DataFrame:
    """Distinct question ids in earlier output; unreadable lines are skipped."""
    ids = read_jsonl(spark, path, schemas.ENRICHED_PAIRS).select("question_id")
    return ids.filter(F.col("question_id").isNotNull()).distinct()


BENCHMARK_SCHEMAS = {
    "gsm8k": schemas.MATH_ITEMS,
    "mmlu_ee": schemas.CHOICE_ITEMS,
    "ee_qa": schemas.OPEN_ITEMS,
}


def read_benchmark(spark, name, path, fmt="json") -> DataFrame:
    """A benchmark set landed as JSON lines or Parquet, with its fixed schema."""
    schema = BENCHMARK_SCHEMAS[name]
    if fmt == "json":
        return read_jsonl(spark, path, schema, "fail")
    return spark.read.schema(schema).format(fmt).load(path)


def read_results(spark, path) -> DataFrame:
    """Stored evaluation results; filters on benchmark and model prune files."""
    return spark.read.schema(schemas.EVAL_RESULTS).parquet(path)
