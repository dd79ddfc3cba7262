"""Sinks. Appends add files; nothing is rewritten."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Quotes are doubled, and whitespace at the ends of a text survives.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Records hold the same texts several times, so packed lines are a fraction of plain ones. Readers
# unpack by the name of the file; a file is what one task wrote and is read by one.
JSON_OPTIONS = {"ignoreNullFields": "false", "compression": "gzip"}


def write_pairs(df: DataFrame, path, sort=True):
    """Curated pairs as CSV with a header, ordered by question."""
    df = df.orderBy("ParentId") if sort else df
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def append_jsonl(df: DataFrame, path):
    """Append records as packed lines; keys with null values are written."""
    df.write.mode("append").options(**JSON_OPTIONS).json(path)


def append_ids(ids: DataFrame, path):
    """Append the first column as one id per line."""
    line = F.col(ids.columns[0]).cast("string").alias("value")
    ids.select(line).filter("value IS NOT NULL").write.mode("append").text(path)


def run_id(rows: DataFrame) -> str:
    """An id that follows from the rows, in any order and partitioning."""
    row = F.xxhash64(*[F.col(c) for c in rows.columns]).cast("decimal(20,0)")
    total, n = rows.agg(F.sum(row), F.count(F.lit(1))).first()
    # A letter in front, or a folder name of digits would be read as a number.
    return f"r{int(total or 0) % 2**64:016x}-{n}"


def append_run(records: DataFrame, ids: DataFrame, records_path, ids_path, run):
    """Write the records of a run, then its ids, each over what an earlier try left.

    A run counts once it has both (`readers.read_runs`), so the two appends act as one.
    """
    folder = f"run={run}"
    records.write.mode("overwrite").options(**JSON_OPTIONS).json(f"{records_path}/{folder}")
    line = F.col(ids.columns[0]).cast("string").alias("value")
    ids.select(line).filter("value IS NOT NULL").write.mode("overwrite").text(f"{ids_path}/{folder}")


def write_split(train: DataFrame, held_out: DataFrame, train_path, eval_path):
    for df, path in ((train, train_path), (held_out, eval_path)):
        df.write.mode("overwrite").options(**JSON_OPTIONS).json(path)


def append_results(df: DataFrame, path):
    """Append evaluation results, partitioned by benchmark and model."""
    df.write.mode("append").partitionBy("benchmark", "model").parquet(path)


def write_verdicts(df: DataFrame, path):
    df.write.mode("append").options(**JSON_OPTIONS).json(path)


def write_comparison(df: DataFrame, path):
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def land_posts(posts: DataFrame, table, buckets):
    """Land the dump once: partitioned by type, bucketed and sorted on Id.

    Votes and survivors then meet the posts without shuffling any text.
    """
    writer = posts.write.mode("overwrite").format("parquet").partitionBy("PostTypeId")
    writer.bucketBy(buckets, "Id").sortBy("Id").saveAsTable(table)
