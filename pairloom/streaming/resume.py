"""Trace requests for enriched pairs as they are appended.

The batch form of restart is the anti join in `resume_pending`. Where enriched
pairs keep landing as new JSON-lines files, the same append-and-resume contract
is a file stream: its checkpoint remembers what was issued, so a restarted run
issues only what is new.
"""

from pyspark.sql import SparkSession

from pairloom import schemas
from pairloom.plans.enrich import TRACE_TEMPLATE, trace_requests
from pairloom.sources.readers import parse_json_lines
from pairloom.sources.writers import JSON_OPTIONS


def stream_trace_requests(
    spark: SparkSession, enriched_path, out_path, checkpoint_path,
    template=TRACE_TEMPLATE, files_per_batch=None,
):
    """Start a run over all files not seen yet; it stops when they are done."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Lines are kept and dropped by the same rule as in the batch reader.
    enriched = parse_json_lines(reader.text(enriched_path), schemas.ENRICHED_PAIRS)
    requests = trace_requests(enriched, template)
    writer = requests.writeStream.format("json").options(**JSON_OPTIONS)
    return (
        writer.option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
