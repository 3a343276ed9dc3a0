"""The flag log as an append-only Structured Streaming query.

New published versions land as files; each micro-batch projects the flag
and appends to the log.  The checkpoint makes restarts exactly-once for the
file sink; ``dedupe_within`` drops repeated ids inside the watermark when
the source can deliver a version twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.flaglog import DEFAULT_MARKER, flag_rows


def start_flag_stream(
    spark: SparkSession,
    source_dir: str,
    source_schema: T.StructType,
    sink_dir: str,
    checkpoint_dir: str,
    marker: str = DEFAULT_MARKER,
    glob: str | None = None,
    rename: dict[str, str] | None = None,
    dedupe_within: str | None = None,
    available_now: bool = True,
    fmt: str = "parquet",
    recursive: bool = True,
) -> StreamingQuery:
    """Start the stream.  ``rename`` maps source columns to
    id / form_id / form / date_created.  ``available_now`` processes what is
    there and stops (batch-like runs and tests); otherwise it keeps polling."""
    reader = spark.readStream.schema(source_schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:  # landing folders often hold one sub-folder per drop
        reader = reader.option("recursiveFileLookup", "true")
    versions = reader.load(source_dir)
    for src, dst in (rename or {}).items():
        versions = versions.withColumnRenamed(src, dst)
    if dedupe_within:
        versions = versions.withWatermark("date_created", dedupe_within).dropDuplicatesWithinWatermark(["id"])
    rows = flag_rows(versions.select("id", "form_id", "form", "date_created"), marker)
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)
