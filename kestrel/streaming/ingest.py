"""Append-only ingestion of landing files into a reload log table (Structured Streaming)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kestrel.session import checkpoint_dir


def ingest_reload_files(
    spark: SparkSession,
    landing_dir: str,
    schema: T.StructType,
    log_dir: str,
    *,
    file_format: str = "parquet",
    provenance_column: str = "file_name",
    provenance_field: str = "file_path",
    checkpoint_location: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a stream appending every new landing file to ``log_dir`` (Parquet), rows tagged with their file.

    ``provenance_field`` is the ``_metadata`` field stored in ``provenance_column``: the full
    ``file_path`` by default (it carries the landing batch folder), or ``file_name``.

    ``available_now`` processes what has landed and stops (a scheduled batch-style run); with
    ``False`` the stream keeps running.  The checkpoint lives under the session's shared
    checkpoint folder unless given, so a restarted or failed run resumes without duplicates.
    """
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/kestrel-ingest/{log_dir.strip('/').replace('/', '_')}"
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True)
    stream = reader.load(landing_dir).select("*", F.col(f"_metadata.{provenance_field}").alias(provenance_column))
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(log_dir)
