"""Incremental ingest of landed files with Structured Streaming, as a run-to-completion job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.sources.bronze import enrich
from plumbline.sinks.lake import write_bronze


def stream_landing(spark: SparkSession, path: str, kind: str, columns: list[str], per_trigger: int | None = None) -> DataFrame:
    """New files of one format and header as a stream; all values are text."""
    reader = spark.readStream.schema(", ".join(f"`{c}` string" for c in columns))
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    if kind == "csv":
        reader = reader.option("header", True)
    return reader.format(kind).load(path).withColumns({
        "_source_file": F.col("_metadata.file_name"),
        "_block_start": F.col("_metadata.file_block_start"),
    })


def ingest_available(
    stream: DataFrame, source: str, bronze_path: str, checkpoint: str, ingest_date: str, ingested_at: str,
    after_batch: Callable[[DataFrame, str], None] | None = None,
) -> StreamingQuery:
    """Writes everything that has arrived to bronze, one batch id per micro-batch, then stops.

    A micro-batch that is retried replaces its own partition, so rows land exactly once.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        batch_id = f"{source}-{epoch:08d}"
        placed = batch.withColumn("_row_rank", F.monotonically_increasing_id())
        write_bronze(enrich(placed, source, batch_id, ingested_at), bronze_path, ingest_date, batch_id)
        if after_batch:
            after_batch(batch, batch_id)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def dedupe_within(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """First row per key on a stream; state older than ``delay`` is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
