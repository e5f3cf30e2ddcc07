"""Bronze rows: the landed values plus where they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.joins import lookup

BRONZE_MARKS = ("_ingest_batch_id", "_source_file", "_source_system", "_ingested_at", "_schema_version")


def enrich(
    df: DataFrame, source: str, batch_id: str, ingested_at: str, schema_version: Column | None = None
) -> DataFrame:
    """Adds batch, source, load time and schema version; the file name comes from the reader."""
    return df.withColumns({
        "_ingest_batch_id": F.lit(batch_id),
        "_source_system": F.lit(source),
        "_ingested_at": F.lit(ingested_at),
        "_schema_version": (F.lit(None) if schema_version is None else schema_version).cast("int"),
    })


def with_file_versions(df: DataFrame, versions: DataFrame) -> DataFrame:
    """Schema version per source file, from the schema history (one row per file)."""
    per_file = versions.select(
        F.col("file_name").alias("_source_file"), F.col("current_version").cast("int").alias("_v"))
    joined = lookup(df, per_file, "_source_file", ["_block_start", "_row_rank"])
    return joined.withColumn("_schema_version", F.col("_v")).drop("_v")
