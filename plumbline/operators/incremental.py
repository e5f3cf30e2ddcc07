"""Incremental marts and replays without a table format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans import marts


def since_last(df: DataFrame, column: str, existing: DataFrame, lookback_days: int = 0,
               start: str = "1900-01-01") -> DataFrame:
    """Rows at or after the newest day of ``existing``, less ``lookback_days`` for late rows.

    The border is a scalar subquery: it is evaluated inside the same job and reaches the scan
    as a filter.
    """
    newest = existing.agg(
        F.date_sub(F.coalesce(F.max(column), F.lit(start).cast("date")), lookback_days)
    )
    return df.where(F.col(column) >= newest.scalar())


def upsert(existing: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Rows of ``changed`` plus the rows of ``existing`` with other keys."""
    kept = existing.join(changed.select(key), key, "left_anti")
    return kept.unionByName(changed)


def refresh_revenue(
    existing: DataFrame, orders: DataFrame, targets: DataFrame, lookback_days: int = 0
) -> DataFrame:
    """Revenue mart with its newest days recomputed from ``orders``."""
    dated = orders.withColumn("order_date", F.to_date("order_ts"))
    recent = since_last(dated, "order_date", existing, lookback_days).drop("order_date")
    return upsert(existing, marts.gold_revenue_analytics(recent, targets), "order_date")


def replay_manifest(bronze: DataFrame) -> DataFrame:
    """Bronze partitions that can be replayed, from the partition columns alone."""
    return bronze.groupBy("source_system", "ingest_date", "batch_id").agg(
        F.count(F.lit(1)).alias("row_count"))


def replay_slice(bronze: DataFrame, source: str, ingest_date: str | None = None, batch_id: str | None = None) -> DataFrame:
    """Bronze rows of one source and, if given, one date or batch; prunes partitions."""
    rows = bronze.where(F.col("source_system") == source)
    if ingest_date:
        rows = rows.where(F.col("ingest_date") == ingest_date)
    if batch_id:
        rows = rows.where(F.col("batch_id") == batch_id)
    return rows
