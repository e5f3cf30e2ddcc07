"""Flat exports for BI tools and warehouse loads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.casts import blank_to_null
from plumbline.operators.checks import rule_type
from plumbline.sinks.lake import counted_write

NESTED = (T.ArrayType, T.MapType, T.StructType)


def scalar(column: str, kind: T.DataType) -> Column:
    """One cell per value: scalar lists joined by ``;``, other nested values as JSON."""
    value = F.col(f"`{column}`")
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, NESTED):
        return F.array_join(value.cast("array<string>"), ";")
    if isinstance(kind, NESTED):
        return F.to_json(value)
    return value.cast("string")


def flatten(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All cells as text in the given column order; other columns dropped, missing ones empty."""
    types = {field.name: field.dataType for field in df.schema.fields}
    chosen = columns or list(types)
    return df.select(*[
        (F.coalesce(scalar(name, types[name]), F.lit("")) if name in types else F.lit("")).alias(name)
        for name in chosen])


def with_rule_type(checks: DataFrame) -> DataFrame:
    return checks.withColumn("rule_type", rule_type(F.col("check_name")))


def incident_log(alerts: DataFrame) -> DataFrame:
    return alerts.withColumnRenamed("alert_id", "incident_id")


@dataclass
class Export:
    """One exported file: where it comes from, its columns and how its frame is built."""

    source: str
    columns: list[str]
    build: Callable[[], DataFrame | None]


# Columns of each export.
EXPORT_COLUMNS: dict[str, list[str]] = {
    "dataset_trust_scores": [
        "dataset_name", "trust_score_overall", "trust_score_band", "recommended_action", "reason_codes",
        "comp_readiness", "comp_quality", "comp_freshness", "comp_schema_stability",
        "comp_slo_compliance", "comp_volume_anomaly", "comp_lineage_completeness",
        "comp_documentation_completeness", "comp_incident_history"],
    "dataset_readiness": [
        "dataset_name", "evaluated_at", "row_count", "quality_status", "freshness_status",
        "schema_status", "readiness_score", "readiness_status", "comp_has_rows", "comp_quality",
        "comp_freshness", "comp_schema"],
    "release_gates": [
        "evaluated_at", "release_status", "publish_decision", "gate_name", "status", "severity",
        "observed", "expected", "recommended_action"],
    "data_quality_results": [
        "dataset_name", "validated_at", "row_count", "check_name", "rule_type", "status", "severity",
        "observed_value", "threshold", "failed_records"],
    "schema_drift_events": [
        "source_system", "previous_version", "current_version", "status", "breaking", "added_columns",
        "removed_columns", "type_changes", "safe_renames", "detected_at"],
    "contract_validations": [
        "source_system", "dataset_name", "report_file", "status", "violation_count", "owner",
        "criticality_tier", "observed_at", "validated_at"],
    "incident_log": [
        "incident_id", "alert_type", "severity", "dataset_name", "source_system", "resolution_status",
        "business_impact", "recommended_action", "timestamp"],
    "metadata_catalog": [
        "dataset_name", "layer", "owner", "source_system", "refresh_frequency", "criticality_tier",
        "business_description", "downstream_usage", "last_refresh", "readiness_status"],
    "lineage_edges": ["source", "target", "relationship"],
    "gold_mart_summary": [
        "dataset_name", "row_count", "trust_score_overall", "trust_score_band", "readiness_status",
        "quality_status", "freshness_status", "schema_status"],
    "gold_revenue_analytics": [
        "completed_orders", "failed_orders", "gross_revenue", "order_date", "orders_target",
        "refund_count", "revenue_attainment", "revenue_target"],
    "gold_marketing_attribution": [
        "attributed_orders", "attributed_revenue", "campaign_id", "channel", "roas", "spend"],
}


def write_exports(spark: SparkSession, exports: dict[str, Export], path: str) -> DataFrame:
    """Writes every export as headed CSV and returns the manifest.

    An export without rows still gets its header and is listed as ``empty_source_missing``.
    """
    entries = []
    for name, export in exports.items():
        frame = export.build()
        if frame is None:
            frame = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in export.columns))
        rows = counted_write(
            flatten(frame, export.columns),
            lambda f, name=name: f.write.mode("overwrite").option("header", True).csv(f"{path}/{name}"))
        entries.append((name, export.source, "written" if rows else "empty_source_missing", rows))
    return spark.createDataFrame(entries, "file string, source string, status string, row_count bigint")


def warehouse_rows(df: DataFrame, columns: list[str], optional_text: tuple[str, ...] = ()) -> DataFrame:
    """Report rows in warehouse shape: nested cells as JSON, blank ``optional_text`` as NULL."""
    types = {field.name: field.dataType for field in df.schema.fields}

    def cell(name: str) -> Column:
        if name not in types:
            return F.lit(None).cast("string").alias(name)
        value = F.to_json(F.col(name)) if isinstance(types[name], NESTED) else F.col(name)
        if name in optional_text:
            value = blank_to_null(value.cast("string"))
        return value.alias(name)

    return df.select(*[cell(name) for name in columns])


def child_rows(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row for each item of an array column, with the keys of its parent and its position; the fields of a struct are columns."""
    rows = df.select(*keys, F.posexplode(column).alias("position", "item")).withColumn("position", F.col("position").cast("bigint"))
    item = df.schema[column].dataType.elementType
    return rows.select(*keys, "position", "item.*") if isinstance(item, T.StructType) else rows


# Columns of the warehouse control tables.
CONTRACT_VALIDATION_COLUMNS = [
    "source_system", "dataset_name", "validated_at", "observed_at", "owner", "business_domain",
    "business_criticality", "criticality_tier", "schema_compatibility_mode", "status", "row_count",
    "violation_count", "observed_columns", "expected_columns", "safe_renames_applied", "violations",
    "downstream_dependencies",
]
TRUST_COLUMNS = [
    "dataset_name", "scored_at", "trust_score_overall", "trust_score_band", "reason_codes",
    "recommended_action", "score_components",
]
