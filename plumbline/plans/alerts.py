"""Alerts from failed conditions, their routing and incident counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import ROUTES
from plumbline.functions.casts import count_when

ALERT_COLUMNS = [
    "alert_id", "run_id", "timestamp", "severity", "alert_type", "dataset_name", "source_system",
    "business_impact", "recommended_action", "resolution_status",
]

# Texts per alert type (business impact, recommended action).
TEXTS = {
    "source_contract_violation": (
        "Source data returned contract outcome {} before ingestion completed.",
        "Review contract report, upstream source changes, and downstream gold datasets at risk."),
    "schema_drift": (
        "Potential dashboard or transformation breakage from source contract violation.",
        "Review schema drift report for {} and update contract or source mapper."),
    "rejected_records": (
        "Rejected rows reduce reporting completeness and may hide upstream operational issues.",
        "Inspect {} and remediate duplicates, missing keys, or invalid values."),
    "quality_failure": (
        "One or more trusted silver datasets failed quality gates before gold publication.",
        "Review Great Expectations report and failed record exports before publishing downstream marts."),
    "row_count_anomaly": (
        "Unexpected volume change may indicate missing partitions, duplicated loads, or upstream outages.",
        "Compare source load logs and validate partition completeness before publishing dashboards."),
    "gold_dataset_not_ready": (
        "BI consumers may see stale, incomplete, or untrusted data.",
        "Resolve failed quality/freshness/schema components and rerun the gold pipeline."),
}


def _filled(template: str, value: Column | None) -> Column:
    if "{}" not in template:
        return F.lit(template)
    head, tail = template.split("{}")
    return F.concat(F.lit(head), value.cast("string"), F.lit(tail))


def _alerts(rows: DataFrame, kind: str, severity: Column, dataset: Column, source: Column, at: str,
            detail: Column | None = None, entity: Column | None = None) -> DataFrame:
    impact, action = TEXTS[kind]
    key = entity if entity is not None else dataset
    return rows.select(
        F.sha2(F.concat_ws("|", F.col("run_id"), F.lit(kind), key), 256).alias("alert_id"),
        "run_id", F.lit(at).alias("timestamp"), severity.alias("severity"),
        F.lit(kind).alias("alert_type"), dataset.alias("dataset_name"), source.alias("source_system"),
        _filled(impact, detail).alias("business_impact"),
        _filled(action, detail).alias("recommended_action"), F.lit("open").alias("resolution_status"),
    )


def contract_alerts(reports: DataFrame, at: str) -> DataFrame:
    """``reports``: run_id, source_system, file_name, status."""
    hit = reports.where(F.col("status").isin("FAIL", "QUARANTINE"))
    severity = F.when(F.col("status") == "QUARANTINE", "critical").otherwise("high")
    source = F.col("source_system")
    return _alerts(hit, "source_contract_violation", severity, source, source, at, F.col("status"),
                   F.concat_ws("|", source, F.col("file_name")))


def drift_alerts(history: DataFrame, at: str) -> DataFrame:
    """``history``: run_id, source_system, file_name, breaking."""
    source = F.col("source_system")
    return _alerts(history.where("breaking"), "schema_drift", F.lit("critical"), source, source, at,
                   F.col("file_name"), F.concat_ws("|", source, F.col("file_name")))


def reject_alerts(counts: DataFrame, at: str) -> DataFrame:
    """``counts``: run_id, dataset_name, rejected_count."""
    dataset = F.col("dataset_name")
    return _alerts(counts.where("rejected_count > 0"), "rejected_records", F.lit("high"), dataset,
                   F.regexp_replace(dataset, "^silver_", ""), at,
                   F.concat(dataset, F.lit("_rejected.jsonl")))


def quality_alerts(summary: DataFrame, at: str) -> DataFrame:
    """``summary``: run_id, dataset_name, quality_status."""
    dataset = F.col("dataset_name")
    return _alerts(summary.where("quality_status = 'failed'"), "quality_failure", F.lit("critical"),
                   dataset, F.regexp_replace(dataset, "^silver_", ""), at)


def anomaly_alerts(anomalies: DataFrame, at: str) -> DataFrame:
    return _alerts(anomalies.where("status = 'failed'"), "row_count_anomaly", F.lit("high"),
                   F.col("dataset_name"), F.lit("gold"), at)


def readiness_alerts(ready: DataFrame, at: str) -> DataFrame:
    return _alerts(ready.where("readiness_status <> 'ready'"), "gold_dataset_not_ready",
                   F.lit("critical"), F.col("dataset_name"), F.lit("gold"), at)


def derive_alerts(
    at: str, reports: DataFrame | None = None, history: DataFrame | None = None,
    rejects: DataFrame | None = None, summary: DataFrame | None = None,
    anomalies: DataFrame | None = None, ready: DataFrame | None = None,
) -> DataFrame:
    """All alerts of the given status tables. Ids are digests, so a rerun yields the same ids."""
    parts = [
        builder(table, at)
        for builder, table in (
            (contract_alerts, reports), (drift_alerts, history), (reject_alerts, rejects),
            (quality_alerts, summary), (anomaly_alerts, anomalies), (readiness_alerts, ready))
        if table is not None
    ]
    return reduce(DataFrame.unionByName, parts).select(*ALERT_COLUMNS)


def open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("resolution_status") == "open")


def routes(severity: Column) -> Column:
    """Route list of a severity; an unlisted one takes the low route."""
    def targets(level: str) -> Column:
        return F.array(*[F.lit(route) for route in ROUTES[level]])

    chosen = None
    for level in ROUTES:
        if level != "low":
            hit = severity == level
            chosen = F.when(hit, targets(level)) if chosen is None else chosen.when(hit, targets(level))
    return chosen.otherwise(targets("low"))


def route_alerts(alerts: DataFrame, created_at: str) -> DataFrame:
    """One queued notification per open alert and route."""
    return open_alerts(alerts).withColumn("route", F.explode(routes(F.col("severity")))).select(
        F.sha2(F.concat_ws("|", "alert_id", "route"), 256).alias("notification_id"),
        F.lit(created_at).alias("created_at"), "route", "alert_id", "severity", "alert_type",
        "dataset_name",
        F.concat(F.upper("severity"), F.lit(" "), "alert_type", F.lit(" on "), "dataset_name",
                 F.lit(": "), "business_impact").alias("message"),
        "recommended_action", F.lit("queued").alias("delivery_status"),
    )


def severity_counts(alerts: DataFrame) -> DataFrame:
    return open_alerts(alerts).groupBy("severity").agg(F.count(F.lit(1)).alias("alert_count"))


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` alerts; each task keeps its own top ``n`` before the merge."""
    return alerts.orderBy(F.desc("timestamp"), F.desc("alert_id")).limit(n)


def incident_summary(alerts: DataFrame, slos: DataFrame, ready: DataFrame) -> DataFrame:
    """Open alerts, critical alerts, failed SLOs and datasets at risk, as one row each."""
    opened = open_alerts(alerts).agg(
        F.count(F.lit(1)).alias("n"), count_when(F.col("severity") == "critical").alias("c"))
    parts = [
        opened.select(F.lit("open_alerts").alias("measure"), F.col("n").alias("value")),
        opened.select(F.lit("critical_alerts").alias("measure"), F.col("c").alias("value")),
        slos.agg(count_when(F.col("slo_status") == "failed").alias("value"))
        .select(F.lit("failed_slos").alias("measure"), "value"),
        ready.agg(count_when(F.col("readiness_status") != "ready").alias("value"))
        .select(F.lit("datasets_at_risk").alias("measure"), "value"),
    ]
    return reduce(DataFrame.unionByName, parts)
