"""Business metrics from specifications, BI measures and dashboard roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import MART_INVENTORY, METRICS
from plumbline.functions.casts import count_when


def metric_columns(metric: dict[str, str]) -> list[str]:
    return [metric[part] for part in ("expression", "numerator", "denominator") if part in metric]


def check_metrics(columns: dict[str, list[str]], metrics: list[dict[str, str]] | None = None) -> list[dict]:
    """Metrics whose columns are missing from their dataset (schemas only)."""
    results = []
    for metric in metrics if metrics is not None else METRICS:
        have = set(columns.get(metric["dataset"], []))
        missing = sorted(c for c in metric_columns(metric) if c not in have)
        results.append({
            "metric": metric["name"], "dataset": metric["dataset"],
            "required_columns": metric_columns(metric), "missing_columns": missing,
            "status": "failed" if missing else "passed"})
    return results


def _exact_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(28,6)")).cast("double")


def metric_expression(metric: dict[str, str]) -> Column:
    kind = metric["type"]
    if kind == "sum":
        return _exact_sum(metric["expression"])
    if kind == "average":
        return _exact_sum(metric["expression"]) / F.count(metric["expression"])
    if kind == "ratio":
        bottom = _exact_sum(metric["denominator"])
        return F.when(bottom != 0, _exact_sum(metric["numerator"]) / bottom)
    raise ValueError(f"unknown metric type {kind}")


def evaluate_metrics(
    tables: dict[str, DataFrame], dimensions: list[str] | None = None,
    metrics: list[dict[str, str]] | None = None,
) -> DataFrame:
    """Metric values in long form, over the given dimensions.

    All metrics of one dataset share one aggregation. Without dimensions there is one value
    per metric; metrics whose dataset lacks a dimension are left out.
    """
    dimensions = dimensions or []
    parts = []
    chosen = metrics if metrics is not None else METRICS
    for dataset in dict.fromkeys(metric["dataset"] for metric in chosen):
        table = tables.get(dataset)
        if table is None or not set(dimensions) <= set(table.columns):
            continue
        group = [metric for metric in chosen if metric["dataset"] == dataset]
        facts = table.groupBy(*dimensions).agg(*[
            metric_expression(metric).alias(f"__{metric['name']}") for metric in group])
        parts.append(facts.select(*dimensions, F.explode(F.array(*[
            F.struct(F.lit(metric["name"]).alias("metric"), F.col(f"__{metric['name']}").alias("value"))
            for metric in group])).alias("m")).select(*dimensions, "m.*"))
    return reduce(DataFrame.unionByName, parts)


def _measures(df: DataFrame, **measures: Column) -> DataFrame:
    """One aggregate pass -> one (measure, value) row per measure."""
    facts = df.agg(*[column.cast("double").alias(name) for name, column in measures.items()])
    return facts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), F.col(name).alias("value")) for name in measures
    ])).alias("m")).select("m.*")


def _mean(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(18,4)")).cast("double") / F.count(column)


def bi_measures(
    trust: DataFrame, ready: DataFrame, checks: DataFrame, drift: DataFrame, alerts: DataFrame,
    gates: DataFrame,
) -> DataFrame:
    """The nine report measures."""
    risky = F.when(F.col("trust_score_band").isin("At Risk", "Blocked"), F.col("dataset_name"))
    failed = count_when(F.col("status") == "failed")
    total = F.count(F.lit(1))
    return reduce(DataFrame.unionByName, [
        _measures(trust, overall_trust_score=_mean("trust_score_overall"), at_risk_datasets=F.countDistinct(risky)),
        _measures(ready, average_readiness_score=_mean("readiness_score")),
        _measures(checks, total_quality_checks=total, failed_quality_checks=failed,
                  quality_pass_rate=F.try_divide(total - failed, total)),
        _measures(drift, schema_drift_events=count_when(F.col("status") != "unchanged")),
        _measures(alerts, open_incidents=count_when(F.col("resolution_status") == "open")),
        _measures(gates, failed_gates=failed),
    ])


def quality_rollup(summary: DataFrame, checks: DataFrame, rejected: DataFrame, anomalies: DataFrame) -> DataFrame:
    failed = F.col("status") == "failed"
    all_checks = F.coalesce(F.sum("check_count"), F.lit(0))
    bad_checks = F.coalesce(F.sum("failed_check_count"), F.lit(0))
    return reduce(DataFrame.unionByName, [
        _measures(summary, total_checks=all_checks, failed_checks=bad_checks,
                  passed_checks=F.greatest(all_checks - bad_checks, F.lit(0)),
                  failed_datasets=count_when(F.col("quality_status") == "failed")),
        _measures(checks, warning_checks=count_when(F.col("status") == "warning"),
                  null_breaches=count_when(failed & F.col("check_name").rlike("(?i)null")),
                  duplicate_issues=count_when(failed & F.col("check_name").rlike("(?i)unique|duplicate"))),
        _measures(rejected, rejected_records=F.count(F.lit(1))),
        _measures(anomalies, row_count_anomalies=count_when(failed)),
    ])


def drift_rollup(history: DataFrame, reports: DataFrame) -> DataFrame:
    return _measures(
        history, schema_events=F.count(F.lit(1)),
        compatible_evolutions=count_when(F.col("status") == "compatible_evolution"),
        breaking_events=count_when(F.col("breaking")),
    ).unionByName(_measures(
        reports, contract_reports=F.count(F.lit(1)),
        contract_failures=count_when(F.upper("status").isin("FAIL", "QUARANTINE"))))


def alert_rollup(alerts: DataFrame) -> DataFrame:
    return _measures(
        alerts, total_alerts=F.count(F.lit(1)),
        open_alerts=count_when(F.col("resolution_status") == "open"),
        resolved_alerts=count_when(F.col("resolution_status") == "resolved"),
        high_or_critical_alerts=count_when(F.lower("severity").isin("high", "critical")))


def health_rollup(ready: DataFrame, trust: DataFrame, summary: DataFrame, alerts: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return reduce(DataFrame.unionByName, [
        _measures(ready, datasets_monitored=rows,
                  healthy_datasets=count_when(F.col("readiness_status") == "ready"),
                  at_risk_datasets=count_when(F.col("readiness_status") == "at_risk"),
                  blocked_datasets=count_when(F.col("readiness_status") == "blocked"),
                  freshness_pass_rate=F.try_divide(count_when(F.col("freshness_status") == "passed"), rows)),
        _measures(trust, average_trust_score=_mean("trust_score_overall")),
        _measures(summary, quality_pass_rate=F.try_divide(count_when(F.col("quality_status") == "passed"), rows)),
        _measures(alerts, open_alerts=count_when(F.col("resolution_status") == "open")),
    ])


def inventory_rollup(inventory: DataFrame) -> DataFrame:
    return _measures(
        inventory, mart_assets=F.count(F.lit(1)),
        csv_exports=count_when(F.col("artifact_status") == "csv_available"),
        model_only_views=count_when(F.col("artifact_status") == "dbt_model_available"),
        ready_for_bi=count_when(F.col("bi_readiness_status") == "ready"))


def tier_rollup(catalog: DataFrame) -> DataFrame:
    return _measures(catalog, catalog_entries=F.count(F.lit(1)),
                     tier_1_datasets=count_when(F.col("criticality_tier") == "tier_1"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL shown as unknown."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("unknown"))
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def chart_values(df: DataFrame, index: str, value: str) -> DataFrame:
    """Values as numbers for a chart; what is no number becomes 0."""
    number = F.col(value).cast("string").try_cast("double")
    clean = F.when(F.isnan(number), None).otherwise(number)
    return df.select(index, F.coalesce(clean, F.lit(0.0)).alias(value))


def mart_summary(counts: DataFrame, trust: DataFrame, ready: DataFrame) -> DataFrame:
    """Row count, trust and readiness per mart."""
    return counts.select("dataset_name", "row_count").join(
        trust.select("dataset_name", "trust_score_overall", "trust_score_band"), "dataset_name", "left",
    ).join(ready.select(
        "dataset_name", "readiness_status", "quality_status", "freshness_status", "schema_status"),
        "dataset_name", "left")


def readiness_with_trust(ready: DataFrame, trust: DataFrame, on: list[str] | None = None) -> DataFrame:
    keys = on or ["dataset_name"]
    return ready.join(
        trust.select(*keys, "trust_score_overall", "trust_score_band", "recommended_action"), keys, "left")


def mart_inventory(
    counts: DataFrame, catalog: DataFrame, ready: DataFrame, trust: DataFrame, marts=None
) -> DataFrame:
    """The known marts with owner, tier, readiness, trust and what exists of them."""
    spark = counts.sparkSession
    known = spark.createDataFrame(
        marts or MART_INVENTORY, "dataset_name string, business_purpose string, grain string, key_metrics string")
    rows = (
        known.join(counts.select("dataset_name", "row_count"), "dataset_name", "left")
        .join(catalog.select("dataset_name", "owner", F.col("criticality_tier").alias("criticality")), "dataset_name", "left")
        .join(ready.select("dataset_name", "readiness_status"), "dataset_name", "left")
        .join(trust.select("dataset_name", F.col("trust_score_overall").alias("trust_score")), "dataset_name", "left")
    )
    return rows.select(
        "dataset_name", F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("criticality", F.lit("")).alias("criticality"),
        "business_purpose", "grain", "key_metrics",
        F.coalesce("readiness_status", F.lit("model_defined")).alias("bi_readiness_status"), "trust_score",
        F.when(F.col("row_count").isNotNull(), "csv_available").otherwise("dbt_model_available").alias("artifact_status"))
