"""Readiness, volume, SLO and trust over control tables.

Control tables hold one row per ``run_id`` and entity. Every function scores all runs it is
given in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import READINESS_TARGET_OTHER, READINESS_TARGET_TIER_1, SOURCES, TIER_1_MARTS
from plumbline.functions.casts import count_when
from plumbline.operators.joins import best_mention, join_null_safe
from plumbline.operators.ordered import trailing

# Schema states that count as healthy, and the score that counts as ready.
HEALTHY_SCHEMA = ("unchanged", "new_schema", "compatible_evolution")
READY = 0.95

# Component weights of the dataset and the platform score, in report order.
DATASET_WEIGHTS = {
    "readiness": 0.18, "quality": 0.16, "freshness": 0.12, "schema_stability": 0.12,
    "slo_compliance": 0.12, "volume_anomaly": 0.10, "lineage_completeness": 0.08,
    "documentation_completeness": 0.06, "incident_history": 0.06,
}
PLATFORM_WEIGHTS = {
    "dataset_readiness": 0.18, "dataset_trust": 0.12, "slo_compliance": 0.13, "release_gate": 0.13,
    "data_product_certification": 0.10, "semantic_validation": 0.10, "reconciliation": 0.09,
    "pii_classification": 0.075, "catalog_completeness": 0.075,
}

# What to do about a score.
ACTION_TRUSTED = "Publish as certified reporting input and monitor normal SLOs."
ACTION_BY_REASON = [
    ("critical_open_alert",
     "Block publication until critical alerts are resolved and the release gate is re-run."),
    ("row_count_anomaly", "Review source load logs and partition completeness before BI refresh."),
    ("failed_quality_gate",
     "Resolve failed validation checks and regenerate the affected gold dataset."),
]
ACTION_OTHER = "Publish only with owner review, exception approval, and monitoring notes."

# Severity ranks, so that the worst of many alerts is a plain maximum.
CRITICAL, HIGH, OTHER = 3, 2, 1


def _flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def readiness(states: DataFrame) -> DataFrame:
    """Mean of four flags per dataset and run: has rows, quality, freshness, schema."""
    flags = {
        "comp_has_rows": _flag(F.col("row_count") > 0),
        "comp_quality": _flag(F.col("quality_status") == "passed"),
        "comp_freshness": _flag(F.col("freshness_status") == "passed"),
        "comp_schema": _flag(F.col("schema_status").isin(*HEALTHY_SCHEMA)),
    }
    scored = states.withColumns(flags)
    total = F.col("comp_has_rows") + F.col("comp_quality") + F.col("comp_freshness") + F.col("comp_schema")
    return scored.withColumn("readiness_score", F.round(total / 4, 4)).withColumn(
        "readiness_status", F.when(F.col("readiness_score") >= READY, "ready").otherwise("at_risk"))


def row_count_anomalies(
    history: DataFrame, order: list[str], keys: list[str] | None = None, window: int = 7,
    warn: float = 0.35, **blocks,
) -> DataFrame:
    """Row count of each run against the mean of up to ``window`` runs before it.

    A dataset with a very long history is cut into overlapping blocks, so no task holds all
    of its runs.
    """
    keys = keys or ["dataset_name"]
    scored = trailing(history, keys, order, window, {
        "__seen": F.count("row_count"), "__mean": F.avg("row_count")}, **blocks)
    base = F.coalesce(F.col("__mean"), F.col("row_count").cast("double"))
    delta = F.when(base == 0, 0.0).otherwise(F.abs(F.col("row_count") - base) / base)
    return scored.withColumns({
        "baseline_row_count": F.round(base, 2),
        "delta_pct": F.round(delta, 4),
        "threshold": F.lit(warn),
        "status": F.when((F.col("__seen") > 0) & (delta > warn), "failed").otherwise("passed"),
    }).drop("__seen", "__mean")


def latest_loads(load_log: DataFrame) -> DataFrame:
    return load_log.groupBy("source_system").agg(F.max("load_time").alias("last_load_time"))


def contract_table(spark) -> DataFrame:
    return spark.createDataFrame(
        [(s.name, s.owner, s.tier, s.freshness_minutes // 60, s.freshness_minutes) for s in SOURCES.values()],
        "source_system string, owner string, criticality_tier string, freshness_sla_hours int, "
        "freshness_sla_minutes int")


def source_slos(
    contracts: DataFrame, load_log: DataFrame, check_age: bool = False, as_of: str | None = None
) -> DataFrame:
    """A source passes once it was ever loaded; with ``check_age`` its age must also fit the SLA."""
    joined = contracts.join(latest_loads(load_log), "source_system", "left")
    passed = F.col("last_load_time").isNotNull()
    if check_age:
        age = (
            F.unix_timestamp(F.lit(as_of).cast("timestamp"))
            - F.unix_timestamp(F.col("last_load_time").cast("timestamp"))
        ) / 60
        passed = passed & (age <= F.col("freshness_sla_minutes"))
    return joined.withColumns({
        "loaded": F.col("last_load_time").isNotNull(),
        "slo_status": F.when(passed, "passed").otherwise("failed"),
    })


def gold_slos(ready: DataFrame, tier_1: tuple[str, ...] = TIER_1_MARTS) -> DataFrame:
    target = F.when(F.col("dataset_name").isin(*tier_1), READINESS_TARGET_TIER_1).otherwise(
        READINESS_TARGET_OTHER)
    return ready.withColumn("readiness_target", target).withColumn(
        "slo_status",
        F.when(F.col("readiness_score") >= F.col("readiness_target"), "passed").otherwise("failed"),
    )


def all_slos(sources: DataFrame, gold: DataFrame) -> DataFrame:
    """Source and gold objectives as one list."""
    return sources.select(
        F.lit("source").alias("kind"), F.col("source_system").alias("entity"), "slo_status",
    ).unionByName(gold.select(
        F.lit("gold").alias("kind"), F.col("dataset_name").alias("entity"), "slo_status"))


# -- trust ----------------------------------------------------------------------------------

def severity_rank(severity: Column) -> Column:
    return F.when(severity == "critical", CRITICAL).when(severity == "high", HIGH).otherwise(OTHER)


def worst_alerts(alerts: DataFrame, datasets: DataFrame) -> DataFrame:
    """Worst open alert per run and dataset.

    An alert concerns a dataset it names, or one whose name stands in its business impact.
    The equality part and the text part are separate equi-joins. Alerts shrink to the worst
    rank per name and per text before they are joined, so repeated alerts on one dataset cannot
    pile up in one task.
    """
    keys = ["run_id"]
    opened = alerts.where(F.col("resolution_status") == "open").withColumn(
        "rank", severity_rank(F.col("severity")))
    named = datasets.select(*keys, "dataset_name").distinct()
    direct = opened.groupBy(*keys, "dataset_name").agg(F.max("rank").alias("rank"))
    texts = opened.groupBy(*keys, "business_impact").agg(F.max("rank").alias("rank"))
    mentioned = best_mention(texts, "business_impact", "rank", named, "dataset_name", on=keys)
    return (
        direct.join(named, [*keys, "dataset_name"], "left_semi")
        .unionByName(mentioned.select(*keys, "dataset_name", "rank"))
        .groupBy(*keys, "dataset_name").agg(F.max("rank").alias("rank"))
    )


def lineage_members(edges: DataFrame) -> DataFrame:
    """Dataset names that lineage knows, with and without the layer prefix."""
    ends = edges.where(F.col("relationship") == "input_to_job").select(
        "run_id", F.col("source").alias("name")
    ).unionByName(edges.where(F.col("relationship") == "job_to_output").select(
        "run_id", F.col("target").alias("name")))
    return ends.select("run_id", F.regexp_replace("name", r"^gold\.", "").alias("dataset_name")).distinct()


def score_band(score: Column) -> Column:
    return (
        F.when(score >= 90, "Trusted").when(score >= 75, "Monitor").when(score >= 60, "At Risk")
        .otherwise("Blocked")
    )


def weighted(weights: dict[str, float], column=lambda name: F.col(f"comp_{name}")) -> Column:
    total = None
    for name, weight in weights.items():
        part = column(name).cast("decimal(9,4)") * F.lit(str(weight)).cast("decimal(4,3)")
        total = part if total is None else total + part
    return F.round(total, 2).cast("double")


def dataset_trust(
    ready: DataFrame, slos: DataFrame, anomalies: DataFrame, catalog: DataFrame, members: DataFrame,
    alerts: DataFrame,
) -> DataFrame:
    """Nine weighted components per run and dataset, with band, reason codes and action.

    ``ready``, ``slos`` and ``anomalies`` are keyed by run and dataset, ``members`` lists the
    datasets lineage knows per run, ``catalog`` has owner and description per dataset.
    """
    on = ["run_id", "dataset_name"]
    documented = catalog.where(
        (F.coalesce("owner", F.lit("")) != "") & (F.coalesce("business_description", F.lit("")) != "")
    ).select("dataset_name", F.lit(True).alias("__doc")).distinct()
    rows = (
        ready.join(slos.select(*on, F.col("slo_status").alias("__slo")), on, "left")
        .join(anomalies.select(*on, F.col("status").alias("__vol")), on, "left")
        .join(members.select(*on, F.lit(True).alias("__lin")), on, "left")
        .join(documented, "dataset_name", "left")
        .join(worst_alerts(alerts, ready).withColumnRenamed("rank", "__worst"), on, "left")
    )
    worst = F.coalesce(F.col("__worst"), F.lit(0))
    rows = rows.withColumns({
        "comp_readiness": F.round(F.col("readiness_score") * 100, 2),
        "comp_quality": F.when(F.col("quality_status") == "passed", 100.0).otherwise(25.0),
        "comp_freshness": F.when(F.col("freshness_status") == "passed", 100.0).otherwise(40.0),
        "comp_schema_stability": F.when(F.col("schema_status").isin(*HEALTHY_SCHEMA), 100.0).otherwise(35.0),
        "comp_slo_compliance": F.when(F.col("__slo") == "passed", 100.0).otherwise(55.0),
        "comp_volume_anomaly": F.when(F.coalesce("__vol", F.lit("passed")) == "passed", 100.0).otherwise(45.0),
        "comp_lineage_completeness": F.when(F.col("__lin"), 100.0).otherwise(40.0),
        "comp_documentation_completeness": F.when(F.col("__doc"), 100.0).otherwise(50.0),
        "comp_incident_history": F.when(worst == CRITICAL, 30.0).when(worst == HIGH, 60.0)
        .when(worst == OTHER, 80.0).otherwise(100.0),
    })

    def low(name: str) -> Column:
        return F.col(f"comp_{name}") < 100

    reasons = F.array_sort(F.array_compact(F.array(
        F.when(worst == CRITICAL, "critical_open_alert").when(worst == HIGH, "high_open_alert")
        .when(worst == OTHER, "open_alert"),
        F.when(low("quality"), "failed_quality_gate"),
        F.when(low("freshness") | low("slo_compliance"), "freshness_or_slo_risk"),
        F.when(low("schema_stability"), "schema_instability"),
        F.when(low("volume_anomaly"), "row_count_anomaly"),
        F.when(low("lineage_completeness"), "lineage_incomplete"),
        F.when(low("documentation_completeness"), "documentation_incomplete"),
    )))
    rows = rows.withColumns({
        "trust_score_overall": weighted(DATASET_WEIGHTS), "reason_codes": reasons,
    }).withColumn("trust_score_band", score_band(F.col("trust_score_overall")))
    action = F.when(F.col("trust_score_band") == "Trusted", ACTION_TRUSTED)
    for reason, text in ACTION_BY_REASON:
        action = action.when(F.array_contains("reason_codes", reason), text)
    components = F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(f"comp_{name}").alias("score"), F.lit(weight).alias("weight"))
        for name, weight in DATASET_WEIGHTS.items()
    ])
    return rows.withColumns({
        "recommended_action": action.otherwise(ACTION_OTHER), "score_components": components,
    }).select(
        *on, "trust_score_overall", "trust_score_band", "reason_codes", "recommended_action",
        "score_components", *[f"comp_{name}" for name in DATASET_WEIGHTS])


def trust_rollup(trust: DataFrame) -> DataFrame:
    def band(name: str) -> Column:
        return count_when(F.col("trust_score_band") == name)

    return trust.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("dataset_count"), band("Trusted").alias("trusted_count"),
        band("Monitor").alias("monitor_count"), band("At Risk").alias("at_risk_count"),
        band("Blocked").alias("blocked_count"))


def component_columns(trust: DataFrame, components: str = "score_components") -> DataFrame:
    """Component array -> one ``comp_*`` column per component, by name."""
    scores = F.map_from_entries(F.transform(components, lambda c: F.struct(c["name"], c["score"])))
    return trust.withColumn("__scores", scores).withColumns({
        f"comp_{name}": F.try_element_at("__scores", F.lit(name)) for name in DATASET_WEIGHTS
    }).drop("__scores")


def platform_scorecard(facts: DataFrame) -> DataFrame:
    """Platform score per run.

    ``facts`` holds per run: mean readiness and trust, failed SLO count, and the release,
    certification, semantic, reconciliation, PII and catalog states.
    """
    def passed(column: str) -> Column:
        return F.when(F.col(column) == "passed", 100.0).otherwise(0.0)

    scored = facts.withColumns({
        "comp_dataset_readiness": F.round(F.coalesce("mean_readiness", F.lit(0.0)) * 100, 2),
        "comp_dataset_trust": F.round(F.coalesce("mean_trust", F.lit(0.0)), 2),
        "comp_slo_compliance": F.when(F.col("failed_slo_count") == 0, 100.0).otherwise(60.0),
        "comp_release_gate": F.when(F.col("release_status") == "approved", 100.0)
        .when(F.col("release_status") == "conditional", 50.0).otherwise(25.0),
        "comp_data_product_certification":
            F.when(F.col("certification_status") == "passed", 100.0).otherwise(50.0),
        "comp_semantic_validation": passed("semantic_status"),
        "comp_reconciliation": passed("reconciliation_status"),
        "comp_pii_classification": passed("pii_status"),
        "comp_catalog_completeness": passed("catalog_status"),
    })
    score = F.col("trust_score")
    return scored.withColumn("trust_score", weighted(PLATFORM_WEIGHTS)).withColumn(
        "trust_status", F.when(score >= 90, "trusted").when(score >= 75, "watch").otherwise("at_risk")
    ).select("run_id", "trust_score", "trust_status", *[f"comp_{name}" for name in PLATFORM_WEIGHTS])


def mean_scores(ready: DataFrame, trust: DataFrame) -> DataFrame:
    """Mean readiness and trust per run, summed as decimals."""
    def mean(column: str) -> Column:
        return (F.sum(F.col(column).cast("decimal(18,4)")).cast("double") / F.count(F.lit(1)))

    return join_null_safe(
        ready.groupBy("run_id").agg(mean("readiness_score").alias("mean_readiness")),
        trust.groupBy("run_id").agg(mean("trust_score_overall").alias("mean_trust")),
        ["run_id"])
