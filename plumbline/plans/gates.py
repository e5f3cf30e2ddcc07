"""Release gates, exceptions, product certification and remediation, for any set of runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import DATA_PRODUCTS, EXCEPTIONS, RECONCILED_DATASETS
from plumbline.functions.casts import count_when
from plumbline.operators.evidence import first_values
from plumbline.operators.joins import join_null_safe
from plumbline.operators.ordered import with_position

RUNTIME_LIMIT_SECONDS = 60

# Recommended action per gate, in gate order.
GATE_ACTIONS = {
    "silver_quality_gate": "Resolve failed validation checks or explicitly quarantine affected datasets.",
    "critical_alert_gate": "Resolve critical open alerts before certifying a release.",
    "slo_gate": "Restore failed SLOs or mark the release as intentionally degraded.",
    "data_product_certification_gate": "Clear blocked data products or publish with executive exception.",
    "semantic_metric_gate": "Fix semantic metric references before exposing certified measures.",
    "reconciliation_gate": "Resolve revenue/order reconciliation differences before release.",
    "pii_classification_gate": "Update classification metadata or remove unexpected PII exposure.",
    "catalog_completeness_gate": "Complete required catalog fields and missing gold entries.",
    "dataset_trust_gate":
        "Resolve trust score reason codes or publish with a documented data owner exception.",
    "runtime_gate": "Investigate slow pipeline phases in runtime profile.",
    "lineage_graph_gate": "Regenerate lineage events and graph before release.",
    "high_alert_gate": "Review high-severity alerts before release.",
}
GATE_ORDER = {name: i for i, name in enumerate(GATE_ACTIONS)}

# Who resolves a gate.
GATE_OWNERS = {
    "silver_quality_gate": "data-governance",
    "critical_alert_gate": "data-platform",
    "slo_gate": "data-platform",
    "data_product_certification_gate": "data-product-owner",
    "semantic_metric_gate": "analytics-engineering",
    "reconciliation_gate": "finance-analytics",
    "pii_classification_gate": "data-governance",
    "catalog_completeness_gate": "data-governance",
    "runtime_gate": "data-platform",
    "lineage_graph_gate": "data-platform",
    "high_alert_gate": "data-platform",
}
DEFAULT_OWNER = "data-platform"

# Hours until a task of a priority is due.
DUE_HOURS = {"P1": 4, "P2": 24, "P3": 72, "P4": 168}


# -- gates ----------------------------------------------------------------------------------

def run_facts(
    runs: DataFrame, quality: DataFrame, slos: DataFrame, alerts: DataFrame, trust: DataFrame,
    edges: DataFrame, certification: DataFrame,
) -> DataFrame:
    """One row per run with everything the gates look at.

    ``runs`` brings the run-level states (semantic, reconciliation, PII, catalog) and the
    duration. Each control table is reduced to one row per run before it is joined.
    """
    opened = alerts.where(F.col("resolution_status") == "open").groupBy("run_id").agg(
        count_when(F.col("severity") == "critical").alias("critical_alerts"),
        count_when(F.col("severity") == "high").alias("high_alerts"))
    failed_quality = quality.groupBy("run_id").agg(
        count_when(F.col("quality_status") == "failed").alias("failed_quality"))
    failed_slos = slos.groupBy("run_id").agg(
        count_when(F.col("slo_status") == "failed").alias("failed_slo_count"))
    risky = first_values(trust.where(F.col("trust_score_band").isin("Blocked", "At Risk")), ["run_id"],
                         "dataset_name").withColumnsRenamed({"value_list": "risky", "value_count": "risky_count"})
    watched = first_values(trust.where(F.col("trust_score_band") == "Monitor"), ["run_id"],
                           "dataset_name").withColumnsRenamed({"value_list": "watched", "value_count": "watched_count"})
    graph = edges.groupBy("run_id").agg(F.count(F.lit(1)).alias("edge_count"))
    nodes = (
        edges.select("run_id", F.explode(F.array("source", "target")).alias("node")).distinct()
        .groupBy("run_id").agg(F.count(F.lit(1)).alias("node_count")))
    products = certification.groupBy("run_id").agg(
        F.when(count_when(F.col("status") == "blocked") > 0, "blocked").otherwise("passed")
        .alias("certification_status"))
    facts = runs
    for part in (opened, failed_quality, failed_slos, risky, watched, graph, nodes, products):
        facts = facts.join(part, "run_id", "left")
    counts = ["critical_alerts", "high_alerts", "failed_quality", "failed_slo_count", "risky_count",
              "watched_count", "edge_count", "node_count"]
    return facts.fillna(0, subset=counts).fillna("unknown", subset=["certification_status"])


def gate_rows(facts: DataFrame) -> DataFrame:
    """The twelve gates of each run."""
    none = F.array().cast("array<string>")

    def gate(name: str, status: Column, severity: Column | str, observed: Column, expected: str) -> Column:
        return F.struct(
            F.lit(GATE_ORDER[name]).alias("gate_order"), F.lit(name).alias("gate_name"),
            status.alias("status"),
            (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
            observed.cast("string").alias("observed"), F.lit(expected).alias("expected"),
            F.lit(GATE_ACTIONS[name]).alias("recommended_action"))

    def fails(condition: Column) -> Column:
        return F.when(condition, "failed").otherwise("passed")

    def zero(name: str, column: str) -> Column:
        return gate(name, fails(F.col(column) > 0), "critical", F.col(column), "0")

    def state(name: str, column: str, severity: str) -> Column:
        return gate(name, fails(F.coalesce(F.col(column), F.lit("unknown")) != "passed"), severity,
                    F.col(column), "passed")

    risky = F.col("risky_count") > 0
    trust_observed = F.to_json(F.struct(
        F.coalesce("risky", none).alias("blocked_or_at_risk"), F.coalesce("watched", none).alias("monitor")))
    slow = F.col("duration_seconds") > RUNTIME_LIMIT_SECONDS
    no_graph = (F.col("node_count") == 0) | (F.col("edge_count") == 0)
    gates = [
        zero("silver_quality_gate", "failed_quality"),
        zero("critical_alert_gate", "critical_alerts"),
        zero("slo_gate", "failed_slo_count"),
        gate("data_product_certification_gate", fails(F.col("certification_status") == "blocked"),
             "critical", F.col("certification_status"), "passed"),
        state("semantic_metric_gate", "semantic_status", "high"),
        state("reconciliation_gate", "reconciliation_status", "critical"),
        state("pii_classification_gate", "pii_status", "critical"),
        state("catalog_completeness_gate", "catalog_status", "high"),
        gate("dataset_trust_gate",
             F.when(risky, "failed").when(F.col("watched_count") > 0, "warning").otherwise("passed"),
             F.when(risky, "critical").otherwise("medium"), trust_observed,
             "all gold datasets Trusted or explicitly reviewed"),
        gate("runtime_gate", F.when(slow, "warning").otherwise("passed"), "medium",
             F.col("duration_seconds"), "<= 60 seconds local smoke run"),
        gate("lineage_graph_gate", fails(no_graph), "high",
             F.to_json(F.struct(F.col("node_count").alias("nodes"), F.col("edge_count").alias("edges"))),
             "nodes and edges present"),
        gate("high_alert_gate", F.when(F.col("high_alerts") > 0, "warning").otherwise("passed"), "medium",
             F.col("high_alerts"), "0"),
    ]
    return facts.select("run_id", F.explode(F.array(*gates)).alias("g")).select("run_id", "g.*")


def release_status(gates: DataFrame) -> DataFrame:
    """Blocked by a failed critical or high gate, conditional by a warning, else approved."""
    failed = F.col("status") == "failed"
    blocking = count_when(failed & F.col("severity").isin("critical", "high"))
    warnings = count_when(F.col("status") == "warning")
    return gates.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("gate_count"), count_when(failed).alias("failed_gate_count"),
        warnings.alias("warning_gate_count"),
        F.when(blocking > 0, "blocked").when(warnings > 0, "conditional").otherwise("approved")
        .alias("release_status"),
        F.when(blocking > 0, "do_not_publish").when(warnings > 0, "publish_with_exception")
        .otherwise("publish").alias("publish_decision"))


# -- exceptions -----------------------------------------------------------------------------

def exception_table(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(
        EXCEPTIONS if rows is None else rows,
        "exception_id string, status string, gate_name string, expires_at string")


def active_exceptions(register: DataFrame, now: str) -> DataFrame:
    return register.where(
        (F.col("status") == "active")
        & (F.col("expires_at").cast("timestamp") >= F.lit(now).cast("timestamp")))


def apply_exceptions(gates: DataFrame, register: DataFrame, now: str) -> DataFrame:
    """Non-passed gates with the active exceptions that cover them.

    A gate looks itself up under its own name and under ``*``: an equi-join on two keys
    instead of a join with an OR.
    """
    on = ["run_id", "gate_name"]
    open_gates = gates.where(F.col("status") != "passed").select(
        *on, F.col("status").alias("gate_status"), F.col("severity").alias("gate_severity"))
    matched = covering_exceptions(gates, register, now)
    covered = first_values(matched, on, "exception_id")
    return open_gates.join(covered, on, "left").select(
        *on, "gate_status", "gate_severity",
        F.col("value_count").isNotNull().alias("exception_applied"),
        F.coalesce("value_count", F.lit(0)).cast("bigint").alias("exception_count"),
        F.coalesce("value_list", F.array().cast("array<string>")).alias("exception_ids"))


def covering_exceptions(gates: DataFrame, register: DataFrame, now: str) -> DataFrame:
    """Every active exception of every gate that has not passed: run_id, gate_name, exception_id."""
    active = active_exceptions(register, now).select("exception_id", F.col("gate_name").alias("__key"))
    named = gates.where(F.col("status") != "passed").select("run_id", "gate_name")
    return named.withColumn("__key", F.explode(F.array(F.col("gate_name"), F.lit("*")))).join(active, "__key").select("run_id", "gate_name", "exception_id")


def trust_lists(trust: DataFrame) -> DataFrame:
    """Every dataset that the trust gate looks at: run_id, list_name (``risky`` or ``watched``), dataset_name."""
    band = F.col("trust_score_band")
    named = F.when(band.isin("Blocked", "At Risk"), "risky").when(band == "Monitor", "watched")
    return trust.select("run_id", named.alias("list_name"), "dataset_name").where("list_name is not null")


def unresolved_gates(evaluated: DataFrame) -> DataFrame:
    """Failed critical or high gates that no exception covers."""
    return evaluated.where(
        (F.col("gate_status") == "failed") & F.col("gate_severity").isin("critical", "high")
        & ~F.col("exception_applied"))


def exception_status(evaluated: DataFrame) -> DataFrame:
    left = count_when(
        (F.col("gate_status") == "failed") & F.col("gate_severity").isin("critical", "high")
        & ~F.col("exception_applied"))
    return evaluated.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("evaluated_gate_count"), left.alias("unresolved_without_exception_count"),
        F.when(left > 0, "failed").otherwise("passed").alias("status"))


# -- certification --------------------------------------------------------------------------

PRODUCT_KEYS = ["run_id", "product_order", "product", "owner"]


def _literals(rows: list[dict]) -> Column:
    """Configuration rows as one literal array of structs."""
    return F.array(*[
        F.struct(*[F.lit(value).alias(name) for name, value in row.items()]) for row in rows])


def _products(products) -> list[dict]:
    return [
        {"product_order": order, "product": name, "owner": owner, "tier": tier,
         "trust_threshold": float(threshold), "quality_gate": gate,
         "reconciled": any(d in RECONCILED_DATASETS for d in datasets)}
        for order, (name, owner, tier, datasets, threshold, gate) in enumerate(products)
    ]


def _product_datasets(products) -> list[dict]:
    return [
        {"product_order": order, "product": name, "owner": owner,
         "trust_threshold": float(threshold), "dataset_order": position, "dataset_name": dataset}
        for order, (name, owner, _, datasets, threshold, _) in enumerate(products)
        for position, dataset in enumerate(datasets)
    ]


def _finding(kind: str, step: int, text: Column, when: Column) -> Column:
    return F.when(when, F.struct(
        F.lit(kind).alias("kind"), F.lit(step).alias("step"), text.alias("finding")))


def _each(runs: DataFrame, rows: list[dict]) -> DataFrame:
    """Every run with every configuration row: an explode of literals, not a cross join."""
    return runs.withColumn("__p", F.explode(_literals(rows))).select(*runs.columns, "__p.*")


def certification_findings(
    runs: DataFrame, ready: DataFrame, slos: DataFrame, trust: DataFrame, alerts: DataFrame,
    products=None,
) -> DataFrame:
    """Every blocker and warning per run and product, one row each.

    Findings stay rows because open alerts, and so findings, have no upper bound per product.
    ``runs`` carries the run-wide semantic, reconciliation, PII and catalog states.
    """
    products = products or DATA_PRODUCTS
    return reduce(DataFrame.unionByName, [
        _dataset_findings(runs, ready, slos, trust, products),
        _alert_findings(alerts, products),
        _run_findings(runs, products),
    ])


def _dataset_findings(runs, ready, slos, trust, products) -> DataFrame:
    on = ["run_id", "dataset_name"]
    state = (
        _each(runs.select("run_id"), _product_datasets(products))
        .join(ready.select(*on, "readiness_status"), on, "left")
        .join(slos.select(*on, "slo_status"), on, "left")
        .join(trust.select(*on, "trust_score_overall", "trust_score_band"), on, "left")
    )
    name, score, limit = F.col("dataset_name"), F.col("trust_score_overall"), F.col("trust_threshold")
    absent = F.col("readiness_status").isNull()
    found = F.array_compact(F.array(
        _finding("blocker", 0, F.concat(name, F.lit(" has no readiness record")), absent),
        _finding("blocker", 1, F.concat(name, F.lit(" readiness is "), F.col("readiness_status")),
                 ~absent & (F.col("readiness_status") != "ready")),
        _finding("blocker", 2, F.concat(name, F.lit(" failed SLO target")),
                 ~absent & (F.col("slo_status") == "failed")),
        _finding("blocker", 3, F.concat(
            name, F.lit(" trust score "), score.cast("string"), F.lit(" below threshold "),
            F.format_string("%.0f", limit)), ~absent & (score < limit)),
        _finding("warning", 3, F.concat(name, F.lit(" trust band is "), F.col("trust_score_band")),
                 ~absent & (score >= limit) & (F.col("trust_score_band") != "Trusted")),
        _finding("blocker", 4, F.concat(name, F.lit(" missing trust score")), ~absent & score.isNull()),
    ))
    return state.select(
        *PRODUCT_KEYS, (F.col("dataset_order") * 10).alias("__base"), F.explode(found).alias("f"),
    ).select(*PRODUCT_KEYS, "f.kind", (F.col("__base") + F.col("f.step")).alias("step"), "f.finding")


def _alert_findings(alerts: DataFrame, products) -> DataFrame:
    """Open alerts that name a dataset of a product, or mention one in their impact.

    The manifest is a literal, so alerts are matched in place: no join and no shuffle, however
    many alerts one dataset has.
    """
    impact = F.coalesce(F.col("business_impact"), F.lit(""))
    hits = []
    for order, (product, owner, _, datasets, _, _) in enumerate(products):
        related = F.col("dataset_name").isin(*datasets)
        for dataset in datasets:
            related = related | impact.contains(dataset)
        hits.append(F.when(related, F.struct(
            F.lit(order).alias("product_order"), F.lit(product).alias("product"),
            F.lit(owner).alias("owner"))))
    return (
        alerts.where(F.col("resolution_status") == "open")
        .withColumn("p", F.explode(F.array_compact(F.array(*hits))))
        .select(
            "run_id", "p.product_order", "p.product", "p.owner",
            F.when(F.col("severity") == "critical", "blocker").otherwise("warning").alias("kind"),
            F.lit(1000).alias("step"),
            F.concat("severity", F.lit(" alert "), "alert_type", F.lit(" on "), "dataset_name")
            .alias("finding"))
    )


def _run_findings(runs: DataFrame, products) -> DataFrame:
    """Run-wide states that block every product, and reconciliation for the financial ones."""
    def bad(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("unknown")) != "passed"

    found = F.array_compact(F.array(
        _finding("blocker", 2000, F.lit("semantic metric validation failed"), bad("semantic_status")),
        _finding("blocker", 2001, F.lit("PII classification scan failed"), bad("pii_status")),
        _finding("blocker", 2002, F.lit("catalog validation failed"), bad("catalog_status")),
        _finding("blocker", 2003, F.lit("financial reconciliation failed"),
                 F.col("reconciled") & bad("reconciliation_status")),
    ))
    return _each(runs, _products(products)).select(
        *PRODUCT_KEYS, F.explode(found).alias("f")
    ).select(*PRODUCT_KEYS, "f.kind", "f.step", "f.finding")


def certify(runs: DataFrame, findings: DataFrame, products=None) -> DataFrame:
    """Status per run and product: blocked, conditional or certified."""
    counted = findings.groupBy("run_id", "product").agg(
        count_when(F.col("kind") == "blocker").alias("blocker_count"),
        count_when(F.col("kind") == "warning").alias("warning_count"))
    wanted = _each(runs.select("run_id"), _products(products or DATA_PRODUCTS)).drop("reconciled")
    return (
        wanted.join(counted, ["run_id", "product"], "left")
        .fillna(0, ["blocker_count", "warning_count"])
        .withColumn(
            "status",
            F.when(F.col("blocker_count") > 0, "blocked")
            .when(F.col("warning_count") > 0, "conditional").otherwise("certified"))
    )


# -- remediation ----------------------------------------------------------------------------

def remediation_plan(gates: DataFrame, exceptions: DataFrame, findings: DataFrame, now: str) -> DataFrame:
    """One task per open gate, in gate order, then one per product blocker, in product order."""
    owner = None
    for gate, name in GATE_OWNERS.items():
        hit = F.col("gate_name") == gate
        owner = F.when(hit, name) if owner is None else owner.when(hit, name)
    failed = F.col("status") == "failed"
    priority = (
        F.when(failed & (F.col("severity") == "critical"), "P1")
        .when(failed & (F.col("severity") == "high"), "P2")
        .when(F.col("status") == "warning", "P3").otherwise("P4"))
    none = F.array().cast("array<string>")
    gate_tasks = join_null_safe(
        gates.where(F.col("status") != "passed"),
        exceptions.select("run_id", "gate_name", "exception_applied", "exception_ids"),
        ["run_id", "gate_name"],
    ).select(
        "run_id", F.lit(0).alias("part"), F.col("gate_order").alias("rank"), F.lit(0).alias("step"),
        "gate_name", priority.alias("priority"), owner.otherwise(DEFAULT_OWNER).alias("owner"),
        F.coalesce("exception_applied", F.lit(False)).alias("exception_applied"),
        F.coalesce("exception_ids", none).alias("exception_ids"), "observed", "expected",
        "recommended_action")
    blockers = findings.where(F.col("kind") == "blocker").select(
        "run_id", F.lit(1).alias("part"), F.col("product_order").alias("rank"), "step",
        F.lit("data_product_blocker").alias("gate_name"), F.lit("P1").alias("priority"), "owner",
        F.lit(False).alias("exception_applied"), none.alias("exception_ids"),
        F.col("finding").alias("observed"), F.lit("no blocker").alias("expected"),
        F.concat(F.lit("Resolve blocker for "), "product", F.lit(": "), "finding").alias("recommended_action"))
    tasks = gate_tasks.unionByName(blockers)
    placed = with_position(tasks, ["run_id"], ["part", "rank", "step", "observed", "gate_name"])
    hours = None
    for level, value in DUE_HOURS.items():
        hit = F.col("priority") == level
        hours = F.when(hit, F.lit(value)) if hours is None else hours.when(hit, F.lit(value))
    due = F.lit(now).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours)
    return placed.withColumns({
        "task_id": F.format_string("REM-%03d", "_n"), "due_at": due, "status": F.lit("open"),
    }).select(
        "run_id", "task_id", "gate_name", "priority", "owner", "due_at", "exception_applied",
        "exception_ids", "observed", "expected", "recommended_action", "status")
