"""One run over all layers: landing -> bronze -> silver -> gold -> control tables.

Every stage ends in a written table and the next stage reads that table. A lost executor
costs at most one stage, and no plan grows over more than one layer.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import QUALITY_SUITES, SOURCES
from plumbline.functions.names import normalize_name
from plumbline.operators import checks, contract, drift, evidence, pii, profile, reconcile
from plumbline.operators.dedupe import REASON, accepted
from plumbline.operators.standardize import standardize
from plumbline.plans import alerts as alerting
from plumbline.plans import gates, governance, marts, metrics, observe
from plumbline.sinks import export, lake
from plumbline.sources import landing
from plumbline.sources.bronze import enrich, with_file_versions

# Which sources feed a mart.
MART_SOURCES = {
    "gold_customer_analytics": ["ecommerce_transactions", "customer_behavior", "crm_support"],
    "gold_revenue_analytics": ["ecommerce_transactions", "targets_planning"],
    "gold_marketing_attribution": ["marketing_campaigns", "ecommerce_transactions"],
    "gold_product_performance": ["product_catalog", "ecommerce_transactions"],
    "gold_operational_metrics": ["operational_logs"],
    "gold_target_vs_actual": ["ecommerce_transactions", "targets_planning"],
    "gold_data_quality_summary": list(SOURCES),
    "gold_source_freshness": list(SOURCES),
}


def escaped(value: str) -> str:
    """A folder value from which partition discovery reads ``value`` back."""
    return "".join(c if c.isalnum() or c in "-_." or ord(c) > 127 else f"%{ord(c):02X}" for c in value)


def keyed_schema(schema: T.StructType) -> T.StructType:
    """``schema`` with the run id last, as text: ids such as 0001 are not numbers."""
    others = [f for f in schema.fields if f.name != "run_id"]
    return T.StructType([*others, T.StructField("run_id", T.StringType())])


@dataclass
class Run:
    """Where a run reads and writes, and its fixed clock."""

    spark: SparkSession
    landing: str
    out: str
    run_id: str
    now: str
    date_as_timestamp: bool = False
    steps: list[tuple[str, float]] = field(default_factory=list)
    started: float = field(default_factory=time.perf_counter)
    schemas: dict[str, T.StructType] = field(default_factory=dict)

    def control(self, name: str) -> str:
        return f"{self.out}/control/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes one control table of this run and returns it as read back.

        The run's own folder is overwritten even by a table without rows: a rerun leaves no old ones.
        """
        if "run_id" in df.columns:
            df = df.where(F.col("run_id") == self.run_id).drop("run_id")
        self.schemas[name] = df.schema
        path = f"{self.control(name)}/run_id={escaped(self.run_id)}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).withColumn("run_id", F.lit(self.run_id))

    def load(self, name: str) -> DataFrame:
        """All runs' rows of a control table that this run has saved."""
        return self.spark.read.schema(keyed_schema(self.schemas[name])).parquet(self.control(name))

    def history(self, name: str, like: DataFrame) -> DataFrame | None:
        """Rows of earlier runs with the columns of ``like``, None on the first run."""
        found = lake.read_if_there(self.spark, self.control(name), keyed_schema(like.schema))
        return None if found is None else found.where(F.col("run_id") != self.run_id)

    def step(self, name: str, since: float) -> None:
        self.steps.append((name, round(time.perf_counter() - since, 4)))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# -- bronze ---------------------------------------------------------------------------------

def ingest(run: Run) -> dict[str, DataFrame]:
    """Reads all landing files, checks them file by file and writes bronze."""
    by_source: dict[str, list[landing.FileGroup]] = {}
    reports, fields, profiles, offending = [], [], [], []
    for name, spec in SOURCES.items():
        groups = landing.read_landing(run.spark, f"{run.landing}/{name}/*")
        by_source[name] = groups
        for group in groups:
            rows = group.rows.withColumnsRenamed({c: normalize_name(c) for c in group.columns})
            reports.append(contract.contract_reports(
                rows, spec, ["_source_file"], run.now, run.now, run.date_as_timestamp, group.keys))
            offending.append(contract.offending_values(rows, spec, ["_source_file"]).withColumn("source_system", F.lit(name)))
            fields.append(drift.infer_schema(
                rows, ["_source_file"], run.date_as_timestamp, keys=group.keys,
            ).withColumn("source_system", F.lit(name)))
            profiles.append(profile.profile_columns(rows).withColumn("source_system", F.lit(name)))
    if not reports:
        raise FileNotFoundError(f"no landing files below {run.landing}")
    run.save(_stack(reports).withColumnRenamed("_source_file", "file_name"), "contract_reports")
    run.save(evidence.pages(_stack(offending).withColumnRenamed("_source_file", "file_name"),
                            ["source_system", "file_name", "check_name"], "value"), "contract_evidence")
    run.save(_stack(profiles), "source_profiles")

    snaps = drift.snapshots(_stack(fields), ["source_system", "_source_file"]).select(
        "source_system", F.col("_source_file").alias("file_name"), "fields", "fingerprint",
        F.lit(run.run_id).alias("run_id"), F.lit(run.now).alias("detected_at"))
    earlier = run.history("schema_snapshots", snaps)
    snaps = run.save(snaps, "schema_snapshots")
    everything = snaps if earlier is None else earlier.select(snaps.columns).unionByName(snaps)
    versions = drift.schema_history(everything, ["detected_at", "file_name"])
    versions = run.save(versions.where(F.col("run_id") == run.run_id), "schema_history")

    bronze, log = {}, []
    for name, groups in by_source.items():
        if not groups:  # the run goes on with an empty source
            bronze[name] = enrich(landing.empty_rows(run.spark, SOURCES[name]), name, run.run_id, run.now)
            lake.clear_bronze(bronze[name], f"{run.out}/bronze", name, run.now[:10], run.run_id)
            continue
        rows = enrich(landing.union_groups(groups), name, run.run_id, run.now)
        rows = with_file_versions(rows, versions.where(F.col("source_system") == name))
        path = f"{run.out}/bronze"
        lake.write_bronze(rows, path, run.now[:10], run.run_id)
        bronze[name] = read_bronze(run, name, rows.columns)
        log.append(bronze[name].groupBy(
            F.lit(name).alias("source_system"), F.col("_source_file").alias("file_name"),
        ).agg(F.count(F.lit(1)).alias("row_count"), F.max("_schema_version").alias("schema_version")))
    run.save(lake.load_log_entries(_stack(log), run.run_id, run.now, "bronze"), "load_log_bronze")
    return bronze


def read_bronze(run: Run, source: str, columns: list[str]) -> DataFrame:
    path = f"{run.out}/bronze/source_system={lake.partition_value(source)}"
    rows = run.spark.read.option("mergeSchema", True).parquet(path)
    return rows.where(F.col("batch_id") == lake.partition_value(run.run_id)).select(*columns)


# -- silver ---------------------------------------------------------------------------------

def build_silver(run: Run, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Standardises each source; accepted rows become silver, the others go to the reject path."""
    silver, counts = {}, []
    for source, rows in bronze.items():
        dataset = f"silver_{source}"
        marked_path = f"{run.out}/silver_marked/dataset={dataset}/batch_id={lake.partition_value(run.run_id)}"
        standardize(rows, source, landing.FILE_ORDER).write.mode("overwrite").parquet(marked_path)
        marked = run.spark.read.parquet(marked_path)
        lake.write_rejects(marked, f"{run.out}/rejected", dataset, run.run_id)
        silver[dataset] = accepted(marked)
        lake.write_layer(silver[dataset], run.out, "silver", dataset, run.now[:10], run.run_id)
        counts.append(marked.agg(
            F.lit(source).alias("source_system"), F.lit(dataset).alias("dataset_name"),
            F.lit(f"{dataset}.csv").alias("file_name"),
            F.count_if(F.col(REASON).isNull()).alias("row_count"),
            F.count_if(F.col(REASON).isNotNull()).alias("rejected_count")))
    counted = run.save(_stack(counts), "silver_counts")
    run.save(lake.load_log_entries(counted, run.run_id, run.now, "silver"), "load_log_silver")
    return silver


# -- gold -----------------------------------------------------------------------------------

def build_gold(run: Run, silver: dict[str, DataFrame], quality: DataFrame, load_log: DataFrame) -> dict[str, DataFrame]:
    """The eight marts, each written and read back."""
    orders = silver["silver_ecommerce_transactions"]
    products = silver["silver_product_catalog"]
    targets = silver["silver_targets_planning"]
    gold: dict[str, DataFrame] = {}

    def publish(name: str, df: DataFrame) -> None:
        lake.write_layer(df, run.out, "gold", name, run.now[:10], run.run_id)
        path = lake.partition_path(run.out, "gold", name, run.now[:10], run.run_id)
        gold[name] = run.spark.read.schema(df.schema).parquet(path)

    publish("gold_customer_analytics", marts.gold_customer_analytics(
        orders, silver["silver_customer_behavior"], silver["silver_crm_support"]))
    publish("gold_revenue_analytics", marts.gold_revenue_analytics(orders, targets))
    publish("gold_marketing_attribution", marts.gold_marketing_attribution(
        orders, silver["silver_marketing_campaigns"]))
    publish("gold_product_performance", marts.gold_product_performance(products, orders))
    publish("gold_operational_metrics", marts.gold_operational_metrics(silver["silver_operational_logs"]))
    publish("gold_target_vs_actual", marts.gold_target_vs_actual(gold["gold_revenue_analytics"]))
    publish("gold_data_quality_summary", marts.gold_data_quality_summary(quality, run.now))
    loads = load_log.withColumn("load_time", F.col("load_time").cast("timestamp_ntz"))
    publish("gold_source_freshness", marts.gold_source_freshness(loads, run.now))
    return gold


# -- control tables -------------------------------------------------------------------------

def mart_states(run: Run, gold: dict[str, DataFrame], versions: DataFrame) -> DataFrame:
    """Row count, quality, freshness and schema state of each mart."""
    spark = run.spark
    counts = _stack([df.agg(F.lit(n).alias("dataset_name"), F.count(F.lit(1)).alias("row_count")) for n, df in gold.items()])
    feeds = spark.createDataFrame(
        [(mart, source) for mart, sources in MART_SOURCES.items() for source in sources],
        "dataset_name string, source_system string")
    stale = gold["gold_source_freshness"].groupBy("source_system").agg(
        F.count_if(F.col("freshness_status") != "passed").alias("stale"))
    broken = versions.groupBy("source_system").agg(
        F.count_if(F.col("breaking")).alias("breaking"),
        F.count_if(F.col("status") == "compatible_evolution").alias("evolved"))
    fed = feeds.join(stale, "source_system", "left").join(broken, "source_system", "left").groupBy(
        "dataset_name").agg(F.sum("stale").alias("stale"), F.sum("breaking").alias("breaking"),
                            F.sum("evolved").alias("evolved"))
    failed = gold["gold_data_quality_summary"].agg(
        F.lit("gold_data_quality_summary").alias("dataset_name"),
        F.count_if(F.col("quality_status") == "failed").alias("failed"))
    return (
        counts.join(fed, "dataset_name", "left").join(failed, "dataset_name", "left")
        .fillna(0, ["stale", "breaking", "evolved", "failed"])
        .select(
            F.lit(run.run_id).alias("run_id"), "dataset_name", F.lit(run.now).alias("evaluated_at"), "row_count",
            F.when(F.col("failed") > 0, "failed").otherwise("passed").alias("quality_status"),
            F.when(F.col("stale") > 0, "failed").otherwise("passed").alias("freshness_status"),
            F.when(F.col("breaking") > 0, "breaking_drift").when(F.col("evolved") > 0, "compatible_evolution")
            .otherwise("unchanged").alias("schema_status"))
    )


def lineage_events(run: Run, bronze, silver, gold) -> DataFrame:
    sources, layers = list(SOURCES), ["bronze", "silver_layer", "gold_layer"]
    bronze_names = [f"bronze.{source}" for source in bronze]
    rows = [
        (run.run_id, "platform_run", sources, layers),
        (run.run_id, "bronze_ingestion", sources, bronze_names),
        (run.run_id, "silver_standardization", bronze_names, list(silver)),
        (run.run_id, "gold_mart_publication", list(silver), list(gold)),
    ]
    return run.spark.createDataFrame(
        rows, "run_id string, job_name string, inputs array<string>, outputs array<string>")


def _only_status(df: DataFrame) -> str:
    """The state of a one-row report."""
    return df.select("status").first().status


def run_medallion(
    spark: SparkSession, landing_root: str, out: str, run_id: str, now: str,
    date_as_timestamp: bool = False,
) -> dict:
    """Runs every stage and returns the run summary; all tables are written below ``out``."""
    run = Run(spark, landing_root.rstrip("/"), out.rstrip("/"), run_id, now, date_as_timestamp)
    since = time.perf_counter()
    bronze = ingest(run)
    run.step("bronze_ingestion", since)

    since = time.perf_counter()
    silver = build_silver(run, bronze)
    run.step("silver_standardization", since)

    since = time.perf_counter()
    quality = run.save(checks.validate_all(silver, QUALITY_SUITES), "quality_results")
    bad = [checks.bad_values(df, QUALITY_SUITES[name]).withColumn("dataset_name", F.lit(name)) for name, df in silver.items() if name in QUALITY_SUITES]
    run.save(evidence.pages(_stack(bad), ["dataset_name", "check_name"], "value"), "quality_evidence")
    run.step("quality_validation", since)

    since = time.perf_counter()
    load_log = run.load("load_log_bronze").unionByName(run.load("load_log_silver"))
    gold = build_gold(run, silver, quality, load_log)
    totals = run.save(reconcile.reconcile_gold(
        silver["silver_ecommerce_transactions"], gold["gold_revenue_analytics"],
        gold["gold_product_performance"], gold["gold_target_vs_actual"]), "reconciliation")
    run.step("gold_publication", since)

    since = time.perf_counter()
    versions = run.load("schema_history").where(F.col("run_id") == run_id)
    ready = observe.readiness(mart_states(run, gold, versions))
    earlier = run.history("readiness", ready)
    ready = run.save(ready, "readiness")
    counted = ready.select("run_id", "dataset_name", "evaluated_at", "row_count")
    all_counts = counted if earlier is None else earlier.select(counted.columns).unionByName(counted)
    volume = observe.row_count_anomalies(all_counts, ["evaluated_at", "run_id"])
    volume = run.save(volume.where(F.col("run_id") == run_id), "row_count_anomalies")

    gold_slo = run.save(observe.gold_slos(ready), "gold_slos")
    source_slo = run.save(observe.source_slos(observe.contract_table(spark), load_log), "source_slos")
    slos = observe.all_slos(source_slo, gold_slo).withColumn("run_id", F.lit(run_id))

    reports = run.load("contract_reports").where(F.col("run_id") == run_id)
    summary = gold["gold_data_quality_summary"].withColumn("run_id", F.lit(run_id))
    rejects = run.load("silver_counts").where(F.col("run_id") == run_id)
    alerts = run.save(alerting.derive_alerts(
        now, reports, versions, rejects, summary, volume, ready), "alerts")
    run.save(alerting.route_alerts(alerts, now), "notifications")

    edges_source = lineage_events(run, bronze, silver, gold)
    edges = run.save(governance.lineage_edges(edges_source), "lineage_edges")
    catalog = run.save(governance.refresh_catalog(governance.catalog_table(spark), ready.select(
        "dataset_name", F.col("evaluated_at").alias("last_refresh"), "readiness_status")), "catalog")
    run.step("observability_scoring", since)

    since = time.perf_counter()
    scan = run.save(pii.scan_tables({**silver, **gold}), "pii_scan")
    metric_columns = {name: df.columns for name, df in gold.items()}
    metric_columns["observability.dataset_readiness"] = ready.columns
    metric_checks = metrics.check_metrics(metric_columns)
    states = {
        "semantic_status": "failed" if any(m["status"] == "failed" for m in metric_checks) else "passed",
        "reconciliation_status": _only_status(reconcile.overall_status(totals)),
        "pii_status": _only_status(reconcile.overall_status(scan)),
        "catalog_status": _only_status(governance.catalog_status(ready, catalog)),
    }
    trust = run.save(observe.dataset_trust(
        ready, gold_slo, volume, catalog, observe.lineage_members(edges), alerts), "dataset_trust")
    runs = spark.createDataFrame(
        [(run_id, *states.values(), round(time.perf_counter() - run.started, 4))],
        "run_id string, " + ", ".join(f"{name} string" for name in states) + ", duration_seconds double")
    findings = run.save(gates.certification_findings(runs, ready, gold_slo, trust, alerts), "certification_findings")
    certified = run.save(gates.certify(runs, findings), "certification")
    run.step("governance_validation", since)

    since = time.perf_counter()
    facts = gates.run_facts(runs, summary, slos, alerts, trust, edges, certified)
    gate_table = run.save(gates.gate_rows(facts), "release_gates")
    release = run.save(gates.release_status(gate_table), "release_status")
    register = gates.exception_table(spark)
    applied = run.save(gates.apply_exceptions(gate_table, register, now), "exceptions")
    run.save(evidence.pages(gates.covering_exceptions(gate_table, register, now), ["run_id", "gate_name"], "exception_id"), "exception_evidence")
    run.save(evidence.pages(gates.trust_lists(trust), ["run_id", "list_name"], "dataset_name"), "trust_evidence")
    tasks = run.save(gates.remediation_plan(gate_table, applied, findings, now), "remediation")
    means = observe.mean_scores(ready, trust)
    card = run.save(observe.platform_scorecard(
        means.join(facts.select("run_id", "failed_slo_count", *states), "run_id")
        .join(release.select("run_id", "release_status"), "run_id")
        .join(certified.groupBy("run_id").agg(
            F.when(F.count_if(F.col("status") == "blocked") > 0, "blocked").otherwise("passed")
            .alias("certification_status")), "run_id")), "scorecard")
    write_export_files(run, trust, ready, gate_table, release, quality, versions, reports, alerts, catalog, edges, gold)
    whole = F.lit(None).cast("string").alias("entity")
    entities = [(source, "source") for source in SOURCES] + [(mart, "gold_dataset") for mart in gold]
    controls = run.save(governance.derived_controls(spark.createDataFrame(entities, "entity string, entity_type string"), {
        "source_contract": reports.select(F.col("source_system").alias("entity")),
        "schema_registry": versions.select(F.col("source_system").alias("entity")),
        "quality_report": quality.select(F.regexp_replace("dataset_name", "^silver_", "").alias("entity")),
        "catalog": catalog.select(F.col("dataset_name").alias("entity")),
        "pii_classification": governance.classified(spark),
        "slo_report": source_slo.select(F.col("source_system").alias("entity")),
        "semantic_validation": runs.select(whole), "reconciliation": totals.select(whole), "certification": certified.select(whole),
        "release_gate": gate_table.select(whole), "audit_manifest": run.load("export_manifest").select(whole),
    }), "control_matrix")
    run.save(governance.control_coverage(controls.drop("run_id")), "control_coverage")
    run.step("release_and_exports", since)
    run.save(spark.createDataFrame(run.steps, "step_name string, duration_seconds double"), "run_steps")

    final, score = release.first(), card.first()
    exceptions = gates.exception_status(applied).first()
    return {
        "run_id": run_id,
        "bronze": _counts(load_log.where("layer = 'bronze'").where(F.col("run_id") == run_id), "source_system"),
        "silver": _counts(rejects, "dataset_name"),
        "gold": _counts(ready, "dataset_name"),
        "quality_status": "failed" if summary.where("quality_status = 'failed'").count() else "passed",
        "alerts": alerts.count(),
        **states,
        "trusted_datasets": trust.where("trust_score_band = 'Trusted'").count(),
        "certification_status": "blocked" if certified.where("status = 'blocked'").count() else "passed",
        "release_status": final.release_status,
        "publish_decision": final.publish_decision,
        "exception_status": exceptions.status if exceptions else "passed",
        "remediation_tasks": tasks.count(),
        "trust_score": score.trust_score,
        "trust_status": score.trust_status,
    }


def _counts(df: DataFrame, name: str) -> dict[str, int]:
    rows = df.groupBy(name).agg(F.sum("row_count").alias("n")).collect()
    return {row[name]: row.n for row in rows}


def write_export_files(run: Run, trust, ready, gate_table, release, quality, versions, reports, alerts,
                       catalog, edges, gold) -> None:
    """The flat BI files of a run and their manifest."""
    def stamped(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.lit(run.now))

    frames = {
        "dataset_trust_scores": ("control/dataset_trust", trust),
        "dataset_readiness": ("control/readiness", ready),
        "release_gates": ("control/release_gates", stamped(gate_table.join(
            release.select("run_id", "release_status", "publish_decision"), "run_id"), "evaluated_at")),
        "data_quality_results": ("control/quality_results", stamped(export.with_rule_type(quality), "validated_at")),
        "schema_drift_events": ("control/schema_history", versions),
        "contract_validations": ("control/contract_reports", reports.withColumnRenamed("file_name", "report_file")),
        "incident_log": ("control/alerts", export.incident_log(alerts)),
        "metadata_catalog": ("control/catalog", catalog),
        "lineage_edges": ("control/lineage_edges", edges),
        "gold_mart_summary": ("control/readiness", metrics.mart_summary(ready, trust, ready)),
        "gold_revenue_analytics": ("gold/gold_revenue_analytics", gold["gold_revenue_analytics"]),
        "gold_marketing_attribution": ("gold/gold_marketing_attribution", gold["gold_marketing_attribution"]),
    }
    exports = {
        name: export.Export(source, export.EXPORT_COLUMNS[name], lambda frame=frame: frame)
        for name, (source, frame) in frames.items()
    }
    run.save(export.write_exports(run.spark, exports, f"{run.out}/exports/{lake.partition_value(run.run_id)}"), "export_manifest")
