"""Whole runs over the made-up landing files against outcomes worked out by hand."""

import pytest
from pyspark.sql import functions as F

from fixtures import FILES, write_landing
from plumbline.plans.medallion import Run, ingest, run_medallion

NOW = "2026-05-11T12:00:00+00:00"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    landing = write_landing(str(root / "landing"))
    summary = run_medallion(spark, landing, str(root / "lake"), "run-1", NOW, date_as_timestamp=True)
    return summary, str(root / "lake")


def gold(spark, out, name):
    return spark.read.parquet(f"{out}/gold/dataset={name}/load_date=2026-05-11/batch_id=run-1")


def control(spark, out, name):
    return spark.read.parquet(f"{out}/control/{name}")


def test_row_counts(run):
    summary, _ = run
    assert summary["bronze"]["ecommerce_transactions"] == 9
    assert summary["silver"]["silver_ecommerce_transactions"] == 8
    assert summary["gold"] == {
        "gold_customer_analytics": 5, "gold_revenue_analytics": 2, "gold_marketing_attribution": 4,
        "gold_product_performance": 5, "gold_operational_metrics": 4, "gold_target_vs_actual": 2,
        "gold_data_quality_summary": 7, "gold_source_freshness": 14}


def test_outcomes(run):
    summary, _ = run
    assert summary["quality_status"] == "failed"
    assert summary["reconciliation_status"] == "passed"
    assert summary["semantic_status"] == "passed"
    assert summary["pii_status"] == "passed"
    assert summary["catalog_status"] == "passed"
    assert summary["alerts"] == 7
    assert summary["release_status"] == "blocked"
    assert summary["publish_decision"] == "do_not_publish"
    assert summary["certification_status"] == "blocked"
    assert summary["exception_status"] == "failed"
    assert summary["trusted_datasets"] == 7


def test_revenue_mart(spark, run):
    rows = {str(r.order_date): r for r in gold(spark, run[1], "gold_revenue_analytics").collect()}
    first, second = rows["2026-05-06"], rows["2026-05-07"]
    assert (first.completed_orders, first.gross_revenue, first.refund_count, first.failed_orders) == (2, 394.25, 1, 1)
    assert (second.completed_orders, second.gross_revenue, second.refund_count, second.failed_orders) == (3, 679.15, 0, 0)
    assert (first.revenue_target, first.orders_target) == (640.0, 6)
    assert round(first.revenue_attainment, 4) == 0.616 and round(second.revenue_attainment, 4) == 0.8489


def test_marketing_mart(spark, run):
    rows = {r.campaign_id: r for r in gold(spark, run[1], "gold_marketing_attribution").collect()}
    got = {k: (r.channel, r.spend, r.attributed_orders, r.attributed_revenue, round(r.roas, 4)) for k, r in rows.items()}
    assert got == {
        "AD-6": ("affiliate", 410.0, 1, 505.75, 1.2335),
        "AD-7": ("email", 96.5, 1, 84.25, 0.8731),
        "AD-8": ("paid_social", 880.0, 2, 465.0, 0.5284),
        "AD-9": ("paid_search", 1310.25, 1, 18.4, 0.014)}


def test_customer_mart(spark, run):
    rows = gold(spark, run[1], "gold_customer_analytics").collect()
    got = {r.customer_id: (r.order_count, r.gross_revenue, r.refund_count, r.behavior_events, r.support_tickets, r.customer_segment) for r in rows}
    assert got == {
        "K11": (2, 239.25, 0, 0, 1, "standard"), "K12": (2, 310.0, 1, 2, 1, "retention_risk"),
        "K13": (1, 0.0, 0, 1, 0, "standard"), "K14": (1, 18.4, 0, 0, 0, "standard"),
        "K15": (1, 505.75, 0, 1, 1, "high_value")}


def test_product_mart(spark, run):
    rows = gold(spark, run[1], "gold_product_performance").collect()
    assert {r.product_id: (r.order_count, r.units_sold, r.gross_revenue) for r in rows} == {
        "R10": (1, 3, 84.25), "R20": (2, 2, 465.0), "R30": (1, 4, 18.4),
        "R40": (1, 1, 505.75), "R50": (0, 0, 0.0)}


def test_contracts(spark, run):
    rows = control(spark, run[1], "contract_reports").collect()
    got = {(r.source_system, r.file_name): (r.status, r.violation_count) for r in rows}
    assert got[("ecommerce_transactions", "orders_0506.csv")] == ("QUARANTINE", 1)
    assert got[("ecommerce_transactions", "orders_0507_v2.csv")] == ("QUARANTINE", 1)
    assert got[("marketing_campaigns", "campaigns_0507.csv")] == ("FAIL", 1)
    assert got[("targets_planning", "targets_may.csv")] == ("FAIL", 1)
    passing = [status for (source, _), (status, _) in got.items()
               if source not in ("ecommerce_transactions", "marketing_campaigns", "targets_planning")]
    assert passing == ["PASS"] * 4


def test_controls_come_from_the_tables_of_the_run(spark, run):
    rows = {r.entity: r.asDict() for r in control(spark, run[1], "control_matrix").collect()}
    assert len(rows) == 15 and rows["crm_support"]["source_contract"] and rows["crm_support"]["catalog"] is False
    assert rows["gold_revenue_analytics"]["catalog"] and rows["gold_revenue_analytics"]["audit_manifest"] and rows["gold_revenue_analytics"]["slo_report"] is None
    coverage = control(spark, run[1], "control_coverage").first()
    assert (coverage.source_count, coverage.gold_dataset_count, coverage.flag_count) == (7, 8, 98) and 0.5 < coverage.control_coverage_pct < 1


def test_evidence_holds_every_value(spark, run):
    rows = {(r.source_system, r.check_name): r.value_list for r in control(spark, run[1], "contract_evidence").collect()}
    assert rows == {("ecommerce_transactions", "primary_key_unique"): ["N2101"]}
    gates = {(r.gate_name, tuple(r.value_list)) for r in control(spark, run[1], "exception_evidence").collect()}
    applied = {(r.gate_name, tuple(r.exception_ids)) for r in control(spark, run[1], "exceptions").collect() if r.exception_applied}
    assert gates == applied


def test_drift(spark, run):
    rows = {r.file_name: r for r in control(spark, run[1], "schema_history").collect()}
    second = rows["orders_0507_v2.csv"]
    assert (second.previous_version, second.current_version, second.status) == (1, 2, "compatible_evolution")
    assert {(p.new, p.canonical) for p in second.safe_renames} == {
        ("order_id", "transaction_id"), ("order_timestamp", "order_ts"), ("order_value", "amount")}
    assert second.added_columns == ["coupon_code"] and second.removed_columns == []
    assert rows["orders_0506.csv"].status == "new_schema"


def test_quality(spark, run):
    rows = {(r.dataset_name, r.check_name): r for r in control(spark, run[1], "quality_results").collect()}
    failed = [key for key, r in rows.items() if r.status == "failed"]
    assert failed == [("silver_ecommerce_transactions", "null_rate_customer_id")]
    row = rows[failed[0]]
    assert (row.observed, row.failed_records, row.row_count) == (0.125, 1, 8)
    assert len(rows) == 30


def test_trust_and_gates(spark, run):
    trust = {r.dataset_name: r for r in control(spark, run[1], "dataset_trust").collect()}
    low = trust.pop("gold_data_quality_summary")
    assert (low.trust_score_overall, low.trust_score_band) == (73.9, "At Risk")
    assert low.reason_codes == ["critical_open_alert", "failed_quality_gate", "freshness_or_slo_risk"]
    assert {r.trust_score_overall for r in trust.values()} == {100.0}
    gates = {r.gate_name: r for r in control(spark, run[1], "release_gates").collect()}
    assert len(gates) == 12
    assert {k: v.observed for k, v in gates.items() if v.status != "passed" and k != "runtime_gate"} == {
        "silver_quality_gate": "1", "critical_alert_gate": "4", "slo_gate": "1",
        "data_product_certification_gate": "blocked",
        "dataset_trust_gate": '{"blocked_or_at_risk":["gold_data_quality_summary"],"monitor":[]}',
        "high_alert_gate": "3"}
    assert gates["lineage_graph_gate"].observed == '{"nodes":36,"edges":53}'


def test_remediation_ids(spark, run):
    tasks = control(spark, run[1], "remediation").orderBy("task_id").collect()
    assert [t.task_id for t in tasks] == [f"REM-{i:03d}" for i in range(1, len(tasks) + 1)]
    assert tasks[0].gate_name == "silver_quality_gate" and tasks[0].priority == "P1"
    assert tasks[0].due_at.isoformat() == "2026-05-11T16:00:00"


def test_exports(spark, run):
    rows = control(spark, run[1], "export_manifest").collect()
    assert len(rows) == 12 and all(r.status == "written" for r in rows)
    flat = spark.read.option("header", True).csv(f"{run[1]}/exports/run-1/dataset_trust_scores")
    low = flat.where(F.col("dataset_name") == "gold_data_quality_summary").first()
    assert low.reason_codes == "critical_open_alert;failed_quality_gate;freshness_or_slo_risk"


def test_second_ingest_continues_the_history(spark, run):
    out = run[1]
    again = Run(spark, out.replace("/lake", "/landing"), out, "run-2", "2026-05-12T12:00:00+00:00", True)
    bronze = ingest(again)
    assert bronze["ecommerce_transactions"].count() == 9
    history = control(spark, out, "schema_history").where("run_id = 'run-2'")
    versions = {r.file_name: (r.current_version, r.status) for r in history.collect()}
    assert versions["orders_0506.csv"] == (3, "breaking_drift")
    assert versions["orders_0507_v2.csv"] == (4, "compatible_evolution")
    assert versions["campaigns_0507.csv"] == (1, "unchanged")
    assert control(spark, out, "contract_reports").where("run_id = 'run-1'").count() == 8


def test_rerun_with_sources_gone_leaves_no_old_rows(spark, tmp_path):
    """The second run of the same id lacks two sources and the repeated order; its id looks like a number."""
    out = str(tmp_path / "lake")
    first = run_medallion(spark, write_landing(str(tmp_path / "full")), out, "0007", NOW, date_as_timestamp=True)
    rejected = f"{out}/rejected/dataset=silver_ecommerce_transactions/batch_id=0007"
    assert spark.read.text(rejected).count() == 1 and first["gold"]["gold_product_performance"] == 5
    fewer = write_landing(str(tmp_path / "fewer"), without=("crm_support", "product_catalog"))
    text = FILES["ecommerce_transactions/orders_0506.csv"].splitlines(keepends=True)
    (tmp_path / "fewer/ecommerce_transactions/orders_0506.csv").write_text("".join(dict.fromkeys(text)))
    again = run_medallion(spark, fewer, out, "0007", NOW, date_as_timestamp=True)
    assert again["silver"]["silver_crm_support"] == 0 and again["silver"]["silver_ecommerce_transactions"] == 8
    assert "crm_support" not in again["bronze"] and again["gold"]["gold_product_performance"] == 0
    assert spark.read.text(rejected).count() == 0
    base = "load_date=2026-05-11/batch_id=0007"
    assert spark.read.parquet(f"{out}/gold/dataset=gold_product_performance/{base}").count() == 0
    customers = spark.read.parquet(f"{out}/gold/dataset=gold_customer_analytics/{base}").collect()
    assert sorted((r.customer_id, r.support_tickets) for r in customers) == [(f"K1{i}", 0) for i in range(1, 6)]
    reports = control(spark, out, "contract_reports")
    assert reports.where("source_system in ('crm_support', 'product_catalog')").count() == 0


def test_control_tables_may_be_empty(spark, tmp_path):
    """A table without rows replaces an earlier one and reads back with its columns; history is None before any run."""
    run = Run(spark, "", str(tmp_path), "a/b 1", NOW)
    frame = spark.createDataFrame([("x", 1)], "name string, n int")
    assert run.history("t", frame) is None
    assert run.save(frame, "t").collect() == [("x", 1, "a/b 1")]
    assert [r.run_id for r in run.load("t").collect()] == ["a/b 1"]
    assert run.save(frame.where("n > 1"), "t").columns == ["name", "n", "run_id"] and run.load("t").count() == 0
    later = Run(spark, "", str(tmp_path), "0002", NOW)
    assert later.save(frame, "t").count() == 1 and later.history("t", frame).count() == 0
    assert run.history("t", frame).collect() == [("x", 1, "0002")]
