"""Trust, alerts, gates and certification on hand-made control rows."""

from pyspark.sql import functions as F

from plumbline.plans import alerts as alerting
from plumbline.plans import gates, governance, marts, metrics, observe

ALERT = "run_id string, alert_id string, severity string, alert_type string, dataset_name string, business_impact string, resolution_status string, recommended_action string"


def alert_frame(spark, *rows):
    return spark.createDataFrame([("r", f"a{i}", s, "t", d, b, st, "do") for i, (s, d, b, st) in enumerate(rows)], ALERT)


def test_trust_with_everything_failing(spark):
    ready = spark.createDataFrame(
        [("r", "gold_revenue_analytics", 0.75, "failed", "passed", "compatible_evolution")],
        "run_id string, dataset_name string, readiness_score double, quality_status string, freshness_status string, schema_status string")
    slos = spark.createDataFrame([("r", "gold_revenue_analytics", "failed")], "run_id string, dataset_name string, slo_status string")
    volume = spark.createDataFrame([("r", "gold_revenue_analytics", "failed")], "run_id string, dataset_name string, status string")
    events = spark.createDataFrame([("r", "job", ["silver_x"], ["gold.gold_revenue_analytics"])], "run_id string, job_name string, inputs array<string>, outputs array<string>")
    members = observe.lineage_members(governance.lineage_edges(events))
    alerts = alert_frame(spark, ("critical", "other", "gold_revenue_analytics blocked", "open"))
    row = observe.dataset_trust(ready, slos, volume, governance.catalog_table(spark), members, alerts).first()
    assert row.trust_score_band in ("At Risk", "Blocked")
    assert row.reason_codes == ["critical_open_alert", "failed_quality_gate", "freshness_or_slo_risk", "row_count_anomaly"]
    assert row.recommended_action.startswith("Block publication")
    expected = 75 * .18 + 25 * .16 + 100 * .12 + 100 * .12 + 55 * .12 + 45 * .1 + 100 * .08 + 100 * .06 + 30 * .06
    assert row.trust_score_overall == round(expected, 2)


def test_routes(spark):
    alerts = alert_frame(spark, ("critical", "d", "x", "open"), ("weird", "d", "x", "open"), ("high", "d", "x", "resolved"))
    rows = alerting.route_alerts(alerts, "now").collect()
    assert sorted((r.alert_id, r.route) for r in rows) == [
        ("a0", "pagerduty:data-platform-primary"), ("a0", "slack:#data-incidents"), ("a1", "email:data-platform@example.com")]
    assert rows[0].message == "CRITICAL t on d: x"


def test_alert_ids_are_repeatable(spark):
    ready = spark.createDataFrame([("r", "gold_x", "at_risk")], "run_id string, dataset_name string, readiness_status string")
    one, two = [alerting.derive_alerts("now", ready=ready).first().alert_id for _ in range(2)]
    assert one == two


def test_row_count_anomaly_edges(spark):
    rows = [("d", i, n) for i, n in enumerate([0, 0, 10, 10, 14, 10, 10, 10, 10, 10, 30])]
    history = spark.createDataFrame(rows, "dataset_name string, t int, row_count long")
    got = {r.t: (r.status, r.baseline_row_count) for r in observe.row_count_anomalies(history, ["t"]).collect()}
    assert got[0] == ("passed", 0.0)
    assert got[2] == ("passed", 0.0)
    assert got[3][0] == "failed" and got[10] == ("failed", 10.57)


def gate_frame(spark, *rows):
    return spark.createDataFrame(
        [("r", gates.GATE_ORDER[n], n, st, sev, "o", "e", "fix") for n, st, sev in rows],
        "run_id string, gate_order int, gate_name string, status string, severity string, observed string, expected string, recommended_action string")


def test_release_decisions(spark):
    blocked = gate_frame(spark, ("slo_gate", "failed", "critical"), ("runtime_gate", "warning", "medium"))
    warned = gate_frame(spark, ("slo_gate", "passed", "critical"), ("runtime_gate", "warning", "medium"))
    clean = gate_frame(spark, ("slo_gate", "passed", "critical"))
    assert [gates.release_status(g).first().publish_decision for g in (blocked, warned, clean)] == [
        "do_not_publish", "publish_with_exception", "publish"]


def test_exceptions_by_name_and_wildcard(spark):
    table = gate_frame(spark, ("slo_gate", "failed", "critical"), ("runtime_gate", "warning", "medium"), ("reconciliation_gate", "passed", "critical"))
    register = gates.exception_table(spark, [
        ("E1", "active", "slo_gate", "2026-01-02T00:00:00+00:00"), ("E2", "active", "*", "2026-01-02T00:00:00+00:00"),
        ("E3", "active", "slo_gate", "2025-01-01T00:00:00+00:00"), ("E4", "closed", "*", "2027-01-01T00:00:00+00:00")])
    rows = {r.gate_name: r.exception_ids for r in gates.apply_exceptions(table, register, "2026-01-01T00:00:00Z").collect()}
    assert rows == {"slo_gate": ["E1", "E2"], "runtime_gate": ["E2"]}
    late = gates.apply_exceptions(table, register, "2026-02-01T00:00:00Z")
    assert gates.exception_status(late).first().status == "failed"
    assert [r.gate_name for r in gates.unresolved_gates(late).collect()] == ["slo_gate"]


def test_remediation_order_and_due(spark):
    table = gate_frame(spark, ("high_alert_gate", "warning", "medium"), ("slo_gate", "failed", "critical"), ("semantic_metric_gate", "failed", "high"))
    none = gates.apply_exceptions(table, gates.exception_table(spark, [("E", "active", "slo_gate", "2027-01-01T00:00:00+00:00")]), "2026-01-01T00:00:00Z")
    findings = spark.createDataFrame([("r", 1, "P", "own", "blocker", 3, "broken")], "run_id string, product_order int, product string, owner string, kind string, step int, finding string")
    rows = gates.remediation_plan(table, none, findings, "2026-01-01 00:00:00").orderBy("task_id").collect()
    assert [(r.task_id, r.gate_name, r.priority, r.owner) for r in rows] == [
        ("REM-001", "slo_gate", "P1", "data-platform"), ("REM-002", "semantic_metric_gate", "P2", "analytics-engineering"),
        ("REM-003", "high_alert_gate", "P3", "data-platform"), ("REM-004", "data_product_blocker", "P1", "own")]
    assert rows[0].exception_ids == ["E"] and rows[3].recommended_action == "Resolve blocker for P: broken"
    assert str(rows[1].due_at) == "2026-01-02 00:00:00"


def test_certification(spark):
    runs = spark.createDataFrame([("r", "passed", "passed", "passed", "passed")],
                                 "run_id string, semantic_status string, reconciliation_status string, pii_status string, catalog_status string")
    products = [("One", "o", "tier_1", ("gold_a",), 90.0, "g"), ("Two", "o", "tier_2", ("gold_b",), 75.0, "g"), ("Three", "o", "tier_2", ("gold_c",), 75.0, "g")]
    ready = spark.createDataFrame([("r", "gold_a", "ready"), ("r", "gold_b", "ready")], "run_id string, dataset_name string, readiness_status string")
    slos = spark.createDataFrame([("r", "gold_a", "passed"), ("r", "gold_b", "passed")], "run_id string, dataset_name string, slo_status string")
    trust = spark.createDataFrame([("r", "gold_a", 95.0, "Trusted"), ("r", "gold_b", 80.0, "Monitor")], "run_id string, dataset_name string, trust_score_overall double, trust_score_band string")
    alerts = alert_frame(spark, ("high", "silver", "gold_b is late", "open"), ("critical", "gold_a", "", "resolved"))
    findings = gates.certification_findings(runs, ready, slos, trust, alerts, products)
    rows = {r["product"]: (r.status, r.blocker_count, r.warning_count) for r in gates.certify(runs, findings, products).collect()}
    assert rows == {"One": ("certified", 0, 0), "Two": ("conditional", 0, 2), "Three": ("blocked", 1, 0)}
    assert {r.finding for r in findings.collect()} == {
        "gold_b trust band is Monitor", "high alert t on silver", "gold_c has no readiness record"}


def test_metric_check_finds_missing_columns():
    rows = metrics.check_metrics({"gold_revenue_analytics": ["gross_revenue", "completed_orders"]})
    assert {r["metric"]: r["missing_columns"] for r in rows if r["status"] == "failed"} == {
        "revenue_attainment": ["revenue_target"], "roas": ["attributed_revenue", "spend"],
        "dataset_readiness_score": ["readiness_score"]}


def test_coverage_ignores_controls_that_do_not_apply(spark):
    flags = dict.fromkeys(governance.SOURCE_CONTROLS, True) | {"catalog": False}
    sources = spark.createDataFrame([("s", *flags.values())], "entity string, " + ", ".join(f"{c} boolean" for c in flags))
    gold = spark.createDataFrame([("g", *[True] * 7)], "entity string, " + ", ".join(f"{c} boolean" for c in governance.GOLD_CONTROLS))
    row = governance.control_coverage(governance.control_matrix(sources, gold)).first()
    assert (row.covered_count, row.flag_count, row.control_coverage_pct) == (12, 13, 0.9231)


def test_products_keep_unknown(spark):
    products = spark.createDataFrame([("P1", "a", "c", True)], "product_id string, product_name string, category string, active_flag boolean")
    orders = spark.createDataFrame([("P9", "completed", 2, 5.0)], "product_id string, status string, quantity long, amount double").withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    rows = {r.product_id: tuple(r)[1:] for r in marts.gold_product_performance(products, orders, keep_unknown=True).collect()}
    assert rows == {"P1": ("a", "c", True, 0, 0, 0.0), "P9": ("unknown", "unknown", False, 1, 2, 5.0)}


def test_campaign_listed_twice_multiplies(spark):
    orders = spark.createDataFrame([("c", "completed", 5.0), ("c", "failed", 1.0), (None, "completed", 2.0)], "campaign_id string, status string, amount double").withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    campaigns = spark.createDataFrame([("c", "web", 10.0), ("c", "web", 4.0), ("c", "tv", 1.0)], "campaign_id string, channel string, spend double").withColumn("spend", F.col("spend").cast("decimal(18,4)"))
    rows = {(r.campaign_id, r.channel): (r.spend, r.attributed_orders, r.attributed_revenue) for r in marts.gold_marketing_attribution(orders, campaigns).collect()}
    assert rows == {("c", "web"): (10.0, 2, 10.0), ("c", "tv"): (1.0, 1, 5.0), ("unknown", "unknown"): (0.0, 1, 2.0)}


def test_controls_follow_the_tables_that_prove_them(spark):
    """A control holds where its table has the entity, or a row for all; without the table it is missing."""
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "entity string")
    entities = spark.createDataFrame([("a", "source"), ("b", "source"), ("m", "gold_dataset"), ("m", "gold_dataset")], "entity string, entity_type string")
    evidence = {"source_contract": names("a", "b", "other"), "catalog": names("m", "m"), "reconciliation": names(None), "release_gate": names()}
    got = {r.entity: r.asDict() for r in governance.derived_controls(entities, evidence).collect()}
    assert got["a"]["source_contract"] and got["a"]["catalog"] is False and got["a"]["reconciliation"] is None and len(got) == 3
    assert got["m"]["catalog"] and got["m"]["reconciliation"] and got["m"]["release_gate"] is False and got["m"]["source_contract"] is None
    assert governance.control_coverage(governance.derived_controls(entities, evidence)).first().covered_count == 4
    assert governance.control_coverage(governance.derived_controls(entities, {})).first().covered_count == 0


def test_exceptions_per_gate_pages_once_per_gate_name(spark, monkeypatch):
    """Pages of covering exceptions as the pairs of gate and alert give them, but numbered without those pairs."""
    from plumbline.catalog import control
    from plumbline.operators import evidence

    runs = [f"r{i}" for i in range(30)] + [None]
    names = ["slo_gate", "runtime_gate", None]
    gate_rows = [(r, n, s) for r in runs for n in names for s in ("failed", "passed", None)] + [("r0", "slo_gate", "failed")]
    alerts = [f"A{i:03d}" for i in range(120)] + ["A007", None]
    monkeypatch.setattr(control, "gate_table", lambda spark, sf: spark.createDataFrame(gate_rows, "run_id string, gate_name string, status string"))
    monkeypatch.setattr(control, "view", lambda spark, sf, name: spark.createDataFrame([(a,) for a in alerts], "alert_id string"))
    numbered = []
    plain_pages = evidence.pages
    monkeypatch.setattr(evidence, "pages", lambda df, *args: numbered.append(df.count()) or plain_pages(df, *args))

    got = {(r.run_id, r.gate_name, r.page): (r.value_count, r.first_value, r.last_value)
           for r in control.exceptions_per_gate(spark, "").collect()}
    expected = {}
    for run, name in {(r, n) for r, n, s in gate_rows if s is not None and s != "passed"}:
        covered = sorted({a for a in alerts if a is not None and (not a.endswith("7") or name == "slo_gate")})
        for start in range(0, len(covered), 50):
            page = covered[start:start + 50]
            expected[(run, name, start // 50 + 1)] = (len(page), page[0], page[-1])
    assert got == expected
    assert max(numbered) <= len(names) * len(alerts)
