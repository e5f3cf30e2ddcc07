"""Contracts, drift, suites, profiles and personal data on small inputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.catalog import quality  # noqa: F401  (fills the registry)
from plumbline.catalog.registry import QUERIES
from plumbline.config import QUALITY_SUITES, SOURCES
from plumbline.operators import checks, contract, drift, pii, profile, reconcile

ORDER = {"transaction_id": "T1", "customer_id": "C1", "product_id": "P1", "order_ts": "2026-05-10T00:00:00Z",
         "amount": "25.00", "status": "completed"}


def frame(spark, *rows):
    columns = list(dict.fromkeys(c for row in rows for c in row))
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


def report(spark, source, *rows, **options):
    row = contract.contract_reports(frame(spark, *rows), SOURCES[source], **options).first()
    return row.status, {v.check_name for v in row.violations}, row


def test_renamed_columns_satisfy_contract(spark):
    row = {"order_id": "T1", "customer_id": "C1", "product_id": "P1", "order_timestamp": "2026-05-10T00:00:00Z",
           "order_value": "25.00", "status": "completed"}
    status, _, full = report(spark, "ecommerce_transactions", row)
    assert status == "PASS" and full.safe_renames_applied["order_id"] == "transaction_id"


def test_optional_column_allowed(spark):
    assert report(spark, "ecommerce_transactions", {**ORDER, "coupon_code": "X"})[0] == "PASS"


def test_unexpected_column_warns(spark):
    status, names, _ = report(spark, "ecommerce_transactions", {**ORDER, "extra": "X"})
    assert (status, names) == ("WARNING", {"unexpected_columns"})


def test_missing_required_column(spark):
    status, names, full = report(spark, "product_catalog", {"product_id": "P1", "product_name": "x", "active_flag": "true"})
    assert status == "FAIL" and full.violations[0].check_name == "required_columns_present"
    assert "null_threshold_category" in names


def test_type_change(spark):
    status, names, _ = report(spark, "product_catalog", {
        "product_id": "P1", "product_name": "w", "category": "h", "active_flag": "not-a-boolean"})
    assert status == "FAIL" and "type_validation_active_flag" in names


def test_null_explosion_quarantines(spark):
    row = {"event_id": "E1", "customer_id": "", "event_ts": "2026-05-10T00:00:00Z", "event_type": "view"}
    status, names, _ = report(spark, "customer_behavior", row, {**row, "event_id": "E2"})
    assert status == "QUARANTINE" and "null_threshold_customer_id" in names


def test_duplicate_keys_quarantine(spark):
    status, names, full = report(spark, "ecommerce_transactions", ORDER, {**ORDER, "customer_id": "C2"})
    assert status == "QUARANTINE" and "primary_key_unique" in names
    assert full.violations[0].message == "Duplicate primary key values detected for transaction_id: T1"


def test_stale_file(spark):
    row = {"campaign_id": "C", "campaign_date": "2026-05-10", "channel": "x", "spend": "100.00"}
    status, names, _ = report(spark, "marketing_campaigns", row,
                              observed_at="2026-05-08T12:00:00Z", validation_time="2026-05-10T12:00:00Z")
    assert (status, names) == ("FAIL", {"freshness_sla"})


def test_missing_key_column_quarantines(spark):
    row = {k: v for k, v in ORDER.items() if k != "customer_id"}
    assert report(spark, "ecommerce_transactions", row)[0] == "QUARANTINE"


def test_one_report_per_file(spark):
    df = frame(spark, {**ORDER, "_source_file": "a"}, {**ORDER, "_source_file": "b"}, {**ORDER, "_source_file": "b"})
    rows = contract.contract_reports(df, SOURCES["ecommerce_transactions"], ["_source_file"]).collect()
    assert {r._source_file: r.status for r in rows} == {"a": "PASS", "b": "QUARANTINE"}


def history(spark, source, *files):
    parts = []
    for name, rows in files:
        fields = drift.infer_schema(frame(spark, *rows)).withColumn("file_name", F.lit(name))
        parts.append(fields.withColumn("source_system", F.lit(source)))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return {r.file_name: r for r in drift.schema_history(
        drift.snapshots(stacked, ["source_system", "file_name"]), ["file_name"]).collect()}


def test_safe_rename_is_compatible(spark):
    rows = history(
        spark, "ecommerce_transactions",
        ("1", [{"transaction_id": "T1", "customer_id": "C1", "order_ts": "2026-05-10T00:00:00Z", "amount": "10.00"}]),
        ("2", [{"order_id": "T2", "customer_id": "C2", "order_timestamp": "2026-05-11T00:00:00Z", "order_value": "11.00", "coupon_code": "VIP"}]))
    second = rows["2"]
    assert second.status == "compatible_evolution" and not second.breaking
    assert {p.new: p.canonical for p in second.safe_renames}["order_value"] == "amount"
    assert second.added_columns == ["coupon_code"] and second.current_version == 2


def test_type_change_is_breaking(spark):
    rows = history(spark, "targets_planning",
                   ("1", [{"target_date": "2026-05-10", "revenue_target": "100"}]),
                   ("2", [{"target_date": "2026-05-11", "revenue_target": "not-a-number"}]),
                   ("3", [{"target_date": "2026-05-12", "revenue_target": "no"}]))
    assert rows["2"].breaking and rows["2"].type_changes[0].column_name == "revenue_target"
    assert (rows["3"].status, rows["3"].current_version, rows["3"].previous_version) == ("unchanged", 2, 2)


def test_quality_suite_reports_faults(spark):
    df = frame(spark, ORDER, {**ORDER, "customer_id": "", "status": "unknown"})
    rows = {r.check_name: r for r in checks.validate(
        df, "silver_ecommerce_transactions", QUALITY_SUITES["silver_ecommerce_transactions"]).collect()}
    failed = {name for name, r in rows.items() if r.status == "failed"}
    assert failed == {"unique_transaction_id", "null_rate_customer_id", "accepted_values_status"}
    assert rows["accepted_values_status"].observed_value == '["unknown"]'
    assert rows["null_rate_customer_id"].observed == 0.5


def test_non_numbers_are_not_non_negative(spark):
    df = frame(spark, {**ORDER, "amount": "abc"}, {**ORDER, "amount": "-1", "transaction_id": "T2"})
    rows = {r.check_name: r for r in checks.validate(
        df, "silver_ecommerce_transactions", QUALITY_SUITES["silver_ecommerce_transactions"]).collect()}
    assert rows["non_negative_amount"].failed_records == 2


def test_missing_column_fails_schema_check(spark):
    df = frame(spark, {k: v for k, v in ORDER.items() if k != "status"})
    rows = {r.check_name: r for r in checks.validate(
        df, "silver_ecommerce_transactions", QUALITY_SUITES["silver_ecommerce_transactions"]).collect()}
    assert rows["schema_required_columns"].observed_value == '["status"]'
    assert rows["accepted_values_status"].failed_records == 1


def test_expectation_mostly(spark):
    df = frame(spark, {"c": "x"}, {"c": "y"}, {"c": "z"}, {"c": None})
    loose, strict = checks.expect(df, "t", [("not_null", "c", {"mostly": 0.75}), ("not_null", "c", {"mostly": 0.8})]).collect()
    assert loose.success and not strict.success and loose.unexpected_count == 1


def test_profile_counts(spark):
    df = frame(spark, {"a": "1", "b": ""}, {"a": "1", "b": ""}, {"a": "2", "b": None})
    rows = {r.column_name: r for r in profile.profile_columns(df).collect()}
    assert (rows["a"].null_count, rows["a"].distinct_count) == (0, 2)
    assert (rows["b"].null_count, rows["b"].null_rate, rows["b"].distinct_count) == (3, 1.0, 0)
    table = profile.profile_table(df).first()
    assert (table.row_count, table.column_count, table.duplicate_rows) == (3, 2, 1)
    sketch = {r.column_name: r.distinct_count for r in profile.profile_columns(df, approximate=True).collect()}
    assert sketch == {"a": 2, "b": 0}


def test_fingerprint_ignores_order_not_content(spark):
    one = frame(spark, {"a": "1", "b": "2"}, {"a": "3", "b": None})
    two = frame(spark, {"a": "3", "b": None}, {"a": "1", "b": "2"})
    other = frame(spark, {"a": "3", "b": ""}, {"a": "1", "b": "2"})
    prints = [profile.table_fingerprint(df).first().content_sum for df in (one, two, other)]
    assert prints[0] == prints[1] != prints[2]


def test_reconciliation_tolerance(spark):
    left = spark.createDataFrame([(10.00,), (5.0,)], "v double")
    near = spark.createDataFrame([(15.01,)], "v double")
    far = spark.createDataFrame([(15.02,)], "v double")
    rows = reconcile.compare_totals([("a", left, F.sum("v"), near, F.sum("v")), ("b", left, F.sum("v"), far, F.sum("v"))])
    assert {r.check_name: r.status for r in rows.collect()} == {"a": "passed", "b": "failed"}


@pytest.mark.parametrize("name, hit", [
    ("customer_id", True), ("product_name", False), ("name", True), ("Email", True), ("phone_number", False)])
def test_pii_names(name, hit):
    assert pii.is_pii_name(name) is hit


def test_pii_values(spark):
    df = frame(spark, {"a": " a.b@c.org ", "b": "+49 170 1234567"}, {"a": "see a@b.org now", "b": "12"})
    rows = {(r.column_name, r.value_type): r.match_count for r in pii.scan_values(df, "t").collect()}
    assert rows == {("a", "email"): 1, ("b", "phone"): 1}


def test_reconciliation_builds_silver_orders_once(spark, tmp_path):
    """The marts and the totals read one written table of orders; repeated, negative and orderless lines count nowhere."""
    orders = [(1, 5, datetime(2024, 1, 2), 30.0, "1-URGENT"), (2, 6, datetime(2024, 1, 3), 40.0, "5-LOW")]
    lines = [(1, 1, 1, 1, 2.0, 10.0, 0.0, "N"), (1, 1, 1, 1, 2.0, 99.0, 0.0, "N"), (1, 97, 1, 2, 1.0, 7.0, 0.0, "N"), (2, 2, 1, 1, 1.0, 5.0, 0.0, "R"),
             (2, 2, 1, 2, 3.0, 20.0, 0.5, "N"), (3, 1, 1, 1, 1.0, 1000.0, 0.0, "N")]
    parts = [(1, "one", "small", 3, 1.0), (2, "two", "large", 4, 2.0)]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double, o_orderpriority string"),
            ("lineitem", lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string"),
            ("part", parts, "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = QUERIES["reconciliation"].build(spark, str(tmp_path))
    assert not [f for f in found.inputFiles() if "lineitem" in f]
    assert {(r.check_name, r.left_value, r.right_value, r.status) for r in found.collect()} == {
        ("completed_revenue_silver_to_gold_revenue", 20.0, 20.0, "passed"), ("completed_order_count_silver_to_gold_revenue", 2.0, 2.0, "passed"),
        ("completed_revenue_silver_to_gold_product", 20.0, 20.0, "passed"), ("gold_revenue_to_target_actual", 20.0, 20.0, "passed")}
