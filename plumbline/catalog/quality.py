"""Registered queries: quality, contracts, profiles, drift, reconciliation, personal data."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from plumbline.catalog.registry import query
from plumbline.catalog.sources import (
    customers, doubles, marked, orders, revenue, silver, staged,
)
from plumbline.catalog.views import table, view
from plumbline.config import CATALOG, EXPECTATIONS, FRESHNESS_HOURS, MODEL_TESTS, QUALITY_SUITES, SOURCES
from plumbline.functions import casts
from plumbline.operators import checks, contract, drift, evidence, pii, profile, reconcile
from plumbline.plans import marts
from plumbline.session import cut_lineage, saved

CHECK = "dataset_name, row_count, check_name, status, severity, observed, failed_records"

ORDER_CHECKS = """
    select 'silver_ecommerce_transactions' as dataset_name, n as row_count, c.check_name,
      case when c.observed > c.limit_value then 'failed' else 'passed' end as status, c.severity,
      c.observed::double as observed, cast(c.failed as bigint) as failed_records
    from (select n, unnest([
        {'check_name': 'schema_required_columns', 'severity': 'critical', 'observed': 0::double, 'limit_value': 0::double, 'failed': 0},
        {'check_name': 'unique_transaction_id', 'severity': 'critical', 'observed': dup::double, 'limit_value': 0::double, 'failed': dup},
        {'check_name': 'null_rate_transaction_id', 'severity': 'high', 'observed': round(nt / n, 4), 'limit_value': 0::double, 'failed': nt},
        {'check_name': 'null_rate_customer_id', 'severity': 'high', 'observed': round(nc / n, 4), 'limit_value': 0.01::double, 'failed': nc},
        {'check_name': 'null_rate_amount', 'severity': 'high', 'observed': round(na / n, 4), 'limit_value': 0.02::double, 'failed': na},
        {'check_name': 'accepted_values_status', 'severity': 'medium', 'observed': bad::double, 'limit_value': 0::double, 'failed': bad},
        {'check_name': 'non_negative_amount', 'severity': 'high', 'observed': neg::double, 'limit_value': 0::double, 'failed': neg}]) as c
      from (select count(*) as n, count(transaction_id) - count(distinct transaction_id) as dup,
              count(*) filter (where transaction_id is null) as nt, count(*) filter (where customer_id is null) as nc,
              count(*) filter (where amount is null) as na,
              count(*) filter (where status is null or status not in ('completed', 'refunded', 'failed', 'pending')) as bad,
              count(*) filter (where amount < 0) as neg from {table}))"""


def _checks(df):
    return df.select(*[c.strip() for c in CHECK.split(",")])


@query("Q-12 AGG-11 FLT-2 FLT-4 AGG-8", ORDER_CHECKS.replace("{table}", "silver_orders"))
def quality_suite_orders(spark, sf):
    name = "silver_ecommerce_transactions"
    return _checks(checks.validate(orders(spark, sf), name, QUALITY_SUITES[name]))


@query("Q-12 AGG-11", ORDER_CHECKS.replace("{table}", "typed_orders"))
def quality_suite_before_dedupe(spark, sf):
    """The same suite on typed rows before any are rejected: every fault is still there."""
    name = "silver_ecommerce_transactions"
    rows = marked(spark, sf, "ecommerce_transactions").drop("_reject_reason")
    return _checks(checks.validate(rows, name, QUALITY_SUITES[name]))


@query("AGG-8 Q-12", """
    select dataset_name, '2024-02-01T00:00:00Z' as validated_at, row_count, check_count, failed_check_count,
      case when failed_check_count > 0 then 'failed' else 'passed' end as quality_status from (
      select 'silver_ecommerce_transactions' as dataset_name, count(*) as row_count, 7 as check_count,
        (case when count(*) filter (where customer_id is null) > 0.01 * count(*) then 1 else 0 end)
        + (case when count(*) filter (where status not in ('completed', 'refunded', 'failed', 'pending')) > 0 then 1 else 0 end) as failed_check_count
      from silver_orders
      union all select 'silver_customer_behavior', count(*), 4, case when count(*) filter (where customer_id is null) > 0.05 * count(*) then 1 else 0 end from silver_behavior
      union all select 'silver_crm_support', count(*), 3, case when count(*) filter (where priority not in ('low', 'medium', 'high', 'urgent')) > 0 then 1 else 0 end from silver_support
      union all select 'silver_operational_logs', count(*), 3, case when count(*) filter (where status not in ('ok', 'warning', 'failed')) > 0 then 1 else 0 end from silver_logs
      union all select 'silver_product_catalog', count(*), 4, case when count(*) filter (where category is null) > 0.02 * count(*) then 1 else 0 end from silver_products
      union all select 'silver_marketing_campaigns', count(*), 5, 0 from silver_campaigns
      union all select 'silver_targets_planning', count(*), 4, 0 from silver_targets)""")
def gold_data_quality_summary(spark, sf):
    tables = {f"silver_{source}": silver(spark, sf, source) for source in SOURCES}
    summary = marts.gold_data_quality_summary(checks.validate_all(tables, QUALITY_SUITES), "2024-02-01T00:00:00Z")
    return summary.withColumns({c: F.col(c).cast("bigint") for c in ("check_count", "failed_check_count")})


@query("AGG-12 FLT-4 Q-9", """select 'accepted_values_status' as check_name, status as value, count(*) as n from silver_orders
    where status not in ('completed', 'refunded', 'failed', 'pending') group by 2""")
def quality_bad_values(spark, sf):
    return checks.bad_values(orders(spark, sf), QUALITY_SUITES["silver_ecommerce_transactions"])


@query("AGG-11 Q-6", """select transaction_id as key, count(*) as occurrences from typed_orders where transaction_id is not null
    group by 1 having count(*) > 1""")
def repeated_order_keys(spark, sf):
    return checks.repeated_keys(marked(spark, sf, "ecommerce_transactions"), "transaction_id")


@query("Q-13", """
    select 'silver_ecommerce_transactions' as dataset_name, e.check_name, e.evaluated as evaluated_count, e.unexpected as unexpected_count,
      e.mostly, case when e.evaluated = 0 then true else 1 - e.unexpected / e.evaluated >= e.mostly end as success
    from (select unnest([
        {'check_name': 'not_null_transaction_id', 'evaluated': n, 'unexpected': n - nt, 'mostly': 1.0::double},
        {'check_name': 'unique_transaction_id', 'evaluated': nt, 'unexpected': nt - dt, 'mostly': 1.0::double},
        {'check_name': 'not_null_customer_id', 'evaluated': n, 'unexpected': n - nc, 'mostly': 0.99::double},
        {'check_name': 'between_amount', 'evaluated': na, 'unexpected': neg, 'mostly': 1.0::double},
        {'check_name': 'in_set_status', 'evaluated': ns, 'unexpected': bad, 'mostly': 1.0::double}]) as e
      from (select count(*) as n, count(transaction_id) as nt, count(distinct transaction_id) as dt, count(customer_id) as nc,
          count(amount) as na, count(*) filter (where amount < 0) as neg, count(status) as ns,
          count(*) filter (where status not in ('completed', 'refunded', 'failed', 'pending')) as bad from silver_orders))""")
def expectations_orders(spark, sf):
    name = "silver_ecommerce_transactions"
    return checks.expect(orders(spark, sf), name, EXPECTATIONS[name])


@query("Q-14", """
    select 'stg_ecommerce_transactions' as dataset_name, e.check_name, e.failures as unexpected_count, e.failures = 0 as success
    from (select unnest([
        {'check_name': 'not_null_transaction_id', 'failures': count(*) - count(transaction_id)},
        {'check_name': 'unique_transaction_id', 'failures': count(transaction_id) - count(distinct transaction_id)},
        {'check_name': 'not_null_customer_id', 'failures': count(*) - count(customer_id)},
        {'check_name': 'not_null_amount', 'failures': count(*) - count(amount)},
        {'check_name': 'in_set_status', 'failures': count(*) filter (where status not in ('completed', 'refunded', 'failed', 'pending'))}]) as e
      from stg_orders)
    union all
    select 'gold_customer_analytics', e.check_name, e.failures, e.failures = 0 from (select unnest([
        {'check_name': 'not_null_customer_id', 'failures': count(*) - count(customer_id)},
        {'check_name': 'unique_customer_id', 'failures': count(customer_id) - count(distinct customer_id)}]) as e from gold_customers)
    union all
    select 'gold_revenue_analytics', e.check_name, e.failures, e.failures = 0 from (select unnest([
        {'check_name': 'not_null_order_date', 'failures': count(*) - count(order_date)},
        {'check_name': 'unique_order_date', 'failures': count(order_date) - count(distinct order_date)},
        {'check_name': 'not_null_gross_revenue', 'failures': count(*) - count(gross_revenue)}]) as e from gold_revenue)""")
def model_tests(spark, sf):
    tables = {
        "stg_ecommerce_transactions": staged(spark, sf, "ecommerce_transactions"),
        "gold_customer_analytics": customers(spark, sf), "gold_revenue_analytics": revenue(spark, sf)}
    parts = [checks.expect(df, name, MODEL_TESTS[name]) for name, df in tables.items()]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stacked.select("dataset_name", "check_name", "unexpected_count", "success")


@query("Q-15", """
    select l.source_system, newest as max_loaded_at, w as warn_hours, e as error_hours,
      (epoch(timestamp '2024-02-01 00:00:00') - epoch(date_trunc('second', newest))) / 3600.0 as age_hours,
      case when newest is null or (epoch(timestamp '2024-02-01 00:00:00') - epoch(date_trunc('second', newest))) / 3600.0 > e then 'error'
        when (epoch(timestamp '2024-02-01 00:00:00') - epoch(date_trunc('second', newest))) / 3600.0 > w then 'warn' else 'pass' end as status
    from (values ('ecommerce_transactions', 24, 48), ('marketing_campaigns', 24, 48), ('customer_behavior', 6, 12),
      ('product_catalog', 48, 72), ('operational_logs', 1, 2), ('targets_planning', 168, 336), ('crm_support', 24, 48)) l(source_system, w, e)
    left join (select source_system, max(load_time) as newest from load_log group by 1) t on t.source_system = l.source_system""")
def source_freshness_hours(spark, sf):
    latest = view(spark, sf, "load_log").select("source_system", F.col("load_time").alias("loaded_at"))
    return checks.source_freshness(latest, FRESHNESS_HOURS, "2024-02-01 00:00:00")


# -- contracts ------------------------------------------------------------------------------

CONTRACT_FACTS = """
    select count(*) as n, count(*) filter (where tid is null) as blank_keys,
      count(*) filter (where user_id = '') as blank_customers,
      count(*) filter (where lower(priority) not in ('low', 'medium', 'high', 'urgent')) as bad_priority
    from (select *, nullif(trim(ticket_id), '') as tid from raw_support)"""


@query("Q-4 Q-5 Q-6 Q-7 Q-8 Q-9 Q-10 Q-11 Q-20 PRJ-3", f"""
    select 'crm_support' as source_system, n as row_count, violations as violation_count,
      case when blank_customers / n > 0.05 then 'FAIL' when bad_priority > 0 then 'FAIL' when violations > 0 then 'FAIL' else 'PASS' end as status
    from (select *, (case when round(blank_customers / n, 4) > 0.05 then 1 else 0 end) + (case when bad_priority > 0 then 1 else 0 end)
       + 1 as violations from ({CONTRACT_FACTS}))""")
def contract_report_support(spark, sf):
    """Tickets against their contract, observed two days late."""
    rows = view(spark, sf, "raw_support").drop("_pos")
    report = contract.contract_reports(
        rows, SOURCES["crm_support"], observed_at="2024-01-30T00:00:00Z", validation_time="2024-02-01T00:00:00Z")
    return report.select("source_system", "row_count", "violation_count", "status")


@query("Q-6 Q-7 Q-9 AGG-12 Q-11", """
    with facts as (select service_name, count(*) as n, count(*) filter (where status = '') as blank_status from raw_logs group by 1)
    select service_name, case when blank_status > 0 then 'QUARANTINE' else 'PASS' end as status,
      'null_threshold_status' as check_name, 'critical' as severity, round(blank_status / n, 4) as observed
    from facts where round(blank_status / n, 4) > 0""")
def contract_violations_by_group(spark, sf):
    """Log contract per service: one report per group from one job."""
    rows = view(spark, sf, "raw_logs").drop("_pos").withColumn("_group", F.col("service_name"))
    reports = contract.contract_reports(rows, SOURCES["operational_logs"], by=["_group"])
    return contract.violations(reports, ["_group"]).select(
        F.col("_group").alias("service_name"), "status", "check_name", "severity",
        F.col("observed_value").cast("double").alias("observed"))


@query("Q-6 Q-9 AGG-12", """
    select 'primary_key_unique' as check_name, event_id as value, count(*) as n from raw_behavior where trim(event_id) <> '' group by 2 having count(*) > 1
    union all select 'accepted_values_product_id', product_id, count(*) from raw_behavior
      where trim(product_id) <> '' and lower(product_id) not in ('p1', 'p2') group by 2""")
def contract_bad_values(spark, sf):
    """Every repeated key and every product outside a set of two, with its rows."""
    spec = dataclasses.replace(SOURCES["customer_behavior"], accepted_values={"product_id": ("P1", "P2")})
    return contract.offending_values(view(spark, sf, "raw_behavior").drop("_pos"), spec)


@query("Q-6 Q-9 AGG-12", """
    with bad as (select 'primary_key_unique' as check_name, event_id as value from raw_behavior where trim(event_id) <> '' group by 2 having count(*) > 1
      union all select distinct 'accepted_values_product_id', product_id from raw_behavior where trim(product_id) <> '' and lower(product_id) not in ('p1', 'p2'))
    select check_name, cast((n - 1) // 100 + 1 as int) as page, count(*) as value_count, min(value) as first_value, max(value) as last_value,
      string_agg(value, ',' order by value) as listed from (select *, row_number() over (partition by check_name order by value) as n from bad) group by 1, 2""")
def contract_evidence_pages(spark, sf):
    """The same values as numbered pages of a hundred."""
    return evidence.pages(contract_bad_values(spark, sf), ["check_name"], "value", 100).withColumn(
        "listed", F.array_join("value_list", ",")).drop("value_list")


# -- types, drift ---------------------------------------------------------------------------

@query("Q-1 SRC-5", "select source_system, day, column_name, data_type, nullable from schema_fields")
def inferred_types(spark, sf):
    return _typed_fields(spark, sf)


def _typed_fields(spark, sf):
    rows = view(spark, sf, "typed_text").withColumnsRenamed({"source_system": "_source", "day": "_day"})
    return drift.infer_schema(rows, ["_source", "_day"]).withColumnsRenamed(
        {"_source": "source_system", "_day": "day"})


@query("Q-2", "select * from schema_prints")
def schema_fingerprints(spark, sf):
    return drift.snapshots(_typed_fields(spark, sf), ["source_system", "day"]).drop("fields")


@query("Q-3 WIN-4", """
    with marked as (select *, lag(fingerprint) over w as prev, row_number() over w as n from schema_prints
        window w as (partition by source_system order by day)),
      changes as (select f.source_system, f.day, count(*) filter (where f.data_type <> p.data_type) as type_changes
        from (select *, dense_rank() over (partition by source_system order by day) as n from schema_fields) f
        left join (select *, dense_rank() over (partition by source_system order by day) as n from schema_fields) p
          on p.source_system = f.source_system and p.column_name = f.column_name and p.n = f.n - 1 group by 1, 2)
    select m.source_system, m.day,
      cast(sum(case when fingerprint is not distinct from prev then 0 else 1 end) over (partition by m.source_system order by m.day) as bigint) as current_version,
      case when n > 1 then cast(sum(case when fingerprint is not distinct from prev then 0 else 1 end) over (partition by m.source_system order by m.day)
        - (case when fingerprint is not distinct from prev then 0 else 1 end) as bigint) end as previous_version,
      case when n = 1 then 'new_schema' when c.type_changes > 0 then 'breaking_drift' else 'unchanged' end as status,
      n > 1 and c.type_changes > 0 as breaking, c.type_changes as type_change_count
    from marked m join changes c using (source_system, day)""")
def schema_history(spark, sf):
    snaps = drift.snapshots(_typed_fields(spark, sf), ["source_system", "day"])
    return drift.schema_history(snaps, ["day"]).select(
        "source_system", "day", "current_version", "previous_version", "status", "breaking",
        F.size("type_changes").cast("bigint").alias("type_change_count"))


@query("Q-2 WIN-3", """select source_system, day, fingerprint from (select *, row_number() over (partition by source_system order by day desc) as r
    from schema_prints) where r = 1""")
def latest_schema(spark, sf):
    snaps = drift.snapshots(_typed_fields(spark, sf), ["source_system", "day"])
    newest = drift.latest_schema(snaps.withColumn("current_version", F.lit(1)), "day")
    return newest.select("source_system", "day", "fingerprint")


# -- profiles, fingerprints -----------------------------------------------------------------

@query("AGG-9", """
    select column_name, count(*) as row_count, count(*) filter (where value = '') as null_count,
      count(*) filter (where value = '') / count(*) as null_rate, count(distinct nullif(value, '')) as distinct_count
    from (unpivot (select coalesce(ticket_id, '') as ticket_id, coalesce(user_id, '') as user_id, coalesce(created_ts, '') as created_ts,
        coalesce(priority, '') as priority, coalesce(status, '') as status, coalesce(topic, '') as topic from raw_support)
        on ticket_id, user_id, created_ts, priority, status, topic into name column_name value value) group by 1""")
def column_profile(spark, sf):
    return profile.profile_columns(view(spark, sf, "raw_support"))


@query("AGG-10")
def column_profile_approximate(spark, sf):
    """Sketch-based profile of every column of the order lines."""
    return profile.profile_columns(view(spark, sf, "raw_orders"), approximate=True)


@query("AGG-9", """select cast(sum(n) as bigint) as row_count, 11 as column_count, cast(sum(n - 1) as bigint) as duplicate_rows,
      cast(sum(n - 1) as bigint) / cast(sum(n) as bigint) as duplicate_rate
    from (select *, count(*) as n from (select * from lineitem union all select * from lineitem where l_partkey % 7 = 0) group by all)""")
def table_profile(spark, sf):
    """Whole order lines, of which those of every seventh part arrive twice."""
    rows = table(spark, sf, "lineitem")
    return profile.profile_table(rows.unionByName(rows.where("l_partkey % 7 = 0")))


@query("Q-17", """
    select 'orders' as table_name, count(*) as row_count, cast(sum(('0x' || substr(sha256(
        length(cast(o_orderkey as varchar)) || ':' || o_orderkey || '|' || length(cast(o_custkey as varchar)) || ':' || o_custkey || '|'
        || length(o_orderpriority) || ':' || o_orderpriority), 1, 15))::bigint) as varchar) as content_sum from orders
    union all select 'documents', count(*), cast(sum(('0x' || substr(sha256(length(cast(doc_id as varchar)) || ':' || doc_id || '|'
        || length(text) || ':' || text), 1, 15))::bigint) as varchar) from documents""")
def table_fingerprints(spark, sf):
    """Content fingerprints over whole rows, whole texts included."""
    parts = []
    for name, columns in (("orders", ["o_orderkey", "o_custkey", "o_orderpriority"]), ("documents", ["doc_id", "text"])):
        parts.append(profile.table_fingerprint(table(spark, sf, name), columns).select(
            F.lit(name).alias("table_name"), "row_count", "content_sum"))
    return parts[0].unionByName(parts[1])


# -- reconciliation -------------------------------------------------------------------------

@query("Q-16", """
    select check_name, l as left_value, r as right_value, round(l - r, 4) as difference, 0.01::double as tolerance,
      case when abs(round(l - r, 4)) <= 0.01 then 'passed' else 'failed' end as status from (
      select 'completed_revenue_silver_to_gold_revenue' as check_name,
        (select cast(sum(amount) as double) from silver_orders where status = 'completed') as l,
        (select cast(sum(cast(gross_revenue as decimal(18,4))) as double) from gold_revenue) as r
      union all select 'completed_order_count_silver_to_gold_revenue',
        (select cast(count(*) as double) from silver_orders where status = 'completed'), (select cast(sum(completed_orders) as double) from gold_revenue)
      union all select 'completed_revenue_silver_to_gold_product',
        (select cast(sum(amount) as double) from silver_orders where status = 'completed'),
        (select cast(sum(cast(gross_revenue as decimal(18,4))) as double) from gold_products)
      union all select 'gold_revenue_to_target_actual',
        (select cast(sum(cast(gross_revenue as decimal(18,4))) as double) from gold_revenue),
        (select cast(sum(cast(gross_revenue as decimal(18,4))) as double) from gold_revenue))""")
def reconciliation(spark, sf):
    # the marts and the totals read the same orders: built once, with the columns that they use
    rows = saved(orders(spark, sf).select("order_ts", "product_id", "status", "quantity", "amount"), "reconciled-orders")
    # the daily mart feeds two totals and the target mart: written out once, it is small
    daily = cut_lineage(marts.gold_revenue_analytics(rows, silver(spark, sf, "targets_planning")))
    products = marts.gold_product_performance(silver(spark, sf, "product_catalog"), rows)
    return reconcile.reconcile_gold(rows, daily, products, marts.gold_target_vs_actual(daily))


# -- personal data --------------------------------------------------------------------------

@query("GOV-1", """
    select * from (
      select 'documents' as dataset_name, 'text' as column_name, 'email' as value_type,
        count(*) filter (where regexp_matches(trim(text), '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}')) as match_count from documents
      union all select 'conversations', 'text', 'email',
        count(*) filter (where regexp_matches(trim(text), '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}')) from conversations) where match_count > 0""")
def pii_texts(spark, sf):
    """E-mail addresses anywhere in the texts, over all rows and whole texts."""
    patterns = {"email": r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"}
    parts = [pii.scan_values(table(spark, sf, n).select("text"), n, patterns) for n in ("documents", "conversations")]
    return parts[0].unionByName(parts[1])


@query("GOV-1", """
    select 'silver_customer_behavior' as dataset_name, 'confidential' as classification, 'customer_id;session_id' as detected_pii_columns,
      '' as unexpected_pii_columns, 'passed' as status
    union all select 'silver_crm_support', 'restricted', 'customer_id;ticket_id', '', 'passed'
    union all select 'customer_extract', 'unclassified', 'customer_id;name', 'customer_id;name', 'failed'""")
def pii_scan_tables(spark, sf):
    extract = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("name"))
    report = pii.scan_tables({
        "silver_customer_behavior": silver(spark, sf, "customer_behavior"),
        "silver_crm_support": silver(spark, sf, "crm_support"), "customer_extract": extract})
    return report.select("dataset_name", "classification", "detected_pii_columns", "unexpected_pii_columns", "status")


@query("PRJ-23", """
    select c_mktsegment as dataset_name, case c_mktsegment when 'BUILDING' then 'restricted' when 'MACHINERY' then 'confidential' else 'internal' end as classification,
      case c_mktsegment when 'BUILDING' then 'row/column access policy, approval workflow, audit logging'
        when 'MACHINERY' then 'role-based access, encryption, usage monitoring' else 'standard internal access' end as recommended_control
    from customer group by 1""")
def access_policies(spark, sf):
    segment = F.col("dataset_name")
    rows = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("dataset_name")).distinct()
    return pii.access_policy(rows.withColumn(
        "classification", F.when(segment == "BUILDING", "restricted").when(segment == "MACHINERY", "confidential")
        .otherwise("internal")))
