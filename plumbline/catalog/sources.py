"""Registered queries: staging, silver, splits, facts and marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.catalog.registry import query
from plumbline.catalog.views import SOURCE_VIEWS, table, view
from plumbline.config import SOURCES
from plumbline.functions import casts
from plumbline.operators import incremental
from plumbline.operators.dedupe import REASON, accepted, first_reason, rejected
from plumbline.operators.standardize import standardize
from plumbline.plans import marts
from plumbline.plans.staging import STAGING
from plumbline.session import ensure_checkpoint_dir
from plumbline.sinks import lake
from plumbline.sources import landing
from plumbline.sources.bronze import enrich


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def marked(spark, sf, source) -> DataFrame:
    return standardize(view(spark, sf, SOURCE_VIEWS[source]), source, ["_pos"])


def silver(spark, sf, source) -> DataFrame:
    return accepted(marked(spark, sf, source)).drop("_pos")


def staged(spark, sf, source) -> DataFrame:
    return STAGING[source](view(spark, sf, SOURCE_VIEWS[source])).drop(
        "_ingest_batch_id", "_source_file", "_ingested_at")


def orders(spark, sf):
    return silver(spark, sf, "ecommerce_transactions")


def revenue(spark, sf):
    return marts.gold_revenue_analytics(orders(spark, sf), silver(spark, sf, "targets_planning"))


def customers(spark, sf):
    return marts.gold_customer_analytics(
        orders(spark, sf), silver(spark, sf, "customer_behavior"), silver(spark, sf, "crm_support"))


# -- staging --------------------------------------------------------------------------------

@query("PRJ-4 PRJ-7 PRJ-16 FLT-1", "select * replace (cast(amount as double) as amount) from stg_orders")
def stg_ecommerce_transactions(spark, sf):
    return doubles(staged(spark, sf, "ecommerce_transactions"), "amount")


@query("PRJ-4 PRJ-16 PRJ-24", """select campaign_id, campaign_date, channel, cast(spend as double) as spend, impressions, clicks
    from typed_campaigns""")
def stg_marketing_campaigns(spark, sf):
    return doubles(staged(spark, sf, "marketing_campaigns"), "spend")


@query("PRJ-4 PRJ-16", "select event_id, customer_id, event_ts, event_type, product_id, session_id from typed_behavior")
def stg_customer_behavior(spark, sf):
    return staged(spark, sf, "customer_behavior")


@query("PRJ-7 PRJ-16", """select product_id, product_name, nullif(category, '') as category,
    active_flag in ('true', 'Yes') as active_flag,
    cast(cast(replace(list_price, '$', '') as decimal(18,4)) as double) as list_price from raw_products""")
def stg_product_catalog(spark, sf):
    return doubles(staged(spark, sf, "product_catalog"), "list_price")


@query("PRJ-16", """select log_id, service_name, event_ts, nullif(status, '') as status,
    case when runtime_text = '' then null else cast(runtime_text as bigint) end as runtime_seconds
    from (select l.log_id, l.service_name, t.event_ts, t.status, l.runtime_seconds as runtime_text
          from raw_logs l join typed_logs t using (log_id))""")
def stg_operational_logs(spark, sf):
    return staged(spark, sf, "operational_logs")


@query("PRJ-16", "select target_date, cast(revenue_target as double) as revenue_target, orders_target from typed_targets")
def stg_targets_planning(spark, sf):
    return doubles(staged(spark, sf, "targets_planning"), "revenue_target")


@query("PRJ-4 PRJ-16", "select ticket_id, customer_id, created_ts, priority, status, topic from typed_support")
def stg_crm_support(spark, sf):
    return staged(spark, sf, "crm_support")


# -- silver ---------------------------------------------------------------------------------

@query("PRJ-1 PRJ-2 PRJ-6 PRJ-9 FLT-3 WIN-1 SPLIT-1 UDF-2",
       "select * exclude (_pos) replace (cast(amount as double) as amount) from silver_orders")
def silver_ecommerce_transactions(spark, sf):
    return doubles(orders(spark, sf), "amount")


@query("PRJ-10 WIN-1", "select * exclude (_pos) replace (cast(spend as double) as spend) from silver_campaigns")
def silver_marketing_campaigns(spark, sf):
    return doubles(silver(spark, sf, "marketing_campaigns"), "spend")


@query("PRJ-11 WIN-1", "select * exclude (_pos) from silver_behavior")
def silver_customer_behavior(spark, sf):
    return silver(spark, sf, "customer_behavior")


@query("PRJ-12 WIN-1", "select * exclude (_pos) replace (cast(list_price as double) as list_price) from silver_products")
def silver_product_catalog(spark, sf):
    return doubles(silver(spark, sf, "product_catalog"), "list_price")


@query("PRJ-13 WIN-1", "select * exclude (_pos) from silver_logs")
def silver_operational_logs(spark, sf):
    return silver(spark, sf, "operational_logs")


@query("PRJ-14 WIN-1", "select * exclude (_pos) replace (cast(revenue_target as double) as revenue_target) from silver_targets")
def silver_targets_planning(spark, sf):
    return doubles(silver(spark, sf, "targets_planning"), "revenue_target")


@query("PRJ-15 WIN-1", "select * exclude (_pos) from silver_support")
def silver_crm_support(spark, sf):
    return silver(spark, sf, "crm_support")


@query("SPLIT-1 FLT-3 WIN-1", """select transaction_id, customer_id, status, cast(amount as double) as amount, _reject_reason
    from marked_orders where _reject_reason is not null""")
def rejected_orders(spark, sf):
    return doubles(rejected(marked(spark, sf, "ecommerce_transactions")), "amount").select(
        "transaction_id", "customer_id", "status", "amount", REASON)


@query("SPLIT-1 SNK-6 AGG-23", """
    select 'ecommerce_transactions' as source_system, coalesce(_reject_reason, 'accepted') as outcome, count(*) as row_count
    from marked_orders group by 2
    union all select 'customer_behavior', coalesce(_reject_reason, 'accepted'), count(*) from marked_behavior group by 2
    union all select 'crm_support', coalesce(_reject_reason, 'accepted'), count(*) from marked_support group by 2
    union all select 'operational_logs', coalesce(_reject_reason, 'accepted'), count(*) from marked_logs group by 2""")
def silver_outcome_counts(spark, sf):
    frames = [
        marked(spark, sf, source).select(F.lit(source).alias("source_system"), REASON)
        for source in ("ecommerce_transactions", "customer_behavior", "crm_support", "operational_logs")
    ]
    stacked = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    return stacked.groupBy("source_system", F.coalesce(REASON, F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count"))


@query("FLT-10 SPLIT-1 SRC-10 AGG-13", """
    select coalesce(case when coalesce(trim(ticket_id), '') = '' then 'missing required field ticket_id'
        when coalesce(trim(user_id), '') = '' then 'missing required field customer_id'
        when lower(priority) not in ('low', 'medium', 'high', 'urgent') then 'invalid priority' end, 'accepted') as outcome,
      page, count(*) as tickets
    from (select *, 'page-' || substr(created_ts, 1, 10) as page from raw_support) group by 1, 2""")
def api_page_outcomes(spark, sf):
    """Tickets as API pages, unpacked and routed by the first rule they fail."""
    tickets = view(spark, sf, "raw_support").select(
        F.concat(F.lit("page-"), F.substring("created_ts", 1, 10)).alias("request_id"),
        F.array(F.struct("ticket_id", F.col("user_id").alias("customer_id"), "created_ts", "priority",
                         "status", "topic")).alias("tickets"))
    rows = landing.ticket_rows(tickets, "batch-1", "2024-02-01T00:00:00Z")
    return rows.groupBy(
        F.coalesce(REASON, F.lit("accepted")).alias("outcome"), F.col("_api_request_id").alias("page"),
    ).agg(F.count(F.lit(1)).alias("tickets"))


@query("PRJ-5 SRC-6 SNK-6", """select 'support' as _source_system, count(*) as row_count, count(ticket_id) as tickets,
    count(nullif(user_id, '')) as with_user, cast(0 as bigint) as with_file from raw_support""")
def bronze_raw_table(spark, sf):
    """Enriched rows through the raw-table whitelist: missing columns arrive as NULL."""
    rows = enrich(view(spark, sf, "raw_support"), "support", "batch-1", "2024-02-01T00:00:00Z")
    raw = landing.raw_table(rows, SOURCES["crm_support"])
    return raw.agg(
        F.lit("support").alias("_source_system"), F.count(F.lit(1)).alias("row_count"),
        F.count("ticket_id").alias("tickets"),
        F.count(F.nullif("user_id", F.lit(""))).alias("with_user"), F.count("_source_file").alias("with_file"))


# -- column functions -----------------------------------------------------------------------

@query("PRJ-8", """select event_id, md5(concat_ws('||', coalesce(event_id, ''), coalesce(nullif(user_id, ''), ''), coalesce(event_time, '')))
    as event_key from raw_behavior""")
def surrogate_keys(spark, sf):
    rows = view(spark, sf, "raw_behavior")
    return rows.select("event_id", casts.surrogate_key(
        F.col("event_id"), F.nullif("user_id", F.lit("")), F.col("event_time")).alias("event_key"))


@query("PRJ-6 PRJ-7", """select product_id, coalesce(try_cast(list_price as double), 0.0) as as_float,
      coalesce(try_cast(list_price as double), -1.0) as as_float_or_default,
      cast(trunc(coalesce(try_cast(list_price as double), 0)) as bigint) as as_int,
      cast(cast(replace(list_price, '$', '') as decimal(18,4)) as double) as as_numeric from raw_products""")
def tolerant_casts(spark, sf):
    price = F.col("list_price")
    return view(spark, sf, "raw_products").select(
        "product_id", casts.to_float(price).alias("as_float"), casts.to_float(price, -1.0).alias("as_float_or_default"),
        casts.to_int(price).alias("as_int"), casts.safe_cast_numeric(price).cast("double").alias("as_numeric"))


@query("PRJ-6", """select substr(seen_at, 1, 10) as by_shape, count(*) as n from typed_text group by 1""")
def date_parts_by_shape(spark, sf):
    return view(spark, sf, "typed_text").groupBy(casts.date_from_ts(F.col("seen_at")).alias("by_shape")).agg(
        F.count(F.lit(1)).alias("n"))


@query("SNK-3", """select value, n from (select coalesce(nullif(replace(replace(trim(p_name), ' ', '_'), '/', '_'), ''), 'unknown') as value,
    count(*) as n from part group by 1)""")
def partition_values(spark, sf):
    return table(spark, sf, "part").groupBy(lake.partition_column(F.col("p_name")).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))


@query("FLT-2 FLT-4", """select count(*) filter (where customer_id is null or customer_id = '') as blank_customers,
      count(*) filter (where status not in ('completed', 'refunded', 'failed', 'pending')) as outside_exact,
      count(*) filter (where status <> '' and lower(status) not in ('completed', 'refunded', 'failed', 'pending')) as outside_any_case
    from raw_orders""")
def null_and_set_predicates(spark, sf):
    from plumbline.operators.checks import outside
    from plumbline.operators.contract import not_accepted

    allowed = SOURCES["ecommerce_transactions"].accepted_values["status"]
    rows = view(spark, sf, "raw_orders")
    return rows.agg(
        F.count_if(casts.is_blank(F.col("customer_id"))).alias("blank_customers"),
        F.count_if(outside("status", allowed)).alias("outside_exact"),
        F.count_if(not_accepted(F.col("status"), allowed)).alias("outside_any_case"))


# -- facts, dimensions, marts ---------------------------------------------------------------

@query("PRJ-17", """select transaction_id, customer_id, product_id, campaign_id, order_ts, cast(order_ts as date) as order_date,
      status, quantity, cast(amount as double) as amount,
      cast(case when status = 'completed' then amount else 0 end as double) as completed_revenue from silver_orders""")
def fact_orders(spark, sf):
    return doubles(marts.fact_orders(orders(spark, sf)), "amount", "completed_revenue")


@query("PRJ-18", """select campaign_id, campaign_date, channel, cast(spend as double) as spend, impressions, clicks from silver_campaigns""")
def fact_marketing_spend(spark, sf):
    return doubles(marts.fact_marketing_spend(silver(spark, sf, "marketing_campaigns")), "spend")


@query("PRJ-18 PRJ-19", """select customer_id, customer_segment, last_order_ts, order_count, support_tickets, behavior_events from gold_customers""")
def dim_customer(spark, sf):
    return marts.dim_customer(customers(spark, sf))


@query("PRJ-18", """select product_id, product_name, category, active_flag, cast(list_price as double) as list_price from silver_products""")
def dim_product(spark, sf):
    return doubles(marts.dim_product(silver(spark, sf, "product_catalog")), "list_price")


@query("AGG-1 JN-4 PRJ-20", "select * from gold_revenue")
def gold_revenue_analytics(spark, sf):
    return revenue(spark, sf)


@query("AGG-2 JN-5 PRJ-19", "select * from gold_customers")
def gold_customer_analytics(spark, sf):
    return customers(spark, sf)


@query("JN-5", """select customer_id, order_count, cast(gross as double) as gross_revenue, refund_count, last_order_ts, behavior_events,
    support_tickets from customer_activity""")
def customer_activity_full_outer(spark, sf):
    return doubles(marts.customer_activity_joined(
        orders(spark, sf), silver(spark, sf, "customer_behavior"), silver(spark, sf, "crm_support")), "gross_revenue")


@query("AGG-3 JN-1 PRJ-20", "select * from gold_marketing")
def gold_marketing_attribution(spark, sf):
    return marts.gold_marketing_attribution(orders(spark, sf), silver(spark, sf, "marketing_campaigns"))


@query("AGG-4 JN-2", "select * from gold_products")
def gold_product_performance(spark, sf):
    return marts.gold_product_performance(silver(spark, sf, "product_catalog"), orders(spark, sf))


@query("JN-3 AGG-4", """select o.product_id, coalesce(p.product_name, 'unknown') as product_name, coalesce(p.category, 'unknown') as category,
      coalesce(p.active_flag, false) as active_flag, count(*) filter (where o.status = 'completed') as order_count,
      cast(sum(case when o.status = 'completed' then o.quantity else 0 end) as bigint) as units_sold,
      cast(sum(case when o.status = 'completed' then o.amount else 0 end) as double) as gross_revenue
    from silver_orders o left join (select * from silver_products where not active_flag) p on o.product_id = p.product_id
    group by 1, 2, 3, 4""")
def products_sold_unknown_kept(spark, sf):
    """Orders against the retired part of the catalog: active products come out as unknown."""
    retired = silver(spark, sf, "product_catalog").where(~F.col("active_flag"))
    return marts.products_sold(orders(spark, sf), retired)


@query("AGG-5", """select service_name, count(*) as event_count, count(*) filter (where status = 'failed') as failure_count,
      count(*) filter (where status = 'warning') as warning_count, avg(runtime_seconds) as avg_runtime_seconds,
      max(event_ts) as last_event_ts from silver_logs group by 1""")
def gold_operational_metrics(spark, sf):
    return marts.gold_operational_metrics(silver(spark, sf, "operational_logs"))


@query("AGG-7", """select order_date as target_date, gross_revenue as actual_revenue, revenue_target, completed_orders as actual_orders,
    orders_target, revenue_attainment from gold_revenue""")
def gold_target_vs_actual(spark, sf):
    return marts.gold_target_vs_actual(revenue(spark, sf))


@query("AGG-6", """select source_system, layer, max(load_time) as last_load_time, cast(sum(row_count) as bigint) as row_count,
      max(schema_version) as schema_version,
      case when max(load_time) >= timestamp '2024-01-31 23:30:00' - interval 24 hours then 'passed' else 'failed' end as freshness_status
    from load_log group by 1, 2""")
def gold_source_freshness(spark, sf):
    return marts.gold_source_freshness(view(spark, sf, "load_log"), "2024-01-31 23:30:00")


@query("FLT-7", "select order_date, gross_revenue from gold_revenue where gross_revenue < 0")
def negative_revenue_days(spark, sf):
    return marts.negative_revenue(revenue(spark, sf)).select("order_date", "gross_revenue")


@query("AGG-1 SRC-11", """select cast(order_ts as date) as order_date, count(*) filter (where status = 'completed') as completed_orders,
      cast(sum(case when status = 'completed' then amount else 0 end) as decimal(18,2))::double as gross_revenue,
      count(*) filter (where status = 'refunded') as refund_count, count(*) filter (where status = 'failed') as failed_orders
    from silver_orders group by 1""")
def revenue_daily_job(spark, sf):
    """The stand-alone job over silver orders; its double sums are shown to the cent."""
    rows = landing.require_columns(orders(spark, sf), {"transaction_id", "order_ts", "amount", "status"})
    daily = marts.revenue_daily_job(rows.withColumn("order_ts", F.col("order_ts").cast("string")))
    return daily.withColumn("gross_revenue", F.round("gross_revenue", 2))


@query("INC-1 SNK-9 FLT-9", """select * from gold_revenue""")
def revenue_incremental(spark, sf):
    """The mart of all days before 2000, refreshed with a look-back that reaches the rest."""
    rows, targets = orders(spark, sf), silver(spark, sf, "targets_planning")
    old = marts.gold_revenue_analytics(rows.where(F.col("order_ts") < "2000-01-01"), targets)
    return incremental.refresh_revenue(old, rows, targets, lookback_days=7)


@query("INC-1 FLT-9", """select * from gold_revenue where order_date >= (select max(order_date) - 30 from gold_revenue)""")
def revenue_since_last(spark, sf):
    rows = revenue(spark, sf)
    return incremental.since_last(rows, "order_date", rows, lookback_days=30)


@query("INC-2", """select 'behavior' as source_system, substr(event_time, 1, 10) as ingest_date, event_type as batch_id, count(*) as row_count
    from raw_behavior group by 2, 3""")
def replay_candidates(spark, sf):
    bronze = view(spark, sf, "raw_behavior").select(
        F.lit("behavior").alias("source_system"), F.substring("event_time", 1, 10).alias("ingest_date"),
        F.col("event_type").alias("batch_id"))
    return incremental.replay_manifest(bronze)


@query("INC-2", """select event_type, count(*) as events from silver_behavior where event_type = 'purchase' group by 1""")
def replay_one_batch(spark, sf):
    """One batch through the silver rules again."""
    bronze = view(spark, sf, "raw_behavior").withColumns({
        "source_system": F.lit("behavior"), "ingest_date": F.substring("event_time", 1, 10),
        "batch_id": F.col("event_type")})
    rows = accepted(standardize(bronze, "customer_behavior", ["_pos"])).withColumn("batch_id", F.upper("event_type"))
    return incremental.replay_slice(rows, "behavior", batch_id="PURCHASE").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"))


@query("SET-1", """select coalesce(customer_id, 'none') as customer_id, count(*) as rows_seen, count(product_id) as with_product,
      count(topic) as with_topic from (
      select customer_id, product_id, null as topic from silver_behavior
      union all select customer_id, null, topic from silver_support) group by 1""")
def union_by_name(spark, sf):
    behavior = silver(spark, sf, "customer_behavior").select("customer_id", "product_id")
    support = silver(spark, sf, "crm_support").select("customer_id", "topic")
    both = behavior.unionByName(support, allowMissingColumns=True)
    return both.groupBy(F.coalesce("customer_id", F.lit("none")).alias("customer_id")).agg(
        F.count(F.lit(1)).alias("rows_seen"), F.count("product_id").alias("with_product"),
        F.count("topic").alias("with_topic"))


@query("SNK-8", """select alert_id, severity from alerts where alert_id not in (select alert_id from alerts where severity = 'critical')""")
def insert_if_absent(spark, sf):
    alerts = view(spark, sf, "alerts")
    existing = alerts.where(F.col("severity") == "critical")
    return lake.insert_if_absent(existing, alerts, "alert_id").select("alert_id", "severity")


@query("SRC-13 AGG-18", """select criticality_tier, count(*) as datasets, cast(sum(runs) as bigint) as runs
    from (select c.criticality_tier, r.dataset_name, count(*) as runs from run_states r join catalog c using (dataset_name) group by 1, 2)
    group by 1""")
def runs_by_tier(spark, sf):
    from plumbline.config import DATASET_TIERS

    kinds, path = "dataset_name string, criticality_tier string, owner string, sla_hours int", f"{ensure_checkpoint_dir(spark)}/tiers-{uuid.uuid4().hex}"
    spark.createDataFrame(DATASET_TIERS, kinds).write.option("header", True).csv(path)
    tiers = F.broadcast(landing.read_seed(spark, path, kinds))  # a seed has a row a dataset
    runs = view(spark, sf, "run_states").groupBy("dataset_name").agg(F.count(F.lit(1)).alias("n"))
    return runs.join(tiers, "dataset_name").groupBy("criticality_tier").agg(
        F.count(F.lit(1)).alias("datasets"), F.sum("n").alias("runs"))
