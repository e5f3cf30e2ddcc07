"""The logical sources over the given tables.

Each text is plain SQL that Spark and the checking database both read, so both sides start
from the same rows: text values with blanks, mixed case, two generations of column names,
repeated keys, negative amounts and values outside their sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

RAW_ORDERS = """
select case when odd then tid end as transaction_id,
       case when not odd then tid end as order_id,
       customer_id, product_id,
       case when odd then order_time end as order_ts,
       case when not odd then order_time end as order_timestamp,
       case when odd then amount_text end as amount,
       case when not odd then amount_text end as order_value,
       status, quantity, campaign_id, coupon_code, _pos
from (
  select l_linenumber % 2 = 1 as odd,
         case when l_partkey % 211 = 0 then ' '
              else cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end as tid,
         customer_id, 'P' || cast(l_partkey as string) as product_id, order_time,
         cast(case when l_partkey % 97 = 0 then -net else net end as string) as amount_text,
         case when l_suppkey % 41 = 0 then '' when l_partkey % 101 = 0 then 'chargeback'
              when l_returnflag = 'N' then 'Completed' when l_returnflag = 'R' then 'refunded'
              else 'FAILED' end as status,
         case when l_suppkey % 23 = 0 then '' else cast(cast(l_quantity as int) as string) end as quantity,
         case when l_suppkey % 13 = 0 then '' else 'CMP-' || cast(l_suppkey % 30 as string) end as campaign_id,
         case when l_linenumber % 2 = 0 and l_partkey % 3 = 0
              then 'SAVE' || cast(l_partkey % 10 as string) else '' end as coupon_code,
         _pos
  from (
    select l.*, o.customer_id, o.order_time,
           cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
                as decimal(18,4)) as net
    from {lineitem} l join (
      select o_orderkey, replace(cast(o_orderdate as string), ' ', 'T') || 'Z' as order_time,
             case when o_custkey % 37 = 0 then '' else ' C' || cast(o_custkey as string) || ' ' end as customer_id
      from {orders} o) o on l.l_orderkey = o.o_orderkey) j
) x
"""

RAW_BEHAVIOR = """
select 'E' || cast(event_id - case when event_id % 20 = 1 then 1 else 0 end as string) as event_id,
       case when user_id % 29 = 0 then '' else 'C' || cast(user_id as string) end as user_id,
       replace(substr(cast(ts as string), 1, 19), ' ', 'T') || 'Z' as event_time,
       upper(event_type) as event_type,
       'P' || regexp_extract(props, '[0-9]+', 0) as product_id,
       'S-' || cast(user_id as string) || '-' || substr(cast(ts as string), 1, 10) as session_id,
       _pos
from {events} e where event_type <> 'error'
"""

RAW_SUPPORT = """
select 'T' || cast(event_id as string) as ticket_id,
       case when user_id % 31 = 0 then '' else 'C' || cast(user_id as string) end as user_id,
       replace(substr(cast(ts as string), 1, 19), ' ', 'T') || 'Z' as created_ts,
       case event_id % 5 when 0 then 'low' when 1 then 'Medium' when 2 then 'HIGH'
            when 3 then 'urgent' else 'critical' end as priority,
       case event_id % 3 when 0 then 'open' when 1 then 'pending' else 'Closed' end as status,
       'topic-' || regexp_extract(props, '[0-9]+', 0) as topic, _pos
from {events} e where event_type = 'error'
"""

RAW_LOGS = """
select 'L' || cast(event_id as string) as log_id, event_type as service_name,
       replace(substr(cast(ts as string), 1, 19), ' ', 'T') || 'Z' as event_ts,
       case when event_id % 53 = 0 then '' when value >= 100 then 'FAILED'
            when value >= 50 then 'Warning' else 'ok' end as status,
       case when event_id % 17 = 0 then '' else cast(cast(floor(value) as bigint) as string) end as runtime_seconds,
       _pos
from {events} e
"""

RAW_PRODUCTS = """
select 'P' || cast(p_partkey as string) as product_id, p_name as product_name,
       case when p_size % 19 = 0 then '' else p_type end as category,
       case p_size % 4 when 0 then 'true' when 1 then 'Yes' when 2 then 'false' else '0' end as active_flag,
       case when p_size % 2 = 0 then '$' else '' end || cast(cast(p_retailprice as decimal(12,2)) as string) as list_price,
       _pos
from {part} p
"""

RAW_CAMPAIGNS = """
select 'CMP-' || cast(n_nationkey as string) as campaign_id,
       '2024-01-' || lpad(cast(n_nationkey + 1 as string), 2, '0') as campaign_date,
       case when n_nationkey % 2 = 0 then upper(r_name) end as channel,
       case when n_nationkey % 2 = 1 then lower(r_name) end as channel_name,
       case when n_nationkey % 5 = 0 then '0' else cast(sum(cast(s_acctbal as decimal(12,2))) as string) end as spend,
       cast(count(*) * 1000 as string) as impressions, cast(count(*) * 37 as string) as clicks,
       n_nationkey as _pos
from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey
     join {region} r on n.n_regionkey = r.r_regionkey
group by n_nationkey, r_name
"""

RAW_TARGETS = """
select substr(cast(o_orderdate as string), 1, 10) as target_date,
       cast(sum(cast(o_totalprice as decimal(12,2))) as string) as revenue_target,
       cast(count(*) as string) as orders_target, min(o_orderkey) as _pos
from {orders} o where o_orderpriority = '1-URGENT' group by o_orderdate
"""

# One row per run (day) and mart, from the events of that day and type.
MART_OF = """case event_type when 'purchase' then 'gold_revenue_analytics' when 'view' then 'gold_customer_analytics'
            when 'click' then 'gold_marketing_attribution' when 'signup' then 'gold_product_performance'
            else 'gold_operational_metrics' end"""

RUN_STATES = f"""
select 'run-' || day as run_id, day as evaluated_at, dataset_name, row_count,
       case when top > 250 then 'failed' else 'passed' end as quality_status,
       case when low > 0.6 then 'failed' else 'passed' end as freshness_status,
       case row_count % 5 when 0 then 'unchanged' when 1 then 'new_schema'
            when 2 then 'breaking_drift' else 'compatible_evolution' end as schema_status
from (
  select substr(cast(ts as string), 1, 10) as day, {MART_OF} as dataset_name,
         count(*) as row_count, max(value) as top, min(value) as low
  from {{events}} e group by substr(cast(ts as string), 1, 10), {MART_OF}
) d
"""

HOURLY_COUNTS = """
select event_type as dataset_name, substr(cast(ts as string), 1, 13) as evaluated_at, count(*) as row_count
from {events} e group by event_type, substr(cast(ts as string), 1, 13)
"""

ALERTS = f"""
select 'A' || cast(event_id as string) as alert_id, 'run-' || substr(cast(ts as string), 1, 10) as run_id,
       substr(cast(ts as string), 1, 19) as timestamp,
       case when value >= 200 then 'critical' when value >= 150 then 'high'
            when value >= 120 then 'medium' else 'info' end as severity,
       event_type || '_spike' as alert_type,
       case when user_id % 3 = 0 then {MART_OF} else 'silver_' || event_type end as dataset_name,
       event_type as source_system,
       case when user_id % 2 = 0 then 'Late refresh of ' || {MART_OF} || ' seen by user ' || cast(user_id as string)
            else 'No reader affected' end as business_impact,
       'Review ' || event_type || ' load' as recommended_action,
       case when event_id % 3 = 0 then 'resolved' else 'open' end as resolution_status
from {{events}} e where value >= 100
"""

LINEAGE = f"""
select 'run-' || substr(cast(ts as string), 1, 10) as run_id, 'load_' || event_type as job_name,
       'raw.' || event_type as in_1, 'silver_' || cast(user_id % 10 as string) as in_2,
       case when user_id % 2 = 0 then 'gold.' else '' end || {MART_OF} as out_1
from {{events}} e where event_type <> 'click'
"""

LOAD_LOG = """
select case event_type when 'purchase' then 'ecommerce_transactions' when 'view' then 'customer_behavior'
            when 'click' then 'marketing_campaigns' when 'signup' then 'product_catalog'
            else 'crm_support' end as source_system,
       case when user_id % 2 = 0 then 'bronze' else 'silver' end as layer, ts as load_time,
       cast(floor(value) as bigint) as row_count, cast(floor(value) as bigint) % 3 as rejected_count,
       event_id % 7 as schema_version, 'run-' || substr(cast(ts as string), 1, 10) as run_id
from {events} e
"""

# Text columns whose kinds change from day to day, for type inference and drift.
TYPED_TEXT = """
select event_type as source_system, substr(cast(ts as string), 1, 10) as day,
       cast(event_id as string) as event_id,
       case when value > 200 then 'n/a' when value < 1 then '' else cast(cast(value as decimal(10,2)) as string) end as value,
       case when event_id % 2 = 0 then substr(cast(ts as string), 1, 10)
            else replace(substr(cast(ts as string), 1, 19), ' ', 'T') || 'Z' end as seen_at,
       case when user_id % 2 = 0 then 'true' else 'FALSE' end as flag,
       substr(cast(ts as string), 1, 10) as seen_on
from {events} e
"""

VIEWS = {
    "raw_orders": RAW_ORDERS, "raw_behavior": RAW_BEHAVIOR, "raw_support": RAW_SUPPORT,
    "raw_logs": RAW_LOGS, "raw_products": RAW_PRODUCTS, "raw_campaigns": RAW_CAMPAIGNS,
    "raw_targets": RAW_TARGETS, "run_states": RUN_STATES, "hourly_counts": HOURLY_COUNTS,
    "alerts": ALERTS, "lineage": LINEAGE, "load_log": LOAD_LOG, "typed_text": TYPED_TEXT,
}

SOURCE_VIEWS = {
    "ecommerce_transactions": "raw_orders", "marketing_campaigns": "raw_campaigns",
    "customer_behavior": "raw_behavior", "product_catalog": "raw_products",
    "operational_logs": "raw_logs", "targets_planning": "raw_targets", "crm_support": "raw_support",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with the position of each row in its file."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select("*", F.col("_metadata.row_index").alias("_pos"))


def spread(df: DataFrame, most: int = 64) -> DataFrame:
    """Deals the rows of a small file to all cores.

    A file with one row group is read by one task, and everything up to the next shuffle
    runs there. Tables with at least ``most`` splits are left as they are.
    """
    cores = min(df.sparkSession.sparkContext.defaultParallelism, most)
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, "_pos")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A logical source; only the tables its text names are opened."""
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    if "lineitem" in used:
        used["lineitem"] = spread(used["lineitem"])
    return spark.sql(text, **used)


def duckdb_text(name: str) -> str:
    """The same text for the checking database, with row positions by file order."""
    return VIEWS[name].format(**{t: f"(select *, row_number() over () - 1 as _pos from {t})" for t in TABLES})
