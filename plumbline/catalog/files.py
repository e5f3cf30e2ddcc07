"""Registered queries that write tables out and read them back.

They write below the cluster's checkpoint folder, which every executor can reach, into a new
folder per call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.catalog.control import ready_rows
from plumbline.catalog.registry import query
from plumbline.catalog.sources import orders, revenue, silver
from plumbline.catalog.views import table, view
from plumbline.functions.casts import is_blank
from plumbline.config import SOURCES
from plumbline.operators import contract
from plumbline.plans import marts
from plumbline.session import ensure_checkpoint_dir
from plumbline.sinks import export, lake
from plumbline.sources import landing
from plumbline.sources.bronze import enrich


def scratch(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/plumbline-{uuid.uuid4().hex}"


@query("SRC-1 SRC-4 SRC-5 SET-1 SNK-5 PRJ-1", """
    select priority, count(*) as tickets, count(distinct ticket_id) as ids,
      count(*) filter (where user_id is null or user_id = '') as without_user,
      count(case when status = 'open' then topic end) as with_topic
    from raw_support group by 1""")
def landing_csv_two_headers(spark, sf):
    """Tickets landed as CSV under two headers, read per header and stacked by name."""
    root, rows = scratch(spark), view(spark, sf, "raw_support").drop("_pos")
    is_open = F.col("status") == "open"
    lake.write_sorted_csv(rows.where(is_open), f"{root}/first")
    second = rows.where(~is_open).withColumnsRenamed({"ticket_id": "Ticket ID", "user_id": "User-ID"})
    lake.write_sorted_csv(second.drop("topic"), f"{root}/second")
    groups = landing.read_landing(spark, f"{root}/*/part-*.csv")
    return landing.union_groups(groups).groupBy("priority").agg(
        F.count(F.lit(1)).alias("tickets"), F.countDistinct("ticket_id").alias("ids"),
        F.count_if(is_blank(F.col("user_id"))).alias("without_user"), F.count("topic").alias("with_topic"))


@query("SRC-3", """
    select event_type, count(*) as n, count(distinct session_id) as sessions, min(event_time) as first_time
    from raw_behavior group by 1""")
def landing_json_lines(spark, sf):
    """Behaviour events landed as JSON lines."""
    path = scratch(spark)
    view(spark, sf, "raw_behavior").drop("_pos").write.json(path)
    return landing.read_jsonl_group(spark, [path]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("session_id").alias("sessions"),
        F.min("event_time").alias("first_time"))


@query("SRC-2", """
    select priority, count(*) as tickets, count(distinct ticket_id) as ids, min(ticket_id) as first_ticket,
      count(*) filter (where user_id = '') as without_user from raw_support group by 1""")
def landing_json_documents(spark, sf):
    """Tickets as JSON documents that hold their rows under ``records``, one file for each stretch of 500 events."""
    root, rows = scratch(spark), view(spark, sf, "raw_support")
    record = F.struct(*[c for c in rows.columns if c != "_pos"])
    documents = rows.groupBy(F.floor(F.col("_pos") / 500).alias("_doc")).agg(F.to_json(F.struct(F.collect_list(record).alias("records"))).alias("value"))
    # one document a file, all in one folder: a folder per document makes the read discover thousands of partitions
    documents.select("value").write.option("maxRecordsPerFile", 1).text(root)
    landed = landing.read_json_group(spark, [root], "{")
    return landed.groupBy("priority").agg(
        F.count(F.lit(1)).alias("tickets"), F.countDistinct("ticket_id").alias("ids"), F.min("ticket_id").alias("first_ticket"),
        F.count_if(F.col("user_id") == "").alias("without_user"))


@query("Q-4 Q-5 Q-8 Q-20", """
    with t as (select *, case status when 'open' then 'full' when 'pending' then 'lean' else 'odd' end as kind,
        case when priority not in ('low', 'Medium', 'HIGH', 'urgent') then 1 else 0 end as bad from raw_support),
      n as (select kind, count(*) as row_count, sum(bad) as bad, round(count(*) filter (where user_id = '') / count(*), 4) > 0.05 as blank from t group by 1)
    select kind, row_count, case when kind = 'full' and bad = 0 and not blank then 'PASS' else 'FAIL' end as status,
      case kind when 'lean' then 'created_ts,customer_id,status,ticket_id,topic' when 'full' then 'created_ts,customer_id,priority,status,ticket_id,topic'
        else 'channel,created_ts,customer_id,priority,status,ticket_id,topic' end as observed_columns,
      case when kind = 'lean' then '' else 'user_id=customer_id' end as renames,
      concat_ws(';', case when kind = 'lean' then 'required_columns_present' when kind = 'odd' then 'unexpected_columns' end,
        case when blank then 'null_threshold_customer_id' end, case when kind = 'lean' then 'null_threshold_priority' end,
        case when kind = 'odd' then 'type_validation_created_ts' end,
        case when kind <> 'lean' and bad > 0 then 'accepted_values_priority' end) as checks,
      case kind when 'lean' then 'Missing required columns: priority' when 'odd' then 'New non-contracted columns observed: channel' else '' end as schema_message,
      case when kind = 'odd' then 'string' else '' end as observed_type
    from n""")
def contract_of_json_files(spark, sf):
    """Tickets as JSON lines in three parts that differ in keys and types: each part is judged by the keys it has itself."""
    root, rows = scratch(spark), view(spark, sf, "raw_support").drop("_pos")
    kind = F.when(F.col("status") == "open", "full").when(F.col("status") == "pending", "lean").otherwise("odd")
    full = ["ticket_id", "user_id", "created_ts", "priority", "status", "topic"]
    records = {
        "full": [F.col(c) for c in full],
        "lean": ["ticket_id", F.col("user_id").alias("Customer ID"), "created_ts", "status", F.lit(None).cast("string").alias("topic")],
        "odd": [*[F.lit("soon").alias(c) if c == "created_ts" else F.col(c) for c in full], F.lit("web").alias("channel")],
    }
    lines = F.lit(None).cast("string")
    for name, columns in records.items():
        lines = F.when(kind == name, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).otherwise(lines)
    rows.select(kind.alias("_kind"), lines.alias("value")).write.partitionBy("_kind").text(root)
    landed = landing.read_jsonl_group(spark, [root])
    reports = contract.contract_reports(landed, SOURCES["crm_support"], ["_kind"], keys=landing.json_keys(spark, [root], by=("_kind",)))
    found = F.transform("violations", lambda v: v["check_name"])
    messages = F.filter("violations", lambda v: v["check_name"].isin("required_columns_present", "unexpected_columns"))
    types = F.filter("violations", lambda v: v["check_name"].startswith("type_validation"))
    return reports.select(
        F.col("_kind").alias("kind"), "row_count", "status", F.array_join("observed_columns", ",").alias("observed_columns"),
        F.array_join(F.transform(F.map_entries("safe_renames_applied"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("renames"),
        F.array_join(found, ";").alias("checks"), F.array_join(F.transform(messages, lambda v: v["message"]), ";").alias("schema_message"),
        F.array_join(F.transform(types, lambda v: v["observed_value"]), ";").alias("observed_type"))


@query("SNK-1 SRC-12 PRJ-5", """
    select 'operational_logs' as source_system, case when event_ts < '2024-01-16' then '2024-01-15' else '2024-01-31' end as ingest_date,
      count(*) as row_count, count(distinct log_id) as logs from raw_logs group by 2""")
def bronze_partitions(spark, sf):
    """All logs as two loads, the second one written twice: a rerun replaces its own partition."""
    path, rows = scratch(spark), view(spark, sf, "raw_logs")
    early = F.col("event_ts") < "2024-01-16"
    for day, load in (("2024-01-15", rows.where(early)), ("2024-01-31", rows.where(~early)), ("2024-01-31", rows.where(~early))):
        lake.write_bronze(enrich(load, "operational_logs", f"batch-{day}", f"{day}T23:59:59Z"), path, day, f"batch-{day}")
    back = spark.read.parquet(path)
    return back.groupBy("source_system", F.col("ingest_date").cast("string").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("log_id").alias("logs"))


@query("SNK-2 SNK-4 SRC-12 AGG-23", """
    select 'silver' as layer, 'silver_crm_support' as dataset_name, count(*) as row_count, 'written' as status from silver_support
    union all select 'silver', 'silver_product_catalog', count(*), 'written' from silver_products
    union all select 'gold', 'gold_marketing_attribution', count(*), 'written' from gold_marketing
    union all select 'gold', 'gold_empty', 0, 'skipped'""")
def lake_manifest(spark, sf):
    """Layers written as Parquet with row counts taken during the write."""
    root = scratch(spark)
    marketing = marts.gold_marketing_attribution(orders(spark, sf), silver(spark, sf, "marketing_campaigns"))
    results = [
        lake.write_layer(df, root, layer, name, "2024-02-01", "batch-1")
        for layer, name, df in (
            ("silver", "silver_crm_support", silver(spark, sf, "crm_support")),
            ("silver", "silver_product_catalog", silver(spark, sf, "product_catalog")),
            ("gold", "gold_marketing_attribution", marketing),
            ("gold", "gold_empty", table(spark, sf, "nation").where("n_nationkey < 0")))
    ]
    return lake.manifest(spark, results).select("layer", "dataset_name", "row_count", "status")


@query("SNK-13 SNK-11 UDF-3", """
    select 'dataset_readiness' as file, 'written' as status, count(*) as row_count from readiness
    union all select 'gold_revenue_analytics', 'written', count(*) from gold_revenue
    union all select 'lineage_edges', 'empty_source_missing', 0""")
def export_manifest(spark, sf):
    """Flat CSV exports and their manifest; one source is missing."""
    frames = {
        "dataset_readiness": lambda: ready_rows(spark, sf),
        "gold_revenue_analytics": lambda: revenue(spark, sf),
        "lineage_edges": lambda: None,
    }
    exports = {name: export.Export(name, export.EXPORT_COLUMNS[name], build) for name, build in frames.items()}
    return export.write_exports(spark, exports, scratch(spark)).select("file", "status", "row_count")


@query("SNK-6", """
    select source_system, layer, count(*) as loads, cast(sum(row_count) as bigint) as row_count,
      cast(sum(rejected_count) as bigint) as rejected_count from load_log group by 1, 2""")
def load_log_appended(spark, sf):
    """Load-log entries appended layer by layer and read back as one log."""
    path, loads = scratch(spark), view(spark, sf, "load_log").withColumn("file_name", F.lit("events"))
    for layer in ("bronze", "silver"):
        counts = loads.where(F.col("layer") == layer).select(
            "source_system", "file_name", "row_count", "rejected_count", "schema_version")
        lake.load_log_entries(counts, "batch-1", "2024-02-01T00:00:00Z", layer).write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("source_system", "layer").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("row_count").alias("row_count"),
        F.sum("rejected_count").alias("rejected_count"))
