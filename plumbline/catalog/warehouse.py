"""Registered queries that load catalog tables, partitions and reject files, and read back what was loaded."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.catalog.files import scratch
from plumbline.catalog.quality import _typed_fields
from plumbline.catalog.registry import query
from plumbline.catalog.sources import marked, orders, silver
from plumbline.catalog.views import table, view
from plumbline.config import SOURCES
from plumbline.operators import contract, drift, pii, profile
from plumbline.operators.dedupe import REASON
from plumbline.plans import marts
from plumbline.sinks import export, lake
from plumbline.sources import landing


def database(spark) -> str:
    """A new catalog database whose tables lie in the shared folder."""
    name = f"plumbline_{uuid.uuid4().hex}"
    spark.sql(f"create database {name} location '{scratch(spark)}'")
    return name


@query("SNK-7 SNK-15 Q-11", """
    with f as (select service_name, count(*) as n, count(*) filter (where status = '') as blank from raw_logs group by 1),
      r as (select *, round(blank / n, 4) as share from f)
    select service_name, n as row_count, case when share > 0 then 'QUARANTINE' else 'PASS' end as status, (share > 0)::bigint as violations,
      case when share > 0 then 'null_threshold_status' end as check_name, case when share > 0 then share end as observed,
      case when share > 0 then cast(0 as bigint) end as position, 'event_ts' as first_column from r""")
def warehouse_contract_tables(spark, sf):
    """Contract reports per service in two catalog tables, violations as keyed child rows; both are loaded twice and hold the second load."""
    base = database(spark)
    rows = view(spark, sf, "raw_logs").drop("_pos").withColumn("_group", F.col("service_name"))
    reports = contract.contract_reports(rows, SOURCES["operational_logs"], by=["_group"]).withColumn("business_domain", F.lit(" "))
    columns = ["_group", *export.CONTRACT_VALIDATION_COLUMNS]
    parent = export.warehouse_rows(reports, columns, ("business_domain",))
    child = export.child_rows(reports, ["_group", "source_system"], "violations")
    for name, frame in (("contract_validations", parent), ("contract_violations", child)):
        lake.truncate_and_load(frame.limit(1), f"{base}.{name}")
        lake.truncate_and_load(frame, f"{base}.{name}")
    loaded = spark.table(f"{base}.contract_validations").where("business_domain is null").withColumn(
        "first_column", F.element_at(F.from_json("observed_columns", "array<string>"), 1))
    return loaded.join(spark.table(f"{base}.contract_violations"), ["_group", "source_system"], "left").select(
        F.col("_group").alias("service_name"), "row_count", "status", F.col("violation_count").cast("bigint").alias("violations"),
        "check_name", F.col("observed_value").cast("double").alias("observed"), "position", "first_column")


@query("SNK-10", """select service_name, count(*) as event_count, count(*) filter (where status = 'failed') as failures from silver_logs group by 1""")
def models_materialized(spark, sf):
    """A silver model as a view and a mart as a table, joined by their names."""
    base = database(spark)
    lake.materialize(silver(spark, sf, "operational_logs"), f"{base}_logs", "view")
    lake.materialize(marts.gold_operational_metrics(silver(spark, sf, "operational_logs")), f"{base}.operational", "table")
    return spark.sql(f"""
        select m.service_name, m.event_count, v.failures from {base}.operational m
        join (select service_name, count_if(status = 'failed') as failures from {base}_logs group by service_name) v on m.service_name = v.service_name""")


@query("SNK-12 AGG-1", """select cast(order_ts as date) as order_date, count(*) filter (where status = 'completed') as completed_orders,
      cast(sum(case when status = 'completed' then amount else 0 end) as decimal(18,2))::double as gross_revenue from silver_orders group by 1""")
def daily_revenue_partitions(spark, sf):
    """Daily revenue in a partition a day; one year is there with stale rows first and then overwritten, the others stay."""
    path = scratch(spark)
    daily = marts.revenue_daily_job(orders(spark, sf).withColumn("order_ts", F.col("order_ts").cast("string"))).select(
        "order_date", "completed_orders", F.round("gross_revenue", 2).alias("gross_revenue"))
    daily.write.parquet(f"{path}/days")
    days = spark.read.parquet(f"{path}/days")
    year = F.year("order_date") == 1995
    stale = days.withColumn("completed_orders", F.when(year, F.lit(-1).cast("bigint")).otherwise(F.col("completed_orders")))
    lake.replace_partitions(stale.repartition("order_date"), f"{path}/table", "order_date")
    lake.replace_partitions(days.where(year).repartition("order_date"), f"{path}/table", "order_date")
    return spark.read.schema(days.schema).parquet(f"{path}/table").select("order_date", "completed_orders", "gross_revenue")


@query("SNK-14 SRC-9", """select _reject_reason as reason, count(*) as n, count(transaction_id) as with_key, min(transaction_id) as first_key, true as tagged
    from marked_orders where _reject_reason is not null group by 1""")
def reject_files(spark, sf):
    """Rejected orders written as files of their batch, and scanned from all files with the name of each."""
    path, rows = scratch(spark), marked(spark, sf, "ecommerce_transactions")
    lake.write_rejects(rows, path, "silver_ecommerce_transactions", "batch-1")
    back = landing.read_rejected(spark, path, rows.select("transaction_id", REASON).schema)
    return back.groupBy(F.col(REASON).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.count("transaction_id").alias("with_key"), F.min("transaction_id").alias("first_key"),
        F.bool_and(F.col("source_file").startswith("part-")).alias("tagged"))


@query("SRC-8", """select 'there' as path, count(*) as n, 6 as columns from raw_support union all select 'missing', 0, 6""")
def csv_there_or_not(spark, sf):
    """Tickets as headed CSV, and a path at which nothing is."""
    root, rows = scratch(spark), view(spark, sf, "raw_support").drop("_pos")
    rows.write.option("header", True).csv(f"{root}/there")
    found = [landing.read_csv_or_empty(spark, f"{root}/{name}", rows.columns).agg(
        F.lit(name).alias("path"), F.count(F.lit(1)).alias("n")) for name in ("there", "missing")]
    return found[0].unionByName(found[1]).withColumn("columns", F.lit(len(rows.columns)))


@query("AGG-10 AGG-9", """
    select column_name, count(*) as row_count, count(*) filter (where value = '') as null_count, count(distinct nullif(value, '')) as distinct_count,
      true as agrees
    from (unpivot (select ticket_id, user_id, created_ts, priority, status, topic from raw_support)
        on ticket_id, user_id, created_ts, priority, status, topic into name column_name value value) group by 1""")
def column_profile_sketches(spark, sf):
    """Profiles per file from stored sketches, merged; the merged estimate agrees with the exact count within its stated error."""
    path, rows = scratch(spark), view(spark, sf, "raw_support").drop("_pos")
    files = rows.withColumn("_file", F.concat_ws("-", "priority", "status"))
    profile.profile_sketches(files, ["_file"]).write.parquet(path)
    merged = profile.merge_profiles(spark.read.parquet(path))
    exact = profile.profile_columns(rows).select("column_name", "distinct_count")
    error = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.ceil(F.col("distinct_count") * profile.SKETCH_ERROR)
    return merged.join(exact, "column_name").select("column_name", "row_count", "null_count", "distinct_count", error.alias("agrees"))


@query("LIM-1 GOV-1", """
    select * from (select 'documents' as dataset_name, 'text' as column_name, 'email' as value_type,
      count(*) filter (where regexp_matches(trim(text), '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}')) as match_count
      from (select text, row_number() over () as n from documents) where n <= 25) where match_count > 0
    union all select 'first rows', 'source', 'any', 25""")
def pii_first_rows(spark, sf):
    """The quick look: personal data in the first 25 rows only, in file order; and how many rows that are."""
    rows = table(spark, sf, "documents").select("text", "source", "_pos").orderBy("_pos")
    email = {"email": r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"}
    seen = pii.scan_values(rows.select(F.coalesce("source", F.lit("none")).alias("source"), "_pos"), "first rows", {"any": "."}, sample_rows=25)
    return pii.scan_values(rows.select("text", "_pos"), "documents", email, sample_rows=25).unionByName(seen)


@query("SET-2 Q-3", """
    with days as (select source_system, day, cast(substr(day, 9) as int) % 2 = 0 as flag, day >= '2024-01-10' as seen from (select distinct source_system, day from schema_fields)),
      pairs as (select *, lag(flag) over w as old_flag, lag(seen) over w as old_seen, row_number() over w as n from days window w as (partition by source_system order by day))
    select source_system, day, case when n = 1 then concat_ws(',', 'event_id', case when flag then 'flag' end, 'seen_at', case when seen then 'seen_on' end, 'value')
        else concat_ws(',', case when flag and not old_flag then 'flag' end, case when seen and not old_seen then 'seen_on' end) end as added,
      concat_ws(',', case when not flag and old_flag then 'flag' end, case when not seen and old_seen then 'seen_on' end) as removed from pairs""")
def schema_column_sets(spark, sf):
    """Columns that come and go from day to day: one on even days only, one from the tenth on."""
    fields = _typed_fields(spark, sf)
    there = (F.when(F.col("column_name") == "flag", F.substring("day", 9, 2).cast("int") % 2 == 0)
             .when(F.col("column_name") == "seen_on", F.col("day") >= "2024-01-10").otherwise(True))
    history = drift.schema_history(drift.snapshots(fields.where(there), ["source_system", "day"]), ["day"])
    return history.select("source_system", "day", F.array_join("added_columns", ",").alias("added"), F.array_join("removed_columns", ",").alias("removed"))
