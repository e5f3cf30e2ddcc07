"""Registered queries on lasting tables: incremental marts that are written, and replays of one batch.

Each writes below the cluster's checkpoint folder, reads back what a reader would see, and says which partitions got new files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog.files import scratch
from plumbline.catalog.registry import query
from plumbline.catalog.views import view
from plumbline.plans.history import History, partition_changes
from plumbline.sinks import lake
from plumbline.sources.bronze import enrich

YEAR = "substr(coalesce(order_ts, order_timestamp), 1, 4)"


def _money(column: str):
    return F.sum(F.col(column).cast("decimal(20,4)")).cast("double")


def raw_orders(spark, root, sf):
    """The raw orders, joined once for all batches cut from them."""
    view(spark, sf, "raw_orders").write.parquet(f"{root}/raw_orders")
    return spark.read.parquet(f"{root}/raw_orders")


@query("INC-1 SNK-9 FLT-9 SNK-10", """select *, year(order_date) in (1994, 1997) as rewritten from gold_revenue""")
def revenue_mart_refreshed(spark, sf):
    """The revenue mart over all early rows, then refreshed by a batch of late rows for two old years: only those years are written again."""
    root = scratch(spark)
    lasting, rows = History(spark, root, grain="yyyy", order=["_pos"]), raw_orders(spark, root, sf)
    late = F.expr(f"{YEAR} in ('1994', '1997') and customer_id like '%7 '")
    lasting.load("targets_planning", view(spark, sf, "raw_targets"), "targets")
    lasting.load("ecommerce_transactions", rows.where(~late), "first")
    first = lasting.refresh("gold_revenue_analytics")
    lasting.load("ecommerce_transactions", rows.where(late), "late")
    lasting.refresh("gold_revenue_analytics")
    table = lasting.gold("gold_revenue_analytics")
    changes = partition_changes(table, first).select(F.col("partition").alias("period"), "rewritten")
    return table.read().join(F.broadcast(changes), "period").drop("period")


@query("INC-2 SNK-1 SRC-12", """
    with s as (select *, case when year(order_ts) < 1994 then 'b1' when year(order_ts) < 1996 then 'b2' else 'b3' end as batch from silver_orders),
      days as (select year(order_date) as y, count(*) as n, cast(sum(cast(gross_revenue as decimal(20,4))) as double) as gross from gold_revenue group by 1)
    select 'silver' as layer, 'silver_ecommerce_transactions' as dataset_name, batch || '/' || cast(year(order_ts) as varchar) as part, count(*) as row_count,
      batch = 'b2' as rewritten, cast(sum(amount) as double) as amount from s group by batch, year(order_ts)
    union all select 'gold', mart, cast(y as varchar), n, y in (1994, 1995), gross from days, (values ('gold_revenue_analytics'), ('gold_target_vs_actual')) m(mart)
    union all select 'gold', 'gold_customer_analytics', '', count(distinct customer_id), true,
      cast(sum(case when status = 'completed' then amount else 0 end) as double) from s where customer_id is not null""")
def replay_layers(spark, sf):
    """Three bronze batches; the second gets into silver spoilt, the marts follow it, and a replay from bronze mends all layers."""
    root = scratch(spark)
    lasting, rows = History(spark, root, grain="yyyy", order=["_pos"]), raw_orders(spark, root, sf)
    source = "ecommerce_transactions"
    batch = F.expr(f"case when {YEAR} < '1994' then 'b1' when {YEAR} < '1996' then 'b2' else 'b3' end")
    for name in ("b1", "b2", "b3"):
        lake.write_bronze(enrich(rows.where(batch == name), source, name, "2024-02-01T00:00:00Z"), f"{root}/bronze", "2024-02-01", name)
    lasting.load("targets_planning", view(spark, sf, "raw_targets"), "targets")
    lasting.load_bronze(source)
    spoilt = rows.where((batch == "b2") & (F.col("_pos") % 3 == 0)).withColumns({"amount": F.lit("1.0"), "order_value": F.lit("1.0")})
    lasting.load(source, spoilt, "b2")
    lasting.refresh_all(source)
    report = lasting.replay(source, batch_id="b2")
    silver = lasting.silver(source).read().groupBy(F.concat_ws("/", "batch_id", "period").alias("partition")).agg(_money("amount").alias("amount"))
    sums = silver.withColumn("dataset_name", F.lit(f"silver_{source}"))
    for mart, column in (("gold_revenue_analytics", "gross_revenue"), ("gold_target_vs_actual", "actual_revenue")):
        own = lasting.gold(mart).read().groupBy(F.col("period").alias("partition")).agg(_money(column).alias("amount"))
        sums = sums.unionByName(own.withColumn("dataset_name", F.lit(mart)))
    customers = lasting.gold("gold_customer_analytics").read().agg(F.lit("").alias("partition"), _money("gross_revenue").alias("amount"))
    sums = sums.unionByName(customers.withColumn("dataset_name", F.lit("gold_customer_analytics")))
    return report.join(F.broadcast(sums), ["dataset_name", "partition"]).select(
        "layer", "dataset_name", F.col("partition").alias("part"), "row_count", "rewritten", "amount")
