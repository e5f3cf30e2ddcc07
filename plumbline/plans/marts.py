"""Fact and dimension views and the eight gold marts.

Orders are the large side everywhere. Each mart first aggregates orders on the join key
(partial sums per map task, so a hot key is thin before its shuffle) and only then joins.
Money is summed as decimal and leaves as double, so results do not depend on task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.casts import MONEY, count_when, ratio, sum_when


def completed() -> Column:
    return F.col("status") == "completed"


def _amount() -> Column:
    return F.coalesce(F.col("amount"), F.lit(0).cast(MONEY))


def _double(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


# -- facts and dimensions -------------------------------------------------------------------

def fact_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "transaction_id", "customer_id", "product_id", "campaign_id", "order_ts",
        F.to_date("order_ts").alias("order_date"), "status", "quantity", "amount",
        F.when(completed(), F.col("amount")).otherwise(F.lit(0)).alias("completed_revenue"),
    )


def fact_marketing_spend(campaigns: DataFrame) -> DataFrame:
    return campaigns.select(
        "campaign_id", "campaign_date", "channel", "spend", "impressions", "clicks")


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_segment", "last_order_ts", "order_count", "support_tickets",
        "behavior_events")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "category", "active_flag", "list_price")


# -- revenue --------------------------------------------------------------------------------

def revenue_by_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.to_date("order_ts").alias("order_date")).agg(
        count_when(completed()).alias("completed_orders"),
        sum_when(completed(), _amount()).alias("gross_revenue"),
        count_when(F.col("status") == "refunded").alias("refund_count"),
        count_when(F.col("status") == "failed").alias("failed_orders"),
    )


def gold_revenue_analytics(orders: DataFrame, targets: DataFrame) -> DataFrame:
    daily = revenue_by_day(orders)
    plan = targets.select(
        F.col("target_date").alias("order_date"), "revenue_target", "orders_target")
    return daily.join(plan, "order_date", "left").select(
        "order_date", "completed_orders", _double("gross_revenue"), "refund_count",
        "failed_orders", _double("revenue_target"), "orders_target",
        ratio(F.col("gross_revenue"), F.col("revenue_target")).alias("revenue_attainment"),
    )


def gold_target_vs_actual(revenue: DataFrame) -> DataFrame:
    return revenue.select(
        F.col("order_date").alias("target_date"), F.col("gross_revenue").alias("actual_revenue"),
        "revenue_target", F.col("completed_orders").alias("actual_orders"), "orders_target",
        "revenue_attainment",
    )


# -- customers ------------------------------------------------------------------------------

def customer_activity(orders: DataFrame, events: DataFrame, tickets: DataFrame) -> DataFrame:
    """One row per customer known to any of the three sources; rows without customer are skipped.

    The three sides are stacked and aggregated once: the full outer join over three
    pre-aggregated sides, at the price of a single shuffle of partial sums.
    """
    none = F.lit(0)
    sides = [
        orders.select(
            "customer_id", F.lit(1).alias("o"), F.lit(0).alias("e"), F.lit(0).alias("t"),
            F.when(completed(), _amount()).otherwise(none.cast(MONEY)).alias("revenue"),
            F.when(F.col("status") == "refunded", 1).otherwise(0).alias("refund"),
            F.col("order_ts"),
        ),
        *[
            side.select(
                "customer_id", F.lit(0).alias("o"), F.lit(e).alias("e"), F.lit(t).alias("t"),
                none.cast(MONEY).alias("revenue"), F.lit(0).alias("refund"),
                F.lit(None).cast("timestamp_ntz").alias("order_ts"),
            )
            for side, e, t in ((events, 1, 0), (tickets, 0, 1))
        ],
    ]
    stacked = sides[0].unionByName(sides[1]).unionByName(sides[2])
    return stacked.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum("o").alias("order_count"),
        F.sum("revenue").alias("gross_revenue"),
        F.sum("refund").alias("refund_count"),
        F.max("order_ts").alias("last_order_ts"),
        F.sum("e").alias("behavior_events"),
        F.sum("t").alias("support_tickets"),
    )


def customer_activity_joined(orders: DataFrame, events: DataFrame, tickets: DataFrame) -> DataFrame:
    """The same rows by two chained full outer joins of pre-aggregated sides."""
    known = F.col("customer_id").isNotNull()
    bought = orders.where(known).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        sum_when(completed(), _amount()).alias("gross_revenue"),
        count_when(F.col("status") == "refunded").alias("refund_count"),
        F.max("order_ts").alias("last_order_ts"),
    )
    did = events.where(known).groupBy("customer_id").agg(F.count(F.lit(1)).alias("behavior_events"))
    asked = tickets.where(known).groupBy("customer_id").agg(F.count(F.lit(1)).alias("support_tickets"))
    counts = ["order_count", "gross_revenue", "refund_count", "behavior_events", "support_tickets"]
    return (
        bought.join(did, "customer_id", "full").join(asked, "customer_id", "full")
        .fillna(0, subset=counts)
    )


def customer_segment() -> Column:
    return (
        F.when((F.col("support_tickets") > 0) & (F.col("refund_count") > 0), "retention_risk")
        .when(F.col("gross_revenue") >= 250, "high_value")
        .otherwise("standard")
    )


def gold_customer_analytics(orders: DataFrame, events: DataFrame, tickets: DataFrame) -> DataFrame:
    return customer_activity(orders, events, tickets).select(
        "customer_id", "order_count", _double("gross_revenue"), "refund_count", "last_order_ts",
        "behavior_events", "support_tickets", customer_segment().alias("customer_segment"),
    )


# -- campaigns ------------------------------------------------------------------------------

def marketing_attribution(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Orders left-joined to campaigns, grouped by campaign and channel.

    Orders collapse to one row per campaign before the join. A campaign listed several times
    multiplies its orders, as the plain join would.
    """
    sold = orders.groupBy("campaign_id").agg(
        count_when(completed()).alias("n"), sum_when(completed(), _amount()).alias("revenue"))
    listed = campaigns.where(F.col("campaign_id").isNotNull()).groupBy("campaign_id", "channel").agg(
        F.max("spend").alias("spend"), F.count(F.lit(1)).alias("listings"))
    times = F.coalesce(F.col("listings"), F.lit(1))
    return (
        sold.join(listed, "campaign_id", "left")
        .groupBy(
            F.coalesce("campaign_id", F.lit("unknown")).alias("campaign_id"),
            F.coalesce("channel", F.lit("unknown")).alias("channel"),
        )
        .agg(
            F.coalesce(F.max("spend"), F.lit(0).cast(MONEY)).alias("spend"),
            F.sum(F.col("n") * times).alias("attributed_orders"),
            F.sum(F.col("revenue") * times).alias("attributed_revenue"),
        )
    )


def gold_marketing_attribution(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    return marketing_attribution(orders, campaigns).select(
        "campaign_id", "channel", _double("spend"), "attributed_orders",
        _double("attributed_revenue"),
        ratio(F.col("attributed_revenue"), F.col("spend")).alias("roas"),
    )


# -- products -------------------------------------------------------------------------------

def _product_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_id").agg(
        count_when(completed()).alias("order_count"),
        sum_when(completed(), F.col("quantity")).alias("units_sold"),
        sum_when(completed(), _amount()).alias("gross_revenue"),
    )


def product_sales(products: DataFrame, orders: DataFrame) -> DataFrame:
    """All catalog products with their completed sales."""
    groups = ["product_id", "product_name", "category", "active_flag"]
    listed = products.groupBy(*groups).agg(F.count(F.lit(1)).alias("listings"))
    joined = listed.join(_product_totals(orders), "product_id", "left")
    return joined.select(*groups, *[
        F.coalesce(F.col(total) * F.col("listings"), F.lit(0)).alias(total)
        for total in ("order_count", "units_sold", "gross_revenue")
    ])


def gold_product_performance(
    products: DataFrame, orders: DataFrame, keep_unknown: bool = False
) -> DataFrame:
    """Catalog products; with ``keep_unknown`` also products that only orders know."""
    if not keep_unknown:
        sales = product_sales(products, orders)
    else:
        catalog = products.select("product_id", "product_name", "category", "active_flag")
        sales = (
            catalog.join(_product_totals(orders), "product_id", "full")
            .fillna("unknown", subset=["product_name", "category"])
            .fillna({"active_flag": False, "order_count": 0, "units_sold": 0})
            .withColumn("gross_revenue", F.coalesce("gross_revenue", F.lit(0)))
        )
    return sales.select(
        "product_id", "product_name", "category", "active_flag", "order_count", "units_sold",
        _double("gross_revenue"))


def products_sold(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Products seen in orders, unknown ones kept with default attributes."""
    catalog = products.select("product_id", "product_name", "category", "active_flag")
    return _product_totals(orders).join(catalog, "product_id", "left").select(
        "product_id",
        F.coalesce("product_name", F.lit("unknown")).alias("product_name"),
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce("active_flag", F.lit(False)).alias("active_flag"),
        "order_count", "units_sold", _double("gross_revenue"),
    )


# -- operations, quality, freshness ---------------------------------------------------------

def gold_operational_metrics(logs: DataFrame) -> DataFrame:
    return logs.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("event_count"),
        count_when(F.col("status") == "failed").alias("failure_count"),
        count_when(F.col("status") == "warning").alias("warning_count"),
        F.avg("runtime_seconds").alias("avg_runtime_seconds"),
        F.max("event_ts").alias("last_event_ts"),
    )


def gold_data_quality_summary(checks: DataFrame, validated_at: str) -> DataFrame:
    """One row per table from check results in long form."""
    return checks.groupBy("dataset_name").agg(
        F.lit(validated_at).alias("validated_at"),
        F.max("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("check_count"),
        count_when(F.col("status") == "failed").alias("failed_check_count"),
    ).withColumn(
        "quality_status", F.when(F.col("failed_check_count") > 0, "failed").otherwise("passed"))


def gold_source_freshness(load_log: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Latest load per source and layer, failed when older than ``hours`` at ``as_of``."""
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {hours} hours")
    return load_log.groupBy("source_system", "layer").agg(
        F.max("load_time").alias("last_load_time"),
        F.sum("row_count").alias("row_count"),
        F.max("schema_version").alias("schema_version"),
    ).withColumn(
        "freshness_status",
        F.when(F.col("last_load_time") >= limit, "passed").otherwise("failed"))


def negative_revenue(revenue: DataFrame) -> DataFrame:
    """Singular test: must be empty."""
    return revenue.where(F.col("gross_revenue") < 0)


def revenue_daily_job(orders: DataFrame) -> DataFrame:
    """The stand-alone daily job: amounts as double, no de-duplication."""
    amount = F.col("amount").try_cast("double")
    return (
        orders.groupBy(F.to_date(F.col("order_ts").try_cast("timestamp_ntz")).alias("order_date"))
        .agg(
            count_when(completed()).alias("completed_orders"),
            F.sum(F.when(completed(), amount).otherwise(0.0)).alias("gross_revenue"),
            count_when(F.col("status") == "refunded").alias("refund_count"),
            count_when(F.col("status") == "failed").alias("failed_orders"),
        )
    )
