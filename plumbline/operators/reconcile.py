"""Totals of silver and gold tables that have to agree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 0.01


def compare_totals(pairs: list[tuple[str, DataFrame, Column, DataFrame, Column]], tolerance: float = TOLERANCE) -> DataFrame:
    """``pairs``: (check, left frame, left total, right frame, right total).

    All totals over one frame share one aggregation, so each table is read once. The totals
    are stacked as rows and paired by check name.
    """
    wanted: dict[int, tuple[DataFrame, list]] = {}
    for name, left, left_total, right, right_total in pairs:
        for side, frame, total in (("l", left, left_total), ("r", right, right_total)):
            wanted.setdefault(id(frame), (frame, []))[1].append((name, side, total))
    sides = []
    for frame, totals in wanted.values():
        facts = frame.agg(*[
            F.coalesce(total.cast("decimal(38,4)"), F.lit(0)).alias(f"t{i}")
            for i, (_, _, total) in enumerate(totals)])
        sides.append(facts.select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("check_name"), F.lit(side).alias("side"), F.col(f"t{i}").alias("v"))
            for i, (name, side, _) in enumerate(totals)])).alias("t")).select("t.*"))
    totals = reduce(DataFrame.unionByName, sides).groupBy("check_name").agg(
        F.max(F.when(F.col("side") == "l", F.col("v"))).alias("l"),
        F.max(F.when(F.col("side") == "r", F.col("v"))).alias("r"))
    difference = F.round(F.col("l") - F.col("r"), 4)
    return totals.select(
        "check_name", F.col("l").cast("double").alias("left_value"),
        F.col("r").cast("double").alias("right_value"),
        difference.cast("double").alias("difference"), F.lit(tolerance).alias("tolerance"),
        F.when(F.abs(difference) <= tolerance, "passed").otherwise("failed").alias("status"),
    )


def reconcile_gold(
    orders: DataFrame, revenue: DataFrame, products: DataFrame, targets: DataFrame,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The four comparisons between silver orders and the revenue, product and target marts."""
    done = orders.where(F.col("status") == "completed")
    # marts hold doubles; back to exact cents before summing
    def cents(column: str) -> Column:
        return F.sum(F.col(column).cast("decimal(18,4)"))

    return compare_totals([
        ("completed_revenue_silver_to_gold_revenue", done, cents("amount"), revenue, cents("gross_revenue")),
        ("completed_order_count_silver_to_gold_revenue", done, F.count(F.lit(1)), revenue, F.sum("completed_orders")),
        ("completed_revenue_silver_to_gold_product", done, cents("amount"), products, cents("gross_revenue")),
        ("gold_revenue_to_target_actual", revenue, cents("gross_revenue"), targets, cents("actual_revenue")),
    ], tolerance)


def overall_status(checks: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "failed")
    return checks.agg(
        F.count(F.lit(1)).alias("check_count"), failed.alias("failed_check_count"),
        F.when(failed > 0, "failed").otherwise("passed").alias("status"))
