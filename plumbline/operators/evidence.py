"""Offending values: all of them as a table in pages, and the first page in a report cell next to the exact count.

A list of all offending values can be as long as the table, so no row ever carries it whole. ``pages`` numbers the distinct values of a
group in order and cuts them into pages of bounded size; positions come from a range partitioning, so a group that owns
most values is spread over many tasks. Report rows carry page one, and say how many values there are when it is not the only page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ordered import with_position

#: values a page, and so the most that a report cell shows
PAGE = 1000


def _distinct(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("string").alias("__v")).distinct()


def pages(df: DataFrame, by: list[str], value: str, size: int = PAGE) -> DataFrame:
    """``by``, page (from 1), value_count, first_value, last_value, value_list: every distinct value of each group, in order."""
    placed = with_position(_distinct(df, by, value), by, ["__v"], "__n")
    page = F.floor((F.col("__n") - 1) / size).cast("int") + 1
    return placed.groupBy(*by, page.alias("page")).agg(
        F.count(F.lit(1)).alias("value_count"), F.min("__v").alias("first_value"), F.max("__v").alias("last_value"),
        F.sort_array(F.collect_list("__v")).alias("value_list"))


def first_values(df: DataFrame, by: list[str], value: str, size: int = PAGE) -> DataFrame:
    """Per ``by``: ``value_list`` (the first page of distinct values, sorted) and ``value_count`` (all of them).

    The rank filter becomes a group limit that each map task applies before the shuffle.
    """
    distinct = _distinct(df, by, value)
    ranked = (
        distinct.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy("__v")))
        .where(F.col("__r") <= size)
    )
    lists = ranked.groupBy(*by).agg(F.sort_array(F.collect_list("__v")).alias("value_list"))
    counts = distinct.groupBy(*by).agg(F.count(F.lit(1)).alias("value_count"))
    return counts.join(lists, by)


def list_text(values: Column, count: Column) -> Column:
    """The first page as text, with the number of values if there are more pages."""
    text = F.array_join(F.coalesce(values, F.array().cast("array<string>")), ", ")
    return F.when(count > F.size(values), F.concat(text, F.lit(", ... ("), count.cast("string"), F.lit(" values in all)"))).otherwise(text)
