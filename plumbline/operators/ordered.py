"""Order-dependent operators that never put a whole key into one task.

A plain window over ``partitionBy(key)`` sorts all rows of a key in one task. Here rows are
range-partitioned by (key, order) first, so a key that owns a third of the table is spread
over many tasks. Offsets per (key, partition) then give every row its exact position, and
positions cut each key into blocks of bounded size for further windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.joins import join_null_safe
from plumbline.session import cut_lineage

BLOCK_ROWS = 100_000


def with_position(
    df: DataFrame, keys: list[str], order: list[str], name: str = "_n", partitions: int | None = None
) -> DataFrame:
    """1-based position of each row within its key. ``order`` should be unique per key.

    The range-partitioned rows are checkpointed once: range borders come from a sample, and
    both uses below must see the same borders, also after a task is retried. Without a number
    of ``partitions`` AQE merges small neighbouring slices, which keeps their order.
    """
    wanted = [partitions] if partitions else []
    ranged = cut_lineage(
        df.repartitionByRange(*wanted, *keys, *order).withColumn("_slice", F.spark_partition_id())
    )
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    # at most one row per (key, slice), so this window is bounded by the number of slices
    earlier = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranged.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    local = ranged.withColumn("_local", F.row_number().over(in_slice))
    return (
        join_null_safe(local, offsets, [*keys, "_slice"], "inner")
        .withColumn(name, (F.col("_before") + F.col("_local")).cast("bigint"))
        .drop("_before", "_local", "_slice")
    )


def with_blocks(df: DataFrame, lookback: int, position: str = "_n", size: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``_block``; the last ``lookback`` rows of a block also appear in the next one.

    Those extra rows have ``_copy`` set. A window over (key, block) that looks back at most
    ``lookback`` rows is exact on the rows without the mark.
    """
    home = F.floor((F.col(position) - 1) / size)
    near_end = (F.col(position) - 1) % size >= size - lookback
    return (
        df.withColumn("_home", home)
        .withColumn(
            "_block",
            F.explode(
                F.when(near_end, F.array(F.col("_home"), F.col("_home") + 1))
                .otherwise(F.array(F.col("_home")))
            ),
        )
        .withColumn("_copy", F.col("_block") != F.col("_home"))
        .drop("_home")
    )


def trailing(
    df: DataFrame, keys: list[str], order: list[str], size: int, aggregates: dict,
    block_rows: int = BLOCK_ROWS, partitions: int | None = None,
) -> DataFrame:
    """Aggregates over the ``size`` rows before each row. ``aggregates``: name -> Column."""
    placed = with_position(df, keys, order, partitions=partitions)
    window = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-size, -1)
    blocks = with_blocks(placed, size, size=max(block_rows, size + 1))
    for name, column in aggregates.items():
        blocks = blocks.withColumn(name, column.over(window))
    return blocks.where(~F.col("_copy")).drop("_copy", "_block", "_n")


def previous(
    placed: DataFrame, keys: list[str], columns: list[str], prefix: str = "previous_",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Values of the row before, for rows that carry ``_n`` from ``with_position``."""
    window = Window.partitionBy(*keys, "_block").orderBy("_n")
    blocks = with_blocks(placed, 1, size=max(block_rows, 2))
    for column in columns:
        blocks = blocks.withColumn(f"{prefix}{column}", F.lag(column).over(window))
    return blocks.where(~F.col("_copy")).drop("_copy", "_block")


def running_total(
    placed: DataFrame, keys: list[str], column: str, name: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Cumulative sum of ``column`` up to each row, for rows that carry ``_n``."""
    blocks = placed.withColumn("_block", F.floor((F.col("_n") - 1) / block_rows))
    inside = (
        Window.partitionBy(*keys, "_block").orderBy("_n")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        blocks.groupBy(*keys, "_block").agg(F.sum(column).alias("_sum"))
        .withColumn("_carry", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .drop("_sum")
    )
    local = blocks.withColumn("_inside", F.sum(column).over(inside))
    return (
        join_null_safe(local, offsets, [*keys, "_block"], "inner")
        .withColumn(name, F.col("_inside") + F.col("_carry"))
        .drop("_inside", "_carry", "_block")
    )
