"""Column and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.casts import count_when, is_blank, row_digest
from plumbline.functions.names import data_columns


def profile_columns(df: DataFrame, approximate: bool = False, rsd: float = 0.05) -> DataFrame:
    """Null count, null rate and distinct count of every column.

    Exact distinct counts group (column, value) pairs; map tasks count first, so a value that
    fills a third of a column stays cheap. ``approximate`` uses one sketch per column instead
    and needs no shuffle of values.
    """
    columns = data_columns(df)
    filled = {c: F.when(~is_blank(F.col(f"`{c}`")), F.col(f"`{c}`").cast("string")) for c in columns}
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for column in columns:
        aggregates.append(count_when(is_blank(F.col(f"`{column}`"))).alias(f"__n_{column}"))
        if approximate:
            aggregates.append(F.approx_count_distinct(filled[column], rsd).alias(f"__d_{column}"))
    facts = df.agg(*aggregates)
    rows = facts.select("__rows", F.explode(F.array(*[
        F.struct(
            F.lit(column).alias("column_name"), F.col(f"`__n_{column}`").alias("null_count"),
            (F.col(f"`__d_{column}`") if approximate else F.lit(None).cast("bigint")).alias("distinct_count"),
        )
        for column in columns
    ])).alias("c")).select(F.col("__rows").alias("row_count"), "c.*")
    if not approximate:
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), filled[c].alias("value")) for c in columns
        ])).alias("p")).select("p.*").where("value is not null")
        distinct = (
            pairs.groupBy("column_name", "value").agg(F.lit(1).alias("one"))
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
        )
        rows = rows.drop("distinct_count").join(distinct, "column_name", "left")
    rate = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count")).otherwise(F.lit(0.0))
    return rows.select(
        "column_name", "row_count", "null_count", rate.alias("null_rate"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"))


#: log2 of the registers of a distinct sketch, and three of its standard errors
SKETCH_SIZE = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_SIZE / 2)


def profile_sketches(df: DataFrame, by: list[str]) -> DataFrame:
    """Per group (file) and column: row_count, null_count and a mergeable sketch of its distinct values, in one pass."""
    columns = data_columns(df)
    blank = {c: is_blank(F.col(f"`{c}`")) for c in columns}
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        aggregates.append(count_when(blank[c]).alias(f"__n{i}"))
        aggregates.append(F.hll_sketch_agg(F.when(~blank[c], F.col(f"`{c}`").cast("string")), F.lit(SKETCH_SIZE)).alias(f"__d{i}"))
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_count"), F.col(f"__d{i}").alias("distinct_sketch"))
             for i, c in enumerate(columns)]
    facts = df.groupBy(*by).agg(*aggregates)
    return facts.select(*by, F.col("__rows").alias("row_count"), F.explode(F.array(*cells)).alias("c")).select(*by, "row_count", "c.*")


def merge_profiles(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Stored profiles of files added up per ``by`` and column; no value is read again."""
    by = by or []
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"))


def profile_table(df: DataFrame) -> DataFrame:
    """Row and column counts and surplus copies of whole rows.

    Rows are compared by a 256-bit digest, so the shuffle moves 64 characters per distinct
    row however wide it is; copies collapse before it.
    """
    columns = data_columns(df)
    digests = (
        df.select(row_digest([F.col(f"`{c}`") for c in columns]).alias("d"))
        .groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    )
    copies = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return digests.agg(
        rows.alias("row_count"), F.lit(len(columns)).alias("column_count"),
        copies.alias("duplicate_rows"),
    ).withColumn(
        "duplicate_rate",
        F.when(F.col("row_count") > 0, F.col("duplicate_rows") / F.col("row_count")).otherwise(F.lit(0.0)))


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Order-free content fingerprint: row count and the sum of 60 digest bits per row."""
    chosen = columns or data_columns(df)
    bits = F.conv(F.substring(row_digest([F.col(c) for c in chosen]), 1, 15), 16, 10)
    return df.select(bits.cast("decimal(20,0)").alias("b")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("string").alias("content_sum"))
