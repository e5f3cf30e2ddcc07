"""Personal-data scan: by column name and by value."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import (
    CLASSIFICATION, CONTROLS, DEFAULT_CONTROL, PII_NAME_PATTERNS, PII_VALUE_PATTERNS, Classification,
)
from plumbline.functions.casts import count_when, strip
from plumbline.functions.names import data_columns


def is_pii_name(column: str) -> bool:
    return any(re.search(pattern, column, re.IGNORECASE) for pattern in PII_NAME_PATTERNS)


def scan_values(
    df: DataFrame, dataset: str, patterns: dict[str, str] | None = None, sample_rows: int | None = None
) -> DataFrame:
    """Matching values per column and kind, in one pass over all rows and whole texts.

    ``sample_rows`` restricts the scan to the first rows, for a quick look.
    """
    patterns = patterns or PII_VALUE_PATTERNS
    source = df if sample_rows is None else df.limit(sample_rows)
    columns = data_columns(df)
    aggregates, results = [], []
    for i, column in enumerate(columns):
        text = strip(F.col(f"`{column}`").cast("string"))
        for kind, pattern in patterns.items():
            aggregates.append(count_when(text.rlike(pattern)).alias(f"__{i}_{kind}"))
            results.append(F.struct(
                F.lit(column).alias("column_name"), F.lit(kind).alias("value_type"),
                F.col(f"__{i}_{kind}").alias("match_count")))
    return (
        source.agg(*aggregates).select(F.explode(F.array(*results)).alias("r")).select("r.*")
        .where("match_count > 0")
        .select(F.lit(dataset).alias("dataset_name"), "column_name", "value_type", "match_count")
    )


def scan_names(dataset: str, columns: list[str], classification: dict[str, Classification]) -> dict:
    """Outcome of the name scan for one table; only the schema is needed."""
    found = sorted(column for column in columns if is_pii_name(column))
    known = classification.get(dataset)
    expected = sorted(known.pii) if known else []
    unexpected = sorted(set(found) - set(expected))
    missing = bool(found) and known is None
    return {
        "dataset_name": dataset,
        "classification": known.level if known else "unclassified",
        "expected_pii_columns": ";".join(expected),
        "detected_pii_columns": ";".join(found),
        "unexpected_pii_columns": ";".join(unexpected),
        "missing_classification": missing,
        "status": "failed" if unexpected or missing else "passed",
    }


def scan_tables(
    tables: dict[str, DataFrame], classification: dict[str, Classification] | None = None,
    sample_rows: int | None = None,
) -> DataFrame:
    """Scan report per table: name findings, classification and the kinds of values found."""
    classification = CLASSIFICATION if classification is None else classification
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame(
        [tuple(scan_names(n, data_columns(t), classification).values()) for n, t in tables.items()],
        "dataset_name string, classification string, expected_pii_columns string, "
        "detected_pii_columns string, unexpected_pii_columns string, "
        "missing_classification boolean, status string")
    hits = reduce(DataFrame.unionByName, [scan_values(t, n, sample_rows=sample_rows) for n, t in tables.items()])
    # at most (columns x kinds) entries per table
    kinds = hits.groupBy("dataset_name").agg(F.array_join(F.array_sort(F.collect_set(
        F.concat_ws(":", "column_name", "value_type"))), ";").alias("detected_value_types"))
    return names.join(kinds, "dataset_name", "left").fillna("", subset=["detected_value_types"])


def recommended_control(level):
    choice = None
    for name, control in CONTROLS.items():
        choice = F.when(level == name, control) if choice is None else choice.when(level == name, control)
    return choice.otherwise(DEFAULT_CONTROL)


def classification_table(spark, classification: dict[str, Classification] | None = None) -> DataFrame:
    table = CLASSIFICATION if classification is None else classification
    return spark.createDataFrame(
        [(n, c.level, ", ".join(c.pii), ", ".join(c.sensitive), c.retention, c.access) for n, c in table.items()],
        "dataset_name string, classification string, pii_columns string, sensitive_columns string, "
        "retention_policy string, access_policy string")


def access_policy(classified: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """Recommended control per table; with ``findings`` also the columns that were detected."""
    rows = classified.withColumn("recommended_control", recommended_control(F.col("classification")))
    if findings is None:
        return rows
    return rows.join(
        findings.select("dataset_name", "detected_pii_columns", F.col("status").alias("scan_status")),
        "dataset_name", "left")
