"""Quality suites, declarative expectations and model tests.

All row-wise checks of a table share one aggregate pass. A uniqueness check is its own
key-only pass: fused into the first one it would carry every other counter through the
shuffle of the keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import Suite
from plumbline.functions.casts import count_when, is_blank, number_text
from plumbline.operators.evidence import first_values

RESULT_COLUMNS = [
    "dataset_name", "row_count", "check_name", "status", "severity", "observed", "observed_value",
    "threshold", "failed_records",
]

# Check-name prefix -> rule type.
RULE_TYPES = [
    ("schema_required_columns", "schema"), ("unique_", "uniqueness"), ("null_rate_", "null"),
    ("accepted_values_", "accepted_values"), ("non_negative_", "range"),
]


def duplicate_counts(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """Surplus rows and repeated keys of ``column``; blank keys are left out.

    Grouping counts per key in the map task first, so a key with a third of the rows costs
    one partial count per task.
    """
    by = by or []
    keys = (
        df.where(~is_blank(F.col(column)))
        .groupBy(*by, F.col(column).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    )
    return keys.groupBy(*by).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("surplus_rows"),
        count_when(F.col("__n") > 1).alias("repeated_keys"),
    )


def repeated_keys(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """All keys that occur more than once, with their count."""
    by = by or []
    return (
        df.where(~is_blank(F.col(column)))
        .groupBy(*by, F.trim(F.col(column).cast("string")).alias("key"))
        .agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    )


def outside(column: str, allowed) -> Column:
    """Not one of ``allowed``: case-sensitive, NULL counts as outside."""
    return F.col(column).isNull() | ~F.col(column).isin(*allowed)


def below_zero(column: str) -> Column:
    """Negative, or no number at all."""
    value = number_text(F.col(column)).try_cast("double")
    return value.isNull() | (value < 0)


def bad_values(df: DataFrame, suite: Suite) -> DataFrame:
    """Every value outside its accepted set with its row count: the whole list, distributed."""
    pairs = [
        F.when(outside(column, allowed), F.struct(
            F.lit(f"accepted_values_{column}").alias("check_name"),
            F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("value"),
        ))
        for column, allowed in suite.accepted_values.items() if column in df.columns
    ]
    if not pairs:
        return df.sparkSession.createDataFrame([], "check_name string, value string, n bigint")
    return (
        df.select(F.explode(F.array_compact(F.array(*pairs))).alias("bad"))
        .groupBy("bad.check_name", "bad.value").agg(F.count(F.lit(1)).alias("n"))
    )


def _json(values) -> Column:
    return F.to_json(F.array(*[F.lit(v) for v in values])) if values else F.lit("[]")


def _result(name: str, severity: str, failed: Column, observed: Column, value: Column,
            threshold: Column, records: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(failed, "failed").otherwise("passed").alias("status"),
        F.lit(severity).alias("severity"),
        observed.cast("double").alias("observed"),
        value.cast("string").alias("observed_value"),
        threshold.cast("string").alias("threshold"),
        records.cast("bigint").alias("failed_records"),
    )


def validate(df: DataFrame, dataset: str, suite: Suite) -> DataFrame:
    """Check results of one table in long form (``RESULT_COLUMNS``)."""
    present = set(df.columns)
    aggregates = {"rows": F.count(F.lit(1))}
    for column in suite.null_rates:
        aggregates[f"null_{column}"] = (
            count_when(is_blank(F.col(column))) if column in present else F.count(F.lit(1)))
    for column, allowed in suite.accepted_values.items():
        aggregates[f"set_{column}"] = (
            count_when(outside(column, allowed)) if column in present else F.count(F.lit(1)))
    for column in suite.non_negative:
        aggregates[f"neg_{column}"] = (
            count_when(below_zero(column)) if column in present else F.count(F.lit(1)))
    facts = df.agg(*[expression.alias(name) for name, expression in aggregates.items()])
    for column in suite.unique:
        if column in present:  # one row each, side by side with the one row of the other counters
            surplus = duplicate_counts(df, column).select(F.col("surplus_rows").alias(f"dup_{column}"))
            facts = facts.withColumn("__one", F.lit(1)).join(
                surplus.withColumn("__one", F.lit(1)), "__one").drop("__one")
        else:
            facts = facts.withColumn(f"dup_{column}", F.lit(0))

    missing = sorted(set(suite.required) - present)
    zero = F.lit(0)
    results = [_result(
        "schema_required_columns", "critical", F.lit(bool(missing)), F.lit(len(missing)),
        _json(missing), _json(suite.required), F.col("rows") if missing else zero)]
    for column in suite.unique:
        n = F.col(f"dup_{column}")
        results.append(_result(f"unique_{column}", "critical", n > 0, n, n, zero, n))
    for column, limit in suite.null_rates.items():
        nulls = F.col(f"null_{column}")
        rate = F.when(F.col("rows") > 0, nulls / F.col("rows")).otherwise(F.lit(0.0))
        results.append(_result(
            f"null_rate_{column}", "high", rate > limit, F.round(rate, 4), F.round(rate, 4),
            F.lit(limit), nulls))
    for column, allowed in suite.accepted_values.items():
        bad = F.col(f"set_{column}")
        results.append(_result(
            f"accepted_values_{column}", "medium", bad > 0, bad, bad, _json(allowed), bad))
    for column in suite.non_negative:
        bad = F.col(f"neg_{column}")
        results.append(_result(
            f"non_negative_{column}", "high", bad > 0, bad, bad, F.lit(">= 0"), bad))
    rows = facts.select(F.col("rows").alias("row_count"), F.explode(F.array(*results)).alias("r"))
    rows = rows.select("row_count", "r.*")

    if any(column in present for column in suite.accepted_values):
        lists = first_values(bad_values(df, suite), ["check_name"], "value")
        rows = (
            rows.join(lists.select("check_name", "value_list"), "check_name", "left")
            .withColumn("observed_value", F.when(
                F.col("check_name").startswith("accepted_values_"),
                F.to_json(F.coalesce("value_list", F.array().cast("array<string>"))),
            ).otherwise(F.col("observed_value")))
            .drop("value_list")
        )
    return rows.withColumn("dataset_name", F.lit(dataset)).select(*RESULT_COLUMNS)


def validate_all(tables: dict[str, DataFrame], suites: dict[str, Suite]) -> DataFrame:
    parts = [validate(tables[name], name, suites[name]) for name in suites if name in tables]
    return reduce(DataFrame.unionByName, parts)


def rule_type(check_name: Column) -> Column:
    tagged = None
    for prefix, kind in RULE_TYPES:
        hit = check_name.startswith(prefix)
        tagged = F.when(hit, kind) if tagged is None else tagged.when(hit, kind)
    return tagged.otherwise("other")


def expect(df: DataFrame, dataset: str, expectations: list[tuple[str, str, dict]]) -> DataFrame:
    """Declarative expectations. NULLs only count against ``not_null``.

    ``mostly`` is the share of rows (of non-NULL rows for the others) that has to comply.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    checks = []
    for i, (kind, column, args) in enumerate(expectations):
        value = F.col(column)
        if kind == "not_null":
            unexpected = value.isNull()
        elif kind == "between":
            low, high = args.get("min_value"), args.get("max_value")
            unexpected = F.lit(False)
            if low is not None:
                unexpected = unexpected | (value < low)
            if high is not None:
                unexpected = unexpected | (value > high)
        elif kind == "in_set":
            unexpected = value.isNotNull() & ~value.isin(*args["value_set"])
        elif kind == "unique":
            continue
        else:
            raise ValueError(f"unknown expectation {kind}")
        base = F.count(F.lit(1)) if kind == "not_null" else F.count(value)
        aggregates += [count_when(unexpected).alias(f"u{i}"), base.alias(f"b{i}")]
        checks.append(F.struct(
            F.lit(f"{kind}_{column}").alias("check_name"),
            F.col(f"u{i}").alias("unexpected_count"), F.col(f"b{i}").alias("evaluated_count"),
            F.lit(float(args.get("mostly", 1.0))).alias("mostly"),
        ))
    facts = df.agg(*aggregates)
    rows = facts.select(F.explode(F.array(*checks)).alias("c")).select("c.*")
    for kind, column, args in expectations:
        if kind == "unique":
            filled = df.where(F.col(column).isNotNull())
            per_key = filled.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
            rows = rows.unionByName(per_key.agg(
                F.lit(f"unique_{column}").alias("check_name"),
                F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("unexpected_count"),
                F.coalesce(F.sum("__n"), F.lit(0)).alias("evaluated_count"),
                F.lit(float(args.get("mostly", 1.0))).alias("mostly"),
            ))
    share = F.when(
        F.col("evaluated_count") > 0, 1 - F.col("unexpected_count") / F.col("evaluated_count")
    ).otherwise(F.lit(1.0))
    return rows.select(
        F.lit(dataset).alias("dataset_name"), "check_name", "evaluated_count", "unexpected_count",
        "mostly", (share >= F.col("mostly")).alias("success"),
    )


def source_freshness(
    latest: DataFrame, limits: dict[str, tuple[int, int]], as_of: str
) -> DataFrame:
    """Age of the newest row per source against its warn and error hours.

    ``latest`` has ``source_system`` and ``loaded_at``; only its newest value counts.
    """
    spark = latest.sparkSession
    hours = spark.createDataFrame(
        [(source, warn, error) for source, (warn, error) in limits.items()],
        "source_system string, warn_hours int, error_hours int")
    newest = latest.groupBy("source_system").agg(F.max("loaded_at").alias("max_loaded_at"))
    moment = F.unix_timestamp(F.lit(as_of).cast("timestamp"))
    age = (moment - F.unix_timestamp(F.col("max_loaded_at").cast("timestamp"))) / 3600.0
    return hours.join(newest, "source_system", "left").select(
        "source_system", "max_loaded_at", "warn_hours", "error_hours", age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age > F.col("error_hours")), "error")
        .when(age > F.col("warn_hours"), "warn").otherwise("pass").alias("status"),
    )
