"""Source contracts, evaluated for any number of files in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import SourceSpec
from plumbline.functions.casts import count_when, is_blank
from plumbline.functions.infer import COMPATIBLE, kind_bit, merged_type
from plumbline.functions.names import data_columns, normalize_name, normalized, rename_only, sources_by_target
from plumbline.operators.evidence import first_values, list_text
from plumbline.operators.joins import join_null_safe

# Action per kind of violation.
ACTIONS = {
    "required": "Quarantine the load or update the contract after source-owner approval.",
    "unexpected": "Log as additive evolution and add metadata if downstream consumers need the fields.",
    "key_null": "Reject or quarantine records without durable primary keys.",
    "key_unique": "Route duplicate records to failed-record handling before silver promotion.",
    "null": "Investigate source extract completeness and quarantine if required-field nulls spike.",
    "type": "Treat as breaking schema evolution until mapper, dbt model, and contract are reviewed.",
    "accepted": "Confirm whether values are valid business states or upstream data defects.",
    "freshness": "Confirm upstream extraction cadence and backfill missing source partitions.",
}
TOLERANT_MODES = ("backward_compatible", "fully_compatible")


def _violation(name: str, severity: str, when: Column, observed: Column, expected: str,
               message: Column, action: str, quarantine: bool = False) -> Column:
    return F.when(when, F.struct(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        observed.cast("string").alias("observed_value"), F.lit(expected).alias("expected_value"),
        message.cast("string").alias("message"), F.lit(ACTIONS[action]).alias("action"),
        F.lit(quarantine).alias("quarantine_recommended"),
    ))


def not_accepted(column: Column, allowed) -> Column:
    """Outside the set: case-insensitive, blank values pass."""
    return ~is_blank(column) & ~F.lower(column.cast("string")).isin(*[v.lower() for v in allowed])


def safe_renames(columns: list[str], spec: SourceSpec) -> dict[str, str]:
    """Contracted old names that are present, with the name they map to."""
    present = {normalize_name(column) for column in columns}
    return {old: new for old, new in spec.renames.items() if normalize_name(old) in present}


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _name_list(names: Column) -> Column:
    """Normalised names as JSON text; they hold nothing to escape."""
    return F.when(F.size(names) == 0, "[]").otherwise(F.concat(F.lit('["'), F.array_join(names, '", "'), F.lit('"]')))


def group_columns(keys: DataFrame, df: DataFrame, spec: SourceSpec, by: list[str]) -> DataFrame:
    """Per group: ``__columns`` (contracted names of its keys, sorted) and ``__renames`` (old names present -> contracted)."""
    targets = {normalize_name(part): target for target, parts in sources_by_target(df.columns, spec.renames).items() for part in parts}
    target = F.lit(None).cast("string")
    for part, name in targets.items():
        target = F.when(F.col("__raw") == part, name).otherwise(target) if part != name else target
    named = keys.select(*by, normalized(F.col("key")).alias("__raw")).where("not startswith(__raw, '_') and __raw <> ''")
    per = named.groupBy(*by).agg(
        F.array_sort(F.collect_set(F.coalesce(target, F.col("__raw")))).alias("__columns"), F.collect_set("__raw").alias("__raws"))
    old = F.array(*[F.when(F.array_contains("__raws", normalize_name(a)), F.struct(F.lit(a).alias("key"), F.lit(b).alias("value"))) for a, b in spec.renames.items()]
                  or [F.lit(None).cast("struct<key:string,value:string>")])
    return per.withColumn("__renames", F.map_from_entries(F.array_compact(old))).drop("__raws")


def _json(values) -> str:
    import json

    return json.dumps(list(values))


def contract_reports(
    df: DataFrame, spec: SourceSpec, by: list[str] | None = None, observed_at: str | None = None,
    validation_time: str | None = None, date_as_timestamp: bool = False, keys: DataFrame | None = None,
) -> DataFrame:
    """One report row per group (file) with its outcome and its violations.

    Without ``keys`` every group has the columns of ``df``. ``keys`` (``by`` and key) says which columns each group really has:
    a frame read from several JSON files has those of all of them. Counts, blank ratios, kinds of values and set checks come from one aggregate. Key
    repeats and the lists of offending values are separate key-only aggregates.
    """
    by = by or []
    rows = rename_only(df, spec.renames)
    columns = sorted(data_columns(rows))
    expected = sorted(spec.schema)
    key, hard = spec.primary_key, spec.quarantine
    blank_key = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == "" if key in columns else F.lit(True)

    aggregates = [F.count(F.lit(1)).alias("row_count"), count_when(blank_key).alias("__key_blank")]
    for column in spec.null_thresholds:
        blank = is_blank(F.col(column)) if column in columns else F.lit(True)
        aggregates.append(count_when(blank).alias(f"__null_{column}"))
    for column in spec.schema:
        if column in columns:
            aggregates.append(F.bit_or(kind_bit(column)).alias(f"__kind_{column}"))
    facts = rows.groupBy(*by).agg(*aggregates)

    facts = facts.withColumn("__one", F.lit(1))
    on = [*by, "__one"]
    empty_list = F.lit(None).cast("array<string>")
    if key in columns:
        from plumbline.operators.checks import repeated_keys

        doubled = first_values(repeated_keys(rows, key, by).withColumn("__one", F.lit(1)), on, "key")
        facts = join_null_safe(facts, doubled.withColumnsRenamed(
            {"value_list": "__dup_list", "value_count": "__dup_count"}), on)
    else:
        facts = facts.withColumn("__dup_list", empty_list).withColumn("__dup_count", F.lit(0))
    for column, allowed in spec.accepted_values.items():
        if column in columns:
            wrong = rows.where(not_accepted(F.col(column), allowed)).withColumn("__one", F.lit(1))
            facts = join_null_safe(facts, first_values(wrong, on, column).withColumnsRenamed(
                {"value_list": f"__bad_{column}", "value_count": f"__badn_{column}"}), on)

    if keys is None:
        renames = safe_renames(data_columns(df), spec)
        facts = facts.withColumns({
            "__columns": _texts(columns),
            "__renames": F.from_json(F.lit(_dict_json(renames)), "map<string,string>")})
    else:
        facts = join_null_safe(facts, group_columns(keys, df, spec, by).withColumn("__one", F.lit(1)), on)
        facts = facts.withColumn("__columns", F.coalesce("__columns", _texts([])))
    missing = F.array_except(_texts(sorted(spec.required)), F.col("__columns"))
    unexpected = F.array_except(F.col("__columns"), _texts(expected))
    found = [
        _violation(
            "required_columns_present", "critical", F.size(missing) > 0, _name_list(F.col("__columns")),
            _json(spec.required), F.concat(F.lit("Missing required columns: "), F.array_join(missing, ", ")),
            "required", hard),
        _violation(
            "unexpected_columns", "medium" if spec.compatibility in TOLERANT_MODES else "high",
            F.size(unexpected) > 0, _name_list(unexpected), _json(expected),
            F.concat(F.lit("New non-contracted columns observed: "), F.array_join(unexpected, ", ")), "unexpected"),
        _violation(
            "primary_key_not_null", "critical", F.col("__key_blank") > 0, F.col("__key_blank"), "0",
            F.concat(F.col("__key_blank"), F.lit(f" records are missing primary key {key}")),
            "key_null", hard),
        _violation(
            "primary_key_unique", "critical", F.coalesce(F.col("__dup_count"), F.lit(0)) > 0,
            F.to_json("__dup_list"), "all primary key values unique",
            F.concat(F.lit(f"Duplicate primary key values detected for {key}: "),
                     list_text(F.col("__dup_list"), F.col("__dup_count"))), "key_unique", hard),
    ]
    for column, limit in spec.null_thresholds.items():
        share = F.round(F.col(f"__null_{column}") / F.col("row_count"), 4)
        needed = column in spec.required
        found.append(_violation(
            f"null_threshold_{column}", "critical" if needed else "high",
            (F.col("row_count") > 0) & (share > limit), share, f"<= {limit}",
            F.concat(F.lit(f"{column} null ratio "), share,
                     F.lit(f" exceeded contract threshold {limit}")), "null", hard and needed))
    for column, wanted in spec.schema.items():
        if column in columns:
            seen = merged_type(f"__kind_{column}", date_as_timestamp)
            found.append(_violation(
                f"type_validation_{column}", "critical",
                F.array_contains("__columns", column) & ~seen.isin(*sorted(COMPATIBLE[wanted])),
                seen, wanted,
                F.concat(F.lit(f"{column} type changed from expected {wanted} to observed "), seen),
                "type", hard))
    for column, allowed in spec.accepted_values.items():
        if column in columns:
            found.append(_violation(
                f"accepted_values_{column}", "high",
                F.coalesce(F.col(f"__badn_{column}"), F.lit(0)) > 0, F.to_json(f"__bad_{column}"),
                _json(sorted(v.lower() for v in allowed)),
                F.concat(F.lit(f"Unexpected values in {column}: "), list_text(F.col(f"__bad_{column}"), F.col(f"__badn_{column}"))),
                "accepted"))
    if observed_at and validation_time:
        age = (
            F.unix_micros(F.lit(validation_time).cast("timestamp"))
            - F.unix_micros(F.lit(observed_at).cast("timestamp"))
        ) / 60e6
        found.append(_violation(
            "freshness_sla", "high", age > spec.freshness_minutes, F.round(age, 2),
            f"<= {spec.freshness_minutes} minutes",
            F.concat(F.lit("Source file age "), F.round(age, 2), F.lit(" minutes exceeded freshness SLA.")),
            "freshness"))

    held = F.exists("violations", lambda v: v["quarantine_recommended"])
    return (
        facts.withColumn("violations", F.array_compact(F.array(*found)))
        .select(
            *by,
            F.lit(spec.name).alias("source_system"), F.lit(spec.dataset).alias("dataset_name"),
            F.lit(spec.owner).alias("owner"), F.lit(spec.domain).alias("business_domain"),
            F.lit(spec.criticality).alias("business_criticality"),
            F.lit(spec.tier).alias("criticality_tier"),
            F.lit(spec.freshness_minutes).alias("freshness_sla_minutes"),
            F.lit(spec.compatibility).alias("schema_compatibility_mode"),
            "row_count",
            F.col("__columns").alias("observed_columns"),
            F.array(*[F.lit(c) for c in expected]).alias("expected_columns"),
            F.col("__renames").alias("safe_renames_applied"),
            F.array(*[F.lit(c) for c in spec.downstream]).alias("downstream_dependencies"),
            F.when(held, "QUARANTINE")
            .when(F.exists("violations", lambda v: v["severity"] == "critical"),
                  "QUARANTINE" if hard else "FAIL")
            .when(F.exists("violations", lambda v: v["severity"] == "high"), "FAIL")
            .when(F.size("violations") > 0, "WARNING").otherwise("PASS").alias("status"),
            F.size("violations").alias("violation_count"), "violations",
            F.lit(observed_at).alias("observed_at"), F.lit(validation_time).alias("validated_at"),
        )
    )


def offending_values(df: DataFrame, spec: SourceSpec, by: list[str] | None = None) -> DataFrame:
    """Every repeated key and every value outside its set: ``by``, check_name, value, n (its rows)."""
    from plumbline.operators.checks import repeated_keys

    by = by or []
    rows = rename_only(df, spec.renames)
    columns = set(data_columns(rows))
    wrong = [
        F.when(not_accepted(F.col(column), allowed), F.struct(
            F.lit(f"accepted_values_{column}").alias("check_name"), F.col(column).cast("string").alias("value")))
        for column, allowed in spec.accepted_values.items() if column in columns
    ]
    none = F.lit(None).cast("struct<check_name:string,value:string>")
    bad = rows.select(*by, F.explode(F.array_compact(F.array(*(wrong or [none])))).alias("bad"))
    found = bad.groupBy(*by, "bad.check_name", "bad.value").agg(F.count(F.lit(1)).alias("n"))
    if spec.primary_key in columns:
        found = found.unionByName(repeated_keys(rows, spec.primary_key, by).select(
            *by, F.lit("primary_key_unique").alias("check_name"), F.col("key").alias("value"), F.col("occurrences").alias("n")))
    return found


def _dict_json(values: dict[str, str]) -> str:
    import json

    return json.dumps(values)


def violations(reports: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per violation."""
    return reports.select(
        *(by or []), "source_system", "status", F.explode("violations").alias("v")
    ).select(*(by or []), "source_system", "status", "v.*")
