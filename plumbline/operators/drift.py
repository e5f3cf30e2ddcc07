"""Schema inference, fingerprints, versions and drift over a history of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import SOURCES
from plumbline.functions.casts import count_when, is_blank
from plumbline.functions.infer import kind_bit, merged_type
from plumbline.functions.names import data_columns, normalized
from plumbline.operators.joins import join_null_safe
from plumbline.operators.ordered import previous, running_total, with_position

FIELD = "array<struct<name:string,data_type:string,nullable:boolean>>"


def infer_schema(
    df: DataFrame, by: list[str] | None = None, date_as_timestamp: bool = False,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Column types per group in one aggregate pass, one row per (group, column).

    ``keys`` (``by`` and key) names the columns that each group has, where that differs from the columns of the
    frame: one read from several JSON files has those of all.
    """
    by = by or []
    columns = data_columns(df)
    aggregates = []
    for column in columns:
        quoted = F.col(f"`{column}`")
        aggregates.append(F.bit_or(kind_bit(column)).alias(f"__k_{column}"))
        aggregates.append(count_when(is_blank(quoted)).alias(f"__b_{column}"))
    facts = df.groupBy(*by).agg(*aggregates)
    fields = F.array(*[
        F.struct(
            F.lit(column).alias("column_name"),
            merged_type(f"__k_{column}", date_as_timestamp).alias("data_type"),
            (F.col(f"`__b_{column}`") > 0).alias("nullable"),
        )
        for column in columns
    ])
    rows = facts.select(*by, F.explode(fields).alias("f")).select(*by, "f.*")
    if keys is None:
        return rows
    own = keys.select(*by, normalized(F.col("key")).alias("__key")).distinct()
    return join_null_safe(rows.withColumn("__key", normalized(F.col("column_name"))), own, [*by, "__key"], "left_semi").drop("__key")


def fingerprint(fields: Column) -> Column:
    """First 16 hex digits of SHA-256 over the sorted field list as JSON text."""
    texts = F.transform(F.array_sort(fields), lambda f: F.concat(
        F.lit('{"data_type": "'), f["data_type"], F.lit('", "name": "'), f["name"],
        F.lit('", "nullable": '), f["nullable"].cast("string"), F.lit("}")))
    return F.substring(F.sha2(F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]")), 256), 1, 16)


def snapshots(fields: DataFrame, by: list[str]) -> DataFrame:
    """One row per schema: its fields (as many as the file has columns) and its fingerprint."""
    packed = fields.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(
        F.col("column_name").alias("name"), "data_type", "nullable"))).alias("fields"))
    return packed.withColumn("fingerprint", fingerprint(F.col("fields")))


def _names(fields: Column) -> Column:
    return F.transform(fields, lambda f: f["name"])


def allowed_renames(df: DataFrame, renames: dict[str, dict[str, str]] | None = None) -> DataFrame:
    table = renames if renames is not None else {s.name: s.renames for s in SOURCES.values()}
    rows = [
        (source, [(new, canonical) for new, canonical in pairs.items()])
        for source, pairs in table.items()
    ]
    return df.sparkSession.createDataFrame(
        rows, "source_system string, allowed array<struct<new:string,canonical:string>>")


def compare(df: DataFrame, before: str = "previous_fields", after: str = "fields") -> DataFrame:
    """Adds drift columns to rows that hold two field lists and the renames ``allowed`` between them."""
    none = F.array().cast("array<string>")
    old, new = F.coalesce(F.col(before), F.array().cast(FIELD)), F.col(after)
    rows = df.withColumns({
        "__added": F.array_except(_names(new), _names(old)),
        "__removed": F.array_except(_names(old), _names(new)),
        "__old_types": F.map_from_arrays(_names(old), F.transform(old, lambda f: f["data_type"])),
    })
    rows = rows.withColumn("safe_renames", F.filter(
        F.coalesce(F.col("allowed"), F.array().cast("array<struct<new:string,canonical:string>>")),
        lambda r: F.array_contains("__added", r["new"]) & F.array_contains("__removed", r["canonical"])))
    rows = rows.withColumns({
        "added_columns": F.array_sort(F.array_except(
            F.col("__added"), F.coalesce(F.transform("safe_renames", lambda r: r["new"]), none))),
        "removed_columns": F.array_sort(F.array_except(
            F.col("__removed"), F.coalesce(F.transform("safe_renames", lambda r: r["canonical"]), none))),
        "type_changes": F.transform(
            F.filter(new, lambda f: F.try_element_at("__old_types", f["name"]) != f["data_type"]),
            lambda f: F.struct(
                f["name"].alias("column_name"),
                F.try_element_at("__old_types", f["name"]).alias("previous"),
                f["data_type"].alias("current"))),
    })
    breaking = (F.size("removed_columns") > 0) | (F.size("type_changes") > 0)
    first = F.col(before).isNull() | (F.size(before) == 0)
    return rows.withColumns({
        "breaking": ~first & breaking,
        "status": F.when(first, "new_schema").when(breaking, "breaking_drift")
        .when((F.size("added_columns") > 0) | (F.size("safe_renames") > 0), "compatible_evolution")
        .otherwise("unchanged"),
    }).drop("__added", "__removed", "__old_types", "allowed")


def schema_history(
    snaps: DataFrame, order: list[str], renames: dict[str, dict[str, str]] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Version and drift of each snapshot against the one before it, per ``source_system``.

    The version grows whenever the fingerprint differs from the one before. A source with a
    very long history is spread over many tasks (see ``operators.ordered``).
    """
    keys = ["source_system"]
    placed = with_position(snaps, keys, order, partitions=partitions)
    chained = previous(placed, keys, ["fields", "fingerprint"])
    chained = chained.withColumn(
        "__changed",
        F.when(F.col("fingerprint").eqNullSafe(F.col("previous_fingerprint")), 0).otherwise(1))
    versioned = running_total(chained, keys, "__changed", "current_version")
    versioned = versioned.withColumn(
        "previous_version",
        F.when(F.col("_n") > 1, F.col("current_version") - F.col("__changed")))
    allowed = allowed_renames(snaps, renames)
    return compare(versioned.join(allowed, "source_system", "left")).drop("__changed", "_n")


def latest_schema(history: DataFrame, order: str) -> DataFrame:
    """Newest registered schema per source."""
    newest = F.max(F.struct(F.col(order), "current_version", "fingerprint", "fields"))
    return history.groupBy("source_system").agg(newest.alias("s")).select("source_system", "s.*")
