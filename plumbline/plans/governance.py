"""Lineage edges, catalog checks, control coverage, storage cost, artifact audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import CATALOG, CATALOG_FIELDS, CLASSIFICATION
from plumbline.functions.casts import is_blank

# Fields a catalog entry must fill, and the storage price per GiB and month.
CATALOG_REQUIRED = (
    "dataset_name", "layer", "owner", "source_system", "business_description", "downstream_usage",
    "refresh_frequency", "criticality_tier",
)
USD_PER_GIB_MONTH = 0.023


# -- lineage --------------------------------------------------------------------------------

def lineage_edges(events: DataFrame) -> DataFrame:
    """Distinct edges input -> job and job -> output, from events with array columns.

    ``events``: run_id, job_name, inputs and outputs (arrays of names).
    """
    incoming = events.select("run_id", "job_name", F.explode("inputs").alias("name")).select(
        "run_id", F.col("name").alias("source"), F.col("job_name").alias("target"),
        F.lit("input_to_job").alias("relationship"))
    outgoing = events.select("run_id", "job_name", F.explode("outputs").alias("name")).select(
        "run_id", F.col("job_name").alias("source"), F.col("name").alias("target"),
        F.lit("job_to_output").alias("relationship"))
    return incoming.unionByName(outgoing).distinct()


def lineage_nodes(events: DataFrame) -> DataFrame:
    """Distinct nodes; a name that is both is a dataset."""
    jobs = events.select("run_id", F.col("job_name").alias("id"), F.lit("job").alias("type"))
    names = events.select(
        "run_id", F.explode(F.concat("inputs", "outputs")).alias("id"), F.lit("dataset").alias("type"))
    return jobs.unionByName(names).groupBy("run_id", "id").agg(F.min("type").alias("type"))


def lineage_counts(events: DataFrame) -> DataFrame:
    """Node and edge counts per run."""
    nodes = lineage_nodes(events).groupBy("run_id").agg(F.count(F.lit(1)).alias("node_count"))
    edges = lineage_edges(events).groupBy("run_id").agg(F.count(F.lit(1)).alias("edge_count"))
    return nodes.join(edges, "run_id", "left").fillna(0, ["edge_count"])


def event_arrays(events: DataFrame) -> DataFrame:
    """Flattens lineage events (job struct, run struct, name structs) to name arrays."""
    return events.select(
        F.col("run.runId").alias("run_id"), F.col("job.name").alias("job_name"),
        F.transform("inputs", lambda d: d["name"]).alias("inputs"),
        F.transform("outputs", lambda d: d["name"]).alias("outputs"))


# -- catalog --------------------------------------------------------------------------------

def catalog_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOG, ", ".join(f"{name} string" for name in CATALOG_FIELDS))


def refresh_catalog(catalog: DataFrame, updates: DataFrame) -> DataFrame:
    """Catalog entries with the last refresh and readiness of their dataset."""
    return catalog.join(
        updates.select("dataset_name", "last_refresh", "readiness_status"), "dataset_name", "left")


def catalog_entry_checks(catalog: DataFrame) -> DataFrame:
    """Required fields each entry leaves blank."""
    missing = F.array_compact(F.array(*[
        F.when(is_blank(F.col(name)), F.lit(name)) for name in CATALOG_REQUIRED]))
    return catalog.select("dataset_name", missing.alias("missing_fields")).withColumn(
        "status", F.when(F.size("missing_fields") > 0, "failed").otherwise("passed"))


def uncatalogued(datasets: DataFrame, catalog: DataFrame) -> DataFrame:
    """Gold datasets without a catalog entry."""
    return datasets.select("dataset_name").distinct().join(catalog, "dataset_name", "left_anti")


def catalog_status(datasets: DataFrame, catalog: DataFrame) -> DataFrame:
    entries = catalog_entry_checks(catalog).agg(
        F.count(F.lit(1)).alias("catalog_entry_count"),
        F.count_if(F.col("status") == "failed").alias("failed_entry_count"), F.lit(1).alias("one"))
    absent = uncatalogued(datasets, catalog).agg(
        F.count(F.lit(1)).alias("missing_entry_count"), F.lit(1).alias("one"))
    return entries.join(absent, "one").drop("one").withColumn(
        "status", F.when(F.col("failed_entry_count") + F.col("missing_entry_count") > 0, "failed")
        .otherwise("passed"))


# -- control coverage -----------------------------------------------------------------------

SOURCE_CONTROLS = ("source_contract", "schema_registry", "quality_report", "catalog",
                   "pii_classification", "slo_report")
GOLD_CONTROLS = ("catalog", "pii_classification", "semantic_validation", "reconciliation",
                 "certification", "release_gate", "audit_manifest")


def control_matrix(sources: DataFrame, gold: DataFrame) -> DataFrame:
    """Source rows and gold rows in one matrix; a control that does not apply stays NULL."""
    left = sources.select("entity", F.lit("source").alias("entity_type"), *SOURCE_CONTROLS)
    right = gold.select("entity", F.lit("gold_dataset").alias("entity_type"), *GOLD_CONTROLS)
    return left.unionByName(right, allowMissingColumns=True)


def derived_controls(entities: DataFrame, evidence: dict[str, DataFrame]) -> DataFrame:
    """The control matrix of ``entities`` (entity, entity_type) from the tables that prove each control.

    ``evidence`` maps a control to a table with ``entity``: an entity is covered if the table has a row of it, and a row whose entity
    is NULL stands for all (a report on the whole run). Every table gives one bit, and one aggregate gathers them; a control
    without a table, or whose table is empty, is missing everywhere.
    """
    controls = list(dict.fromkeys([*SOURCE_CONTROLS, *GOLD_CONTROLS]))
    none = entities.sparkSession.createDataFrame([], "entity string, bit bigint")
    bits = reduce(DataFrame.unionByName, [
        rows.select(F.col("entity").cast("string").alias("entity"), F.lit(1 << controls.index(name)).cast("bigint").alias("bit"))
        for name, rows in evidence.items()], none)
    found = bits.groupBy("entity").agg(F.bit_or("bit").alias("bits"))
    everyone = found.where("entity is null").agg(F.coalesce(F.max("bits"), F.lit(0)).alias("bits"))
    own = entities.select("entity", "entity_type").distinct().join(found.where("entity is not null"), "entity", "left")
    own = own.withColumn("bits", F.coalesce("bits", F.lit(0)).bitwiseOR(everyone.scalar()))
    applies = {"source": SOURCE_CONTROLS, "gold_dataset": GOLD_CONTROLS}
    return own.select("entity", "entity_type", *[
        F.when(F.col("entity_type").isin([kind for kind, names in applies.items() if name in names]),
               F.col("bits").bitwiseAND(F.lit(1 << k).cast("bigint")) != 0).alias(name)
        for k, name in enumerate(controls)])


def classified(spark: SparkSession) -> DataFrame:
    """Entities with a classification of their personal data; that of a silver table counts for its source too."""
    names = {name.removeprefix(prefix) for name in CLASSIFICATION for prefix in ("", "silver_")}
    return spark.createDataFrame([(name,) for name in sorted(names)], "entity string")


def control_lists(matrix: DataFrame) -> DataFrame:
    """Covered and missing controls of each entity as sorted lists."""
    controls = [c for c in matrix.columns if c not in ("entity", "entity_type")]

    def names(wanted: bool) -> Column:
        return F.array_join(F.array_sort(F.array_compact(F.array(*[
            F.when(F.col(c) == F.lit(wanted), F.lit(c)) for c in controls]))), ", ")

    return matrix.select(
        "entity", "entity_type", names(True).alias("covered_controls"), names(False).alias("missing_controls"))


def control_coverage(matrix: DataFrame) -> DataFrame:
    """Share of applicable controls that are in place."""
    controls = [c for c in matrix.columns if c not in ("entity", "entity_type")]
    flags = matrix.select("entity_type", F.explode(F.array(*[F.col(c) for c in controls])).alias("on"))
    covered, total = F.count_if("on"), F.count("on")
    return matrix.agg(
        F.count_if(F.col("entity_type") == "source").alias("source_count"),
        F.count_if(F.col("entity_type") == "gold_dataset").alias("gold_dataset_count"),
        F.lit(1).alias("one"),
    ).join(flags.agg(
        covered.alias("covered_count"), total.alias("flag_count"),
        F.when(total > 0, F.round(covered / total, 4)).otherwise(F.lit(0.0)).alias("control_coverage_pct"),
        F.lit(1).alias("one"),
    ), "one").drop("one")


# -- storage and artifacts ------------------------------------------------------------------

def file_sizes(spark: SparkSession, layer: str, path: str) -> DataFrame:
    """Path and length of every file of a layer; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(F.lit(layer).alias("layer"), "path", "length")
    )


def storage_cost(sizes: DataFrame, usd_per_gib: float = USD_PER_GIB_MONTH) -> DataFrame:
    """Files, bytes and monthly price per layer."""
    return sizes.groupBy("layer").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("size_bytes"),
    ).withColumns({
        "size_mb": F.round(F.col("size_bytes") / float(1 << 20), 4),
        "monthly_cost_usd": F.round(F.col("size_bytes") / float(1 << 30) * usd_per_gib, 6),
    })


def audit_files(spark: SparkSession, path: str, glob: str = "*.{csv,json,jsonl,md,prom}") -> DataFrame:
    """Size and SHA-256 of every report artifact below ``path``.

    Meant for reports, which fit in a task. Tables are audited by content with
    ``operators.profile.table_fingerprint``.
    """
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=glob).load(path)
        .select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    )


def audit_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows per CSV (header left out) or JSONL (blank lines left out) file below ``path``."""
    if kind == "csv":
        rows = spark.read.schema("c string").options(
            header=True, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.csv").csv(path)
    else:
        rows = spark.read.options(recursiveFileLookup=True, pathGlobFilter=f"*.{kind}").text(path)
        rows = rows.where(F.trim("value") != "")
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"))


def run_summary(load_log: DataFrame) -> DataFrame:
    """Rows and rejects per layer and dataset of a run."""
    return load_log.groupBy("run_id", "layer", "dataset").agg(
        F.sum("row_count").alias("row_count"), F.sum("rejected_count").alias("rejected_count"),
        F.count(F.lit(1)).alias("loads"))


def slowest_steps(steps: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` slowest steps of each run; map tasks keep only their own top ``n``."""
    from pyspark.sql import Window

    order = Window.partitionBy("run_id").orderBy(F.desc("duration_seconds"), "step_name")
    return steps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
