"""Lake layers as partitioned Parquet or JSON, load log and manifests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.dedupe import REASON

# Layers, and the columns of the load log.
LAYERS = ("bronze", "silver", "gold")
LOAD_LOG_COLUMNS = [
    "batch_id", "source_system", "load_time", "file_name", "row_count", "rejected_count",
    "schema_version", "load_status", "layer",
]
LOAD_LOG_SCHEMA = (
    "batch_id string, source_system string, load_time string, file_name string, row_count bigint, "
    "rejected_count bigint, schema_version int, load_status string, layer string"
)
MANIFEST_SCHEMA = (
    "layer string, dataset_name string, row_count bigint, output_path string, status string, message string"
)


@dataclass
class WriteResult:
    layer: str
    dataset_name: str
    row_count: int
    output_path: str
    status: str
    message: str


def partition_value(value: str) -> str:
    """Safe folder text: trimmed, blanks and slashes as underscore, ``unknown`` when empty."""
    return value.strip().replace(" ", "_").replace("/", "_") or "unknown"


def partition_column(column: Column) -> Column:
    """The same rule for a column of partition values."""
    text = F.regexp_replace(F.btrim(column.cast("string"), F.lit(" \t\n\r\x0b\x0c")), "[ /]", "_")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("unknown"))


def partition_path(root: str, layer: str, name: str | None, load_date: str, batch_id: str | None = None) -> str:
    if layer not in LAYERS:
        raise ValueError(f"no such layer: {layer} (one of {', '.join(LAYERS)})")
    if not name:
        raise ValueError(f"a path of layer {layer} needs the name of its {'source' if layer == 'bronze' else 'dataset'}")
    label = "source_system" if layer == "bronze" else "dataset"
    path = f"{root}/{layer}/{label}={partition_value(name)}/load_date={partition_value(load_date)}"
    return f"{path}/batch_id={partition_value(batch_id)}" if batch_id else path


def counted_write(df: DataFrame, write) -> int:
    """Runs ``write(df)`` and returns its row count, taken during the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return int(seen.get.get("n") or 0)


def write_layer(
    df: DataFrame, root: str, layer: str, name: str, load_date: str, batch_id: str | None = None
) -> WriteResult:
    """One dataset of one load as Parquet, counted while it is written.

    An empty frame counts as skipped: its path then holds a schema and no rows, so that a rerun leaves no old ones.
    """
    path = partition_path(root, layer, name, load_date, batch_id)
    rows = counted_write(df, lambda frame: frame.write.mode("overwrite").parquet(path)) if df.columns else 0
    if not rows:
        return WriteResult(layer, name, 0, path, "skipped", "No records to write.")
    return WriteResult(layer, name, rows, path, "written", "Partitioned Parquet file written.")


def manifest(spark: SparkSession, results: list[WriteResult]) -> DataFrame:
    return spark.createDataFrame([tuple(vars(r).values()) for r in results], MANIFEST_SCHEMA)


def manifest_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count_if(F.col("status") == "written").alias("written_count"),
        F.count_if(F.col("status") == "skipped").alias("skipped_count"))


def read_layer(spark: SparkSession, root: str, layer: str, name: str | None = None) -> DataFrame:
    """A lake layer with its partition columns; ``name`` narrows to one source or dataset."""
    label = "source_system" if layer == "bronze" else "dataset"
    base = f"{root}/{layer}"
    reader = spark.read.option("basePath", base).option("mergeSchema", True)
    return reader.parquet(f"{base}/{label}={partition_value(name)}" if name else base)


def write_bronze(df: DataFrame, path: str, ingest_date: str, batch_id: str, kind: str = "parquet") -> int:
    """Bronze rows partitioned by source, date and batch; a rerun of a batch replaces it."""
    placed = df.withColumns({
        "source_system": partition_column(F.col("_source_system")),
        "ingest_date": F.lit(partition_value(ingest_date)), "batch_id": F.lit(partition_value(batch_id))})

    def write(frame: DataFrame) -> None:
        (
            frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_system", "ingest_date", "batch_id").format(kind).save(path)
        )

    return counted_write(placed, write)


def clear_bronze(empty: DataFrame, path: str, source: str, ingest_date: str, batch_id: str) -> None:
    """Leaves a source's part of a batch without rows, whatever an earlier run of the batch wrote there."""
    parts = (f"source_system={partition_value(source)}", f"ingest_date={partition_value(ingest_date)}",
             f"batch_id={partition_value(batch_id)}")
    empty.write.mode("overwrite").parquet("/".join([path, *parts]))


def write_sorted_csv(df: DataFrame, path: str) -> None:
    """Headed CSV with columns in name order."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("header", True).csv(path)


def append_load_log(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Appends load rows; columns that are not part of the log are dropped."""
    data = [tuple(row.get(column) for column in LOAD_LOG_COLUMNS) for row in rows]
    spark.createDataFrame(data, LOAD_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_log_entries(counts: DataFrame, batch_id: str, load_time: str, layer: str) -> DataFrame:
    """Load-log rows from counts per (source_system, file_name), without leaving Spark."""
    have = set(counts.columns)
    return counts.select(
        F.lit(batch_id).alias("batch_id"), "source_system", F.lit(load_time).alias("load_time"),
        "file_name", "row_count",
        (F.col("rejected_count") if "rejected_count" in have else F.lit(0)).cast("bigint").alias("rejected_count"),
        (F.col("schema_version") if "schema_version" in have else F.lit(None)).cast("int").alias("schema_version"),
        F.lit("loaded").alias("load_status"), F.lit(layer).alias("layer"))


def write_rejects(df: DataFrame, path: str, dataset: str, batch_id: str) -> int:
    """Rejected rows of one batch as JSON lines; a rerun without rejects leaves the batch's folder without rows."""
    rejects = df.where(F.col(REASON).isNotNull())
    folder = f"{path}/dataset={partition_value(dataset)}/batch_id={partition_value(batch_id)}"
    return counted_write(rejects, lambda frame: frame.write.mode("overwrite").json(folder))


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Overwrites only the partitions that ``df`` has rows for."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns).parquet(path)
    )


def truncate_and_load(df: DataFrame, table: str) -> None:
    """Replaces the content of a catalog table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def insert_if_absent(existing: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not there yet; of several with one key, the least in order of the other columns."""
    others = [column for column in new.columns if column != key]
    if others:
        fresh = new.groupBy(key).agg(F.min(F.struct(*others)).alias("__row")).select(
            *[F.col(c) if c == key else F.col(f"__row.`{c}`").alias(c) for c in new.columns])
    else:
        fresh = new.distinct()
    return fresh if existing is None else fresh.join(existing.select(key), key, "left_anti").select(*new.columns)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet table at ``path``, None when nothing is there; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_absent(spark: SparkSession, new: DataFrame, path: str, key: str) -> int:
    """Appends the rows of ``new`` whose key is not in the table at ``path``."""
    existing = read_if_there(spark, path, new.schema)
    return counted_write(insert_if_absent(existing, new, key), lambda f: f.write.mode("append").parquet(path))


def materialize(df: DataFrame, name: str, kind: str) -> None:
    """Model as view (staging, facts, dimensions) or as table (marts)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        truncate_and_load(df, name)
    else:
        raise ValueError(f"unknown materialization {kind}")
