"""Landing files with evolving schemas: CSV, JSON, JSONL and paged API responses.

Every value is read as text; types are decided later from the values themselves.
"""

from __future__ import annotations

import urllib.parse
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.config import SourceSpec
from plumbline.functions.names import normalize_name
from plumbline.operators.dedupe import REASON, first_reason

FORMATS = {".csv": "csv", ".json": "json", ".jsonl": "jsonl"}

# Position of a row inside its file: where its split starts, then its rank in the split.
FILE_ORDER = ["_source_file", "_block_start", "_row_rank"]


@dataclass
class FileGroup:
    """Files of one format and one header, read into one frame."""

    format: str
    columns: list[str]
    paths: list[str]
    rows: DataFrame
    #: JSON only: the keys of each file, as a frame read from several files has the columns of all
    keys: DataFrame | None = None


def source_format(path: str) -> str:
    """Format by file suffix; other suffixes raise."""
    dot = path.rfind(".")
    suffix = path[dot:].lower() if dot >= 0 else ""
    if suffix not in FORMATS:
        raise ValueError(f"Unsupported source extension: {suffix or path}")
    return FORMATS[suffix]


def list_files(spark: SparkSession, glob: str) -> list[str]:
    """Paths behind a glob, sorted. Names only: no file content is read."""
    try:
        found = spark.read.format("binaryFile").load(glob).select("path")
    except AnalysisException:
        return []
    return sorted(row.path for row in found.collect())


def _head_reader():
    """Reader of first records, as a closure: it travels by value, whatever executors can import."""

    def open_stream(path: str):
        from pyarrow import fs

        if path.startswith("file:") or "://" not in path:
            return fs.LocalFileSystem().open_input_stream(path.removeprefix("file:").replace("//", "/"))
        filesystem, inner = fs.FileSystem.from_uri(path)
        return filesystem.open_input_stream(inner)

    def head(path: str) -> str:
        import csv
        import io

        kind = path.lower().rsplit(".", 1)[-1]
        if kind not in ("csv", "json"):
            return ""
        with io.TextIOWrapper(open_stream(path), encoding="utf-8-sig", newline="") as text:
            if kind == "csv":
                return "\x1f".join(next(csv.reader(text), []))
            mark = text.read(1)
            while mark and mark.isspace():
                mark = text.read(1)
            return mark

    def read_heads(batches):
        for batch in batches:
            yield batch.assign(head=[head(path) for path in batch["path"]])

    return read_heads


def file_heads(spark: SparkSession, paths: list[str]) -> dict[tuple[str, str], list[str]]:
    """(format, head) -> paths: the CSV header, or the first mark of a JSON document.

    Executors open each file once and read its first record only.
    """
    for path in paths:
        source_format(path)
    frame = spark.createDataFrame([(path,) for path in paths], "path string")
    slices = max(1, min(len(paths), spark.sparkContext.defaultParallelism))
    heads = frame.repartition(slices).mapInPandas(_head_reader(), "path string, head string").collect()
    groups: dict[tuple[str, str], list[str]] = {}
    for row in sorted(heads, key=lambda r: r.path):
        groups.setdefault((source_format(row.path), row.head), []).append(row.path)
    return groups


def _placed(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "_source_file": F.col("_metadata.file_name"),
        "_block_start": F.col("_metadata.file_block_start"),
        "_row_rank": F.monotonically_increasing_id(),
    })


def files_with_line_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """CSV files in which some line has an odd number of quotes: a value runs over lines."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = (
        spark.read.text(paths).where(quotes % 2 == 1)
        .select(F.col("_metadata.file_path").alias("p")).distinct().collect()
    )
    broken = {urllib.parse.unquote(row.p).replace("file:///", "file:/") for row in found}
    return {path for path in paths if path in broken}


def read_csv_group(
    spark: SparkSession, paths: list[str], header: list[str], line_breaks: bool = False
) -> DataFrame:
    """Files of one header. Only files with line breaks inside values are read unsplit."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=True, escape='"', multiLine=line_breaks)
    return _placed(reader.csv(paths))


def read_json_group(spark: SparkSession, paths: list[str], shape: str) -> DataFrame:
    """Whole-document JSON: a top-level array of rows, or an object holding ``records``."""
    raw = spark.read.options(multiLine=True, primitivesAsString=True).json(paths)
    if shape == "[":
        return _placed(raw)
    records = dict(raw.dtypes).get("records", "")
    if shape != "{" or not records.startswith("array<struct"):
        raise ValueError(f"Unsupported JSON shape in {paths[0]}")
    placed = _placed(raw.select("records", "_metadata"))
    return (
        placed.select(F.posexplode("records"), *FILE_ORDER)
        .withColumn("_row_rank", F.col("pos").cast("bigint"))  # one document a file
        .select("col.*", *FILE_ORDER)
    )


def read_jsonl_group(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One object per line; blank lines are skipped by the reader."""
    return _placed(spark.read.options(primitivesAsString=True).json(paths))


def json_keys(spark: SparkSession, paths: list[str], shape: str | None = None, by: tuple[str, ...] = ("_source_file",)) -> DataFrame:
    """``by`` and key: every key that some record of a file has, null values included.

    ``shape`` is the first mark of a JSON document, None for one record a line. ``by`` names the file or partition columns.
    """
    texts = spark.read.text(paths, wholetext=shape is not None).withColumn("_source_file", F.col("_metadata.file_name"))
    if shape is None:
        return texts.select(*by, F.explode(F.json_object_keys("value")).alias("key")).distinct()
    records = F.from_json("value", "array<map<string,string>>")
    if shape == "{":
        records = F.from_json("value", "struct<records:array<map<string,string>>>")["records"]
    return texts.select(*by, F.explode(records).alias("r")).select(*by, F.explode(F.map_keys("r")).alias("key")).distinct()


def read_landing(spark: SparkSession, glob: str) -> list[FileGroup]:
    """All files behind ``glob``, grouped by format and header.

    One CSV read over files with different headers would shift values into wrong columns, so
    each header gets its own read.
    """
    paths = list_files(spark, glob)
    if not paths:
        return []
    groups = []
    for (kind, head), members in sorted(file_heads(spark, paths).items(), key=lambda g: g[1][0]):
        if kind == "csv":
            if not head:
                continue
            header = head.split("\x1f")
            broken = files_with_line_breaks(spark, members)
            parts = [[m for m in members if m not in broken], [m for m in members if m in broken]]
            for part, line_breaks in zip(parts, (False, True)):
                if part:
                    rows = read_csv_group(spark, part, header, line_breaks)
                    groups.append(FileGroup(kind, header, part, rows))
            continue
        if kind == "json":
            rows, keys = read_json_group(spark, members, head), json_keys(spark, members, head)
        else:
            rows, keys = read_jsonl_group(spark, members), json_keys(spark, members)
        columns = [column for column in rows.columns if not column.startswith("_")]
        groups.append(FileGroup(kind, columns, members, rows, keys))
    return groups


def empty_rows(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Landing rows of a source that has no files: its contracted columns as text, and no rows."""
    columns = [f"`{column}` string" for column in spec.schema]
    return spark.createDataFrame([], ", ".join([*columns, "_source_file string", "_block_start bigint", "_row_rank bigint"]))


def union_groups(groups: list[FileGroup]) -> DataFrame:
    """One frame over all groups under normalised names; columns a file lacks are NULL."""
    frames = []
    for group in groups:
        renamed = group.rows.withColumnsRenamed({c: normalize_name(c) for c in group.columns})
        frames.append(renamed)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def raw_table(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Whitelist projection: contracted columns as text, missing ones NULL, others dropped."""
    names = {normalize_name(c) if not c.startswith("_") else c: c for c in df.columns}
    return df.select(*[
        (F.col(f"`{names[column]}`").cast("string") if column in names
         else F.lit(None).cast("string")).alias(column)
        for column in spec.raw_columns
    ])


def require_columns(df: DataFrame, required: set[str]) -> DataFrame:
    missing = sorted(required - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def read_silver_csv(spark: SparkSession, path: str, required: set[str]) -> DataFrame:
    """Headed CSV table that must carry ``required`` columns."""
    return require_columns(spark.read.option("header", True).csv(path), required)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small headed CSV table with declared types; a row that does not fit them raises."""
    return spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)


def read_csv_or_empty(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Headed CSV, or an empty frame of ``columns`` when the path is missing or unreadable."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    try:
        found = spark.read.option("header", True).csv(path)
        return found if found.columns else spark.createDataFrame([], schema)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def parse_tolerant_json(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """JSON lines by schema; a malformed line survives whole in ``raw_line``."""
    keeping = T.StructType([*schema.fields, T.StructField("raw_line", T.StringType())])
    parsed = lines.where(F.trim(text) != "").withColumn(
        "__row",
        F.from_json(text, keeping, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "raw_line"}),
    )
    kept = [column for column in lines.columns if column != text]
    return parsed.select(*kept, "__row.*")


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], T.StructType(
            [*schema.fields, T.StructField("raw_line", T.StringType())]))
    return parse_tolerant_json(lines, schema)


def read_rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rejected-record files under ``path``, each row tagged with its file name."""
    lines = (
        spark.read.option("recursiveFileLookup", True).text(path)
        .select("value", F.col("_metadata.file_name").alias("source_file"))
    )
    return parse_tolerant_json(lines, schema)


# What an API ticket must carry.
TICKET_REQUIRED = ("ticket_id", "customer_id", "created_ts")
TICKET_PRIORITIES = ("low", "medium", "high", "urgent")
TICKET = "ticket_id string, customer_id string, created_ts string, priority string, status string, topic string"
PAGE_SCHEMA = f"request_id string, next_page_token string, tickets array<struct<{TICKET.replace(' string', ':string')}>>"


def ticket_rows(pages: DataFrame, batch_id: str, ingested_at: str) -> DataFrame:
    """Landed API pages -> one row per ticket with ``_reject_reason`` set on invalid ones."""
    def missing(name: str):
        value = F.col(name)
        return value.isNull() | (F.trim(value) == "")

    rules = [(missing(name), f"missing required field {name}") for name in TICKET_REQUIRED]
    priority = F.lower(F.coalesce(F.col("priority"), F.lit("")))
    rules.append((~priority.isin(*TICKET_PRIORITIES), "invalid priority"))
    return (
        pages.select(F.col("request_id").alias("_api_request_id"), F.explode("tickets").alias("t"))
        .select("t.*", "_api_request_id")
        .withColumns({
            "_ingest_batch_id": F.lit(batch_id),
            "_source_system": F.lit("support_api"),
            "_ingested_at": F.lit(ingested_at),
            REASON: first_reason(rules),
        })
    )


def request_log(pages: DataFrame, ingested_at: str) -> DataFrame:
    return pages.select(
        "request_id", "next_page_token",
        F.coalesce(F.size("tickets"), F.lit(0)).alias("record_count"),
        F.lit(ingested_at).alias("ingested_at"),
    )
