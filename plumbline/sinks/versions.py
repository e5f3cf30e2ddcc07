"""Partitioned tables with versions, without a table format.

    path/data/commit_id=<id>/<partition>=<value>/...   files, written once and never changed
    path/manifest/commit_id=<id>/                      which folder each partition of a version is read from
    path/log/                                          one row a version; the highest number is the current one

A change stages its files in a folder of its own, writes the manifest, and becomes visible with a single small file in the log. Until
then readers see the old version, so a job that fails halfway leaves nothing but an unreferenced folder. Partitions that a change does
not name keep their files. Only partition values and folder names reach the driver, as with any file listing.

One writer a table is expected. Two that publish the same version are noticed: the smaller commit id wins, the other raises.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.sinks.lake import read_if_there

LOG = "version int, commit_id string, base int, table_schema string, inputs map<string,int>"
COMMIT = "commit_id"

# What Spark writes for a null partition value, and the characters it escapes in a folder name.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}


class ConcurrentPublish(RuntimeError):
    """Another writer published the same version first."""


def folder_text(value: str | None) -> str:
    """A partition value as it stands in a folder name."""
    if value is None or value == "":
        return NULL_FOLDER
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


class VersionedTable:
    """A table at ``path``, partitioned by the columns ``by`` (none: each change replaces the whole table)."""

    def __init__(self, spark: SparkSession, path: str, by: tuple[str, ...] = ()):
        self.spark, self.path, self.by = spark, path.rstrip("/"), tuple(by)

    # -- versions ---------------------------------------------------------------------------

    def log(self) -> DataFrame:
        schema = T.StructType.fromDDL(LOG)
        found = read_if_there(self.spark, f"{self.path}/log", schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def _entry(self, version: int | None = None) -> Row | None:
        rows = self.log()
        if version is not None:
            rows = rows.where(F.col("version") == version)
        return rows.orderBy(F.desc("version"), COMMIT).first()

    @property
    def version(self) -> int:
        """The current version, 0 before the first."""
        entry = self._entry()
        return entry.version if entry else 0

    def inputs(self) -> dict[str, int]:
        """The versions of other tables that the current version was made from."""
        entry = self._entry()
        return dict(entry.inputs or {}) if entry else {}

    # -- reading ----------------------------------------------------------------------------

    def _manifest_schema(self) -> T.StructType:
        return T.StructType([*[T.StructField(c, T.StringType()) for c in self.by],
                             T.StructField(COMMIT, T.StringType()), T.StructField("row_count", T.LongType())])

    def manifest(self, version: int | None = None) -> DataFrame:
        """One row a partition and folder: the partition values as text, the folder's commit and its row count."""
        return self._manifest(self._entry(version) if version != 0 else None)

    def _manifest(self, entry: Row | None) -> DataFrame:
        schema = self._manifest_schema()
        if entry is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/manifest/{entry.commit_id}")

    def _live(self, entry: Row | None) -> list[Row]:
        return self._manifest(entry).collect() if entry else []

    def read(self, version: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The rows of a version. ``only`` has some of the partition columns as text: other partitions are not even listed."""
        entry = self._entry(version)
        if entry is None:
            raise ValueError(f"no version {'' if version is None else version} of {self.path}")
        schema = T.StructType.fromJson(json.loads(entry.table_schema))
        live, wanted = self._live(entry), None
        if only is not None:
            wanted = {tuple(r) for r in only.distinct().collect()}
            live = [r for r in live if tuple(r[c] for c in only.columns) in wanted]
        paths = sorted("/".join([f"{self.path}/data/{COMMIT}={r[COMMIT]}", *[f"{c}={folder_text(r[c])}" for c in self.by]]) for r in live)
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths).select(*schema.names)
        if wanted and len(only.columns) == 1 and (None,) not in wanted:
            rows = rows.where(F.col(only.columns[0]).cast("string").isin(*sorted(r[0] for r in wanted)))
        return rows

    def changed(self, since: int, until: int | None = None) -> DataFrame:
        """Partitions (as text) whose folders differ between two versions, by their manifests alone."""
        both = self.manifest(since).unionByName(self.manifest(until))
        return both.groupBy(*self.by, COMMIT).count().where("count = 1").select(*self.by).distinct()

    # -- writing ----------------------------------------------------------------------------

    def append(self, rows: DataFrame, inputs: dict[str, int] | None = None, commit_id: str | None = None) -> int:
        """Adds rows; partitions get one more folder. Returns the new version."""
        return self._publish(rows, None, inputs, commit_id)

    def replace(self, rows: DataFrame, partitions: DataFrame | None = None, inputs: dict[str, int] | None = None, commit_id: str | None = None) -> int:
        """Puts ``rows`` in place of ``partitions`` (some partition columns, as text; None: of everything). Returns the new version.

        A named partition without rows vanishes. Rows of partitions that are not named are refused.
        """
        if partitions is None or not self.by:
            return self._publish(rows, lambda partition: True, inputs, commit_id)
        named, at = {tuple(r) for r in partitions.distinct().collect()}, [self.by.index(c) for c in partitions.columns]
        return self._publish(rows, lambda partition: tuple(partition[i] for i in at) in named, inputs, commit_id)

    def _publish(self, rows: DataFrame, replaced: Callable[[tuple], bool] | None, inputs: dict[str, int] | None, commit_id: str | None) -> int:
        """Stages ``rows`` and publishes a version without the partitions for which ``replaced`` holds (None: an addition)."""
        entry, commit_id = self._entry(), commit_id or uuid.uuid4().hex
        base = entry.version if entry else 0
        folder = f"{self.path}/data/{COMMIT}={commit_id}"
        if self.by:  # one shuffle by range of partition, so that a partition is a few files and not one a task,
            # and a large partition is cut over several tasks: the hash of the whole row splits its rows
            rows = rows.repartitionByRange(*self.by, F.xxhash64(F.to_json(F.struct(*rows.columns))))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*self.by) if self.by else writer).parquet(folder)
        own = [f for f in rows.schema.fields if f.name not in self.by]
        schema = T.StructType([*own, *[rows.schema[c] for c in self.by]])
        # counted from the file footers, as no data column is read
        staged = self.spark.read.schema(schema).parquet(folder).groupBy(*[F.col(c).cast("string").alias(c) for c in self.by]).count().collect()
        added = [(*r[:-1], commit_id, r["count"]) for r in staged]
        strange = [r[:-2] for r in added if replaced and not replaced(r[:-2])]
        if strange:
            raise ValueError(f"rows of a partition that is not replaced: {strange[0]}")
        old = [tuple(r) for r in self._live(entry)]
        live = [r for r in old if not (replaced and replaced(r[:-2]))] + added
        self.spark.createDataFrame(live, self._manifest_schema()).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{commit_id}")
        entry_row = [(base + 1, commit_id, base, schema.json(), inputs or {})]
        self.spark.createDataFrame(entry_row, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        if self._entry(base + 1).commit_id != commit_id:
            raise ConcurrentPublish(f"version {base + 1} of {self.path} was published by another writer")
        return base + 1
