"""Silver and gold that outlive a run: loaded batch by batch, refreshed and replayed by what changed.

Bronze is partitioned by source, date and batch. Silver has a versioned table a source, partitioned by batch and period (a month,
unless ``grain`` says otherwise); gold has one a mart. A mart with a day column is partitioned by period too, and remembers the silver versions it
was made from: a refresh compares manifests, recomputes the periods that changed and leaves all others as the files they are. Late rows therefore
cost their own periods, however old. Marts over all time are recomputed whole.

``replay`` takes batches through the silver rules again, from bronze, and refreshes what depends on them. A job that fails leaves the old
versions in place and can be started again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import SOURCES
from plumbline.operators.dedupe import REASON
from plumbline.operators.incremental import replay_manifest, replay_slice
from plumbline.operators.standardize import standardize
from plumbline.plans import marts
from plumbline.sinks import lake
from plumbline.sinks.versions import COMMIT, VersionedTable
from plumbline.sources import landing

# The time of a row, by source; products have none.
TIME_OF = {
    "ecommerce_transactions": "order_ts", "marketing_campaigns": "campaign_date", "customer_behavior": "event_ts",
    "operational_logs": "event_ts", "targets_planning": "target_date", "crm_support": "created_ts",
}
WITHOUT_TIME = "all"


@dataclass(frozen=True)
class Mart:
    """How a mart is built from silver, and its day column if its days stand for themselves."""

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    day: str | None = None


MARTS = {
    "gold_revenue_analytics": Mart(("ecommerce_transactions", "targets_planning"), marts.gold_revenue_analytics, "order_date"),
    "gold_target_vs_actual": Mart(
        ("ecommerce_transactions", "targets_planning"),
        lambda orders, targets: marts.gold_target_vs_actual(marts.gold_revenue_analytics(orders, targets)), "target_date"),
    "gold_customer_analytics": Mart(("ecommerce_transactions", "customer_behavior", "crm_support"), marts.gold_customer_analytics),
    "gold_marketing_attribution": Mart(("ecommerce_transactions", "marketing_campaigns"), marts.gold_marketing_attribution),
    "gold_product_performance": Mart(("product_catalog", "ecommerce_transactions"), marts.gold_product_performance),
    "gold_operational_metrics": Mart(("operational_logs",), marts.gold_operational_metrics),
}
BRONZE_PARTITION = "source_system string, ingest_date string, batch_id string"


class History:
    """The lasting tables below ``root``; bronze is ``root/bronze`` as a run writes it."""

    def __init__(self, spark: SparkSession, root: str, grain: str = "yyyy-MM", order: list[str] | None = None):
        self.spark, self.root, self.grain = spark, root.rstrip("/"), grain
        self.order = order or landing.FILE_ORDER

    def silver(self, source: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/history/silver_{source}", ("batch_id", "period"))

    def rejected(self, source: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/history/rejected_{source}", ("batch_id",))

    def gold(self, mart: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/history/{mart}", ("period",) if MARTS[mart].day else ())

    def period(self, time: str | None) -> Column:
        return F.lit(WITHOUT_TIME) if time is None else F.date_format(F.col(time), self.grain)

    # -- silver -----------------------------------------------------------------------------

    def load(self, source: str, bronze: DataFrame, batch_id: str) -> int:
        """One batch through the silver rules; its rows of an earlier load are replaced. Returns the silver version."""
        batch = lake.partition_value(batch_id)
        marked_path = f"{self.root}/history/marked/source_system={lake.partition_value(source)}/batch_id={batch}"
        standardize(bronze, source, self.order).write.mode("overwrite").parquet(marked_path)
        marked = self.spark.read.parquet(marked_path).withColumn("batch_id", F.lit(batch))
        own = self.spark.createDataFrame([(batch,)], "batch_id string")
        self.rejected(source).replace(marked.where(F.col(REASON).isNotNull()), own)
        good = marked.where(F.col(REASON).isNull()).drop(REASON).withColumn("period", self.period(TIME_OF.get(source)))
        return self.silver(source).replace(good, own)

    def rows(self, source: str, version: int | None = None, periods: DataFrame | None = None) -> DataFrame:
        """Silver rows as the marts take them; ``periods`` are the only ones whose files are read."""
        if version == 0:
            return standardize(landing.empty_rows(self.spark, SOURCES[source]), source, landing.FILE_ORDER).drop(REASON)
        return self.silver(source).read(version, periods).drop("batch_id", "period")

    # -- gold -------------------------------------------------------------------------------

    def changed_periods(self, mart: str) -> tuple[dict[str, int], DataFrame | None]:
        """Silver versions of now, and the periods that differ from those the mart was made from (None: nothing new)."""
        known = self.gold(mart).inputs()
        now = {source: self.silver(source).version for source in MARTS[mart].inputs}
        stale = [source for source in now if known.get(source, 0) != now[source]]
        if not stale:
            return now, None
        parts = [self.silver(s).changed(known.get(s, 0), now[s]).select("period") for s in stale]
        return now, reduce(DataFrame.unionByName, parts).distinct()

    def refresh(self, mart: str) -> int:
        """Brings a mart up to date with silver. Returns its version, the old one if nothing has changed."""
        spec, table = MARTS[mart], self.gold(mart)
        now, periods = self.changed_periods(mart)
        if periods is None:
            return table.version
        if spec.day is None:
            return table.replace(spec.build(*[self.rows(s, v) for s, v in now.items()]), inputs=now)
        fresh = spec.build(*[self.rows(s, v, periods) for s, v in now.items()])
        return table.replace(fresh.withColumn("period", self.period(spec.day)), periods, now)

    def refresh_all(self, source: str | None = None) -> dict[str, int]:
        """All marts, or those that one source feeds."""
        return {mart: self.refresh(mart) for mart, spec in MARTS.items() if source is None or source in spec.inputs}

    # -- replay -----------------------------------------------------------------------------

    def bronze(self) -> DataFrame:
        """Bronze by its partition columns alone, as text: ids such as 0001 are not numbers."""
        return self.spark.read.schema(BRONZE_PARTITION).parquet(f"{self.root}/bronze")

    def load_bronze(self, source: str, ingest_date: str | None = None, batch_id: str | None = None) -> list[str]:
        """Loads the bronze batches of a source that fit; a batch is read from its own folder, with its own columns."""
        name = lake.partition_value(source)
        found = replay_manifest(replay_slice(self.bronze(), name, ingest_date, batch_id)).orderBy("ingest_date", "batch_id").collect()
        for batch in dict.fromkeys(r.batch_id for r in found):
            parts = [self.spark.read.parquet(f"{self.root}/bronze/source_system={name}/ingest_date={r.ingest_date}/batch_id={batch}")
                     for r in found if r.batch_id == batch]
            self.load(source, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), batch)
        return list(dict.fromkeys(r.batch_id for r in found))

    def replay(self, source: str, ingest_date: str | None = None, batch_id: str | None = None) -> DataFrame:
        """Takes batches through silver again and refreshes the marts that depend on them.

        Returns every partition of the tables concerned: layer, dataset_name, partition, row_count, and whether its files are new.
        """
        tables = {("silver", f"silver_{source}"): self.silver(source)}
        tables |= {("gold", mart): self.gold(mart) for mart, spec in MARTS.items() if source in spec.inputs}
        before = {key: table.version for key, table in tables.items()}
        if not self.load_bronze(source, ingest_date, batch_id):
            raise ValueError(f"no bronze batch of {source} to replay (date {ingest_date}, batch {batch_id})")
        self.refresh_all(source)
        return reduce(DataFrame.unionByName, [
            partition_changes(table, before[key]).select(F.lit(key[0]).alias("layer"), F.lit(key[1]).alias("dataset_name"), "partition", "row_count", "rewritten")
            for key, table in tables.items()])


def partition_changes(table: VersionedTable, since: int) -> DataFrame:
    """Partitions of the current version: their rows, and whether any of their files came after version ``since``."""
    named = F.concat_ws("/", *[F.coalesce(F.col(c), F.lit("null")) for c in table.by]) if table.by else F.lit("")
    old = table.manifest(since).select(COMMIT).distinct().withColumn("__old", F.lit(True))
    return table.manifest().join(old, COMMIT, "left").groupBy(named.alias("partition")).agg(
        F.sum("row_count").alias("row_count"), F.bool_or(F.col("__old").isNull()).alias("rewritten"))
