"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes, splits skewed partitions and merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # without the call-site capture per column expression, wide plans build several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "plumbline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; master and sizes come from the cluster unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    The folder named in ``spark.checkpoint.dir`` always wins. Only a local master, where
    executors share the driver's disk, gets a temporary folder when none is named.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="plumbline-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor re-reads files and not the whole plan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as compressed Parquet below the checkpoint folder and read back.

    Like ``cut_lineage``, for large frames: later steps read only the columns they use.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_cores() -> str:
    return os.environ.get("BENCH_CPUS", "8")
