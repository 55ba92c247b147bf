"""Session helpers: a local builder for tests and reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's switch for dropping a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and ``bench.py``; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("seedloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master; on a cluster a missing
    shared folder is an error, because executors cannot read each other's disks.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="seedloom-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table: cuts lineage, survives lost executors.

    Shuffle files of the query that made it are dropped at its end: the table replaces them.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Respread an input too small to fill the cluster before heavy work in tasks.

    Judged by the planner's size estimate, without running anything. An input with at
    least one full split per core keeps its partitions, so large data is never shuffled
    for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    split = 128 * 1024 * 1024
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores, key) if int(estimate) < cores * split else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Broadcast a narrow table once its row count has been checked; larger ones stay as they are."""
    rows = df.limit(limit + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= limit else df
