"""Spark session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys: split a skewed join partition even when that costs the next
    # aggregate one more (already pre-aggregated) exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Checkpoints are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "starmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: that of ``spark.checkpoint.dir``, else one below the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later passes see exactly the same rows and row order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


#: Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here leave no shuffle files; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: read more than once, computed once, its shuffle files gone."""
    path = shared_path(df.sparkSession, name)
    with releasing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete what was stored for a while only."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
