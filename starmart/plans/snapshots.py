"""Versioned tables: a refresh writes a new version and publishes it when it is whole.

A version is a folder of its own and is never changed. The pointer is a table of
publications beside the versions, to which a refresh appends one row once its
data are complete; that row becomes visible at once or not at all, and readers
follow the newest one. A refresh that dies publishes nothing, so readers keep
the version before. Readers that began on an older version finish on it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PUBLICATIONS = "number BIGINT, version STRING, rows BIGINT, published_at TIMESTAMP"


def publish(df: DataFrame, path: str) -> str:
    """Store ``df`` as the newest version; returns its name."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    df.write.parquet(folder)
    rows = spark.read.parquet(folder).count()
    newest = versions(spark, path).agg(F.max("number")).first()[0]
    row = spark.createDataFrame([((newest or 0) + 1, version, rows, None)], PUBLICATIONS)
    row.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/published")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """All publications: number, version, rows, published_at; none before the first."""
    # A version in the making leaves no trace here, so the folder may be missing.
    location = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    if not location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location):
        return spark.createDataFrame([], PUBLICATIONS)
    return spark.read.schema(PUBLICATIONS).parquet(f"{path}/published")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version; two published at the same time count by their time and name."""
    newest = versions(spark, path).agg(F.max_by("version", F.struct("number", "published_at", "version"))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"nothing has been published at {path}")
    return spark.read.parquet(f"{path}/versions/{newest}")
