"""CSV and Parquet connectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.plans.cleaning import ORDINAL
from starmart.schemas import CLEAN, DATE_YEAR, PARTITION_DATE, RAW, STAR, Contract
from starmart.session import releasing


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A headered raw CSV, one file or a folder of them, with an explicit schema and an ingest ordinal.

    Spark deals large files out in splits and packs small ones together, largest
    first, so a task's number says nothing about the order of files. The ordinal
    is (file, start of the split, place among the task's rows): files by name,
    rows of a file from its first line to its last, whatever the tasks were.
    """
    df = spark.read.csv(f"{folder}/{name}_raw.csv", schema=RAW[name], header=True, mode="PERMISSIVE", escape='"')
    place = F.monotonically_increasing_id()  # ascends in a task, which reads a split from front to back
    ordinal = F.struct(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"), place.alias("place")
    )
    return df.select("*", ordinal.alias(ORDINAL))


def read_clean(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A cleaned Parquet table, contract columns only."""
    return spark.read.parquet(f"{folder}/{name}").select(*CLEAN[name].fields)


def read_clean_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A cleaned CSV, dates and timestamps parsed by the contract's schema."""
    return spark.read.csv(path, schema=CLEAN[name].ddl, header=True, escape='"')


def star_path(folder: str, name: str) -> str:
    """Where a star table is stored. Bookings lie apart by outcome; those in the fact are the loaded ones."""
    return f"{folder}/{name}/outcome=loaded" if name == "FactBookings" else f"{folder}/{name}"


def read_star(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored star table; dated facts keep the year column their folders are named by."""
    layout = [DATE_YEAR] if name in PARTITION_DATE else []
    return spark.read.parquet(star_path(folder, name)).select(*STAR[name].fields, *layout)


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Overwrite a Parquet table.

    With partition columns the rows are rebalanced on them: AQE sizes the tasks
    by bytes and splits a year that holds most of the data over many of them.
    """
    with releasing(df.sparkSession):
        if partition_by:
            dealt = df.hint("rebalance", *map(F.col, partition_by))
            dealt.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression="zstd")
        else:
            df.write.mode("overwrite").parquet(path, compression="zstd")


def write_csv(df: DataFrame, path: str, single: bool = False, compression: str = "none") -> None:
    """Overwrite a headered CSV folder; ``single`` only for results of bounded size."""
    out = df.coalesce(1) if single else df
    with releasing(df.sparkSession):
        out.write.mode("overwrite").csv(
            path,
            header=True,
            emptyValue="",
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            compression=compression,
        )


def append_log(log: DataFrame, path: str, run_id: str) -> None:
    """Append a run's quality-log rows."""
    log.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns of the contract, in its order and types."""
    return df.select(*[F.col(c).cast(f.type).alias(c) for c, f in contract.fields.items()])
