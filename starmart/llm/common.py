"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import shared_path

#: A side is sent to every executor only when a count shows at most so many narrow rows (a few dozen bytes each).
BROADCAST_ROWS = 1_000_000

#: A-Z to a-z and nothing else: other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else unchanged, so that both sides shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes of an Arrow batch, about. Two copies of a batch outside the heap and one in the Python worker stand at a time
#: for every task, so long rows in batches of a count of rows alone take hundreds of MB of an executor.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's rows go to Python in batches of bounded size; changes no result."""
    spark.conf.set(BATCH, str(BATCH_BYTES))


#: Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: read more than once, computed once.

    What reads on starts from the table, so the shuffle files behind it go as soon as it is written.
    """
    path = shared_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that no model may learn from; a row without an id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """What tells rows apart for a verdict on the text: equal id and text get the same verdict."""
    return [F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_h1"), F.crc32(F.col(text).cast("binary")).alias("_h2")]


def without_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` less the rows whose ``row_key()`` is in ``keys``; columns and order of columns stay.

    The rejected keys go to every executor only if a count shows that they are few; else both sides shuffle.
    """
    named = docs.select(F.struct("*").alias("_doc"), *row_key())
    keys = keys.toDF("_rid", "_rh1", "_rh2")
    match = (
        F.col("_id").eqNullSafe(F.col("_rid"))
        & F.col("_h1").eqNullSafe(F.col("_rh1"))
        & F.col("_h2").eqNullSafe(F.col("_rh2"))
    )
    kept = named.join(small(keys), match, "left_anti")
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
