"""Ranks, sequence numbers, arg-max and top-n with a remainder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import checkpointed

_PARTITION_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def top_ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """Rows with RANK() <= k inside each group; ties share a rank.

    The filter on the rank lets Spark keep only k ranks per group and task
    before the shuffle, so a group of any size is cheap.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.rank().over(w)).where(F.col(rank) <= k)


def numbered(df: DataFrame, name: str, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Add 1..n in ``order``, restarting for each ``by`` group.

    A window would sort a whole group (or, without ``by``, the whole table) in
    one task. Here the table is range-partitioned, so one group may span many
    partitions; a row's number is its place inside (partition, group) plus the
    group's rows in earlier partitions. The join that brings the two together
    is on (partition, group), so a hot group stays spread. The checkpoint fixes
    the ranges, so counts and places agree even if a task is run again.
    ``order`` must be total.
    """
    keys = [F.col(c).asc_nulls_first() for c in by]
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    at = F.monotonically_increasing_id()
    placed = checkpointed(ranged.withColumn("_at", at)).withColumn("_part", F.shiftright("_at", _PARTITION_BITS))
    runs = placed.groupBy(F.col("_part").alias("_p"), *[F.col(c).alias(f"_k_{c}") for c in by]).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    # One row per partition and group: a group's window is as long as the partitions it spans.
    earlier = Window.partitionBy(*[f"_k_{c}" for c in by]).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    if not by:
        runs = F.broadcast(runs)  # one row per shuffle partition
    match = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]]
    number = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return placed.join(runs, match).select(*df.columns, number.alias(name))


def latest_known(value: str, order: Column) -> Column:
    """Most recent non-null value of a group, as an aggregate."""
    return F.max_by(F.when(F.col(value).isNotNull(), F.col(value)), F.when(F.col(value).isNotNull(), order))


def best(df: DataFrame, by: Sequence[str], what: Sequence[str], measure: str, tie: str) -> DataFrame:
    """The row with the largest measure per group (whole table if ``by`` is empty); ties by smallest ``tie``."""
    kept = [F.col(c) for c in what]
    order = F.struct(F.col(measure), -F.col(tie))
    top = F.max_by(F.struct(*kept, measure), order).alias("_best")
    return df.groupBy(*by).agg(top).select(*by, *[F.col(f"_best.{c}").alias(c) for c in [*what, measure]])


def top_n_and_other(df: DataFrame, label: str, measure: str, n: int, other: str = "Other") -> DataFrame:
    """The n largest labels and one row for all the rest; ties broken by label.

    The winners come from a TakeOrdered of n rows; the rest are summed without
    ever being sorted.
    """
    winners = df.orderBy(F.desc(measure), F.asc(label)).limit(n).select(F.col(label).alias("_winner"))
    bucket = F.when(F.col("_winner").isNotNull(), F.col(label)).otherwise(F.lit(other))
    return (
        df.join(F.broadcast(winners), F.col(label) == F.col("_winner"), "left")
        .groupBy(bucket.alias(label))
        .agg(F.sum(measure).alias(measure))
    )
