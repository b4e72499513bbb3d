"""Exact grouped median by selecting order statistics over range partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import checkpointed


#: The sketch places a quantile within 1/ACCURACY of the rows, far inside the margin around the middle.
ACCURACY = 10_000
MARGIN = 0.005
#: Brackets are sent to every task only if a count shows at most so many groups (two values and a key each).
FEW_GROUPS = 50_000


def group_median(df: DataFrame, by: Sequence[str], value: str, name: str, parts: int | None = None) -> DataFrame:
    """(by..., name): exact median of the non-null values, the mean of the two middle ones if even.

    A mergeable sketch brackets the middle of each group; it decides how much
    work is left, not what the result is. Values below and above the bracket are
    counted only, equal values inside it folded into counts. These counts are
    sorted over range partitions, so a hot group spans as many of them as its
    values need. One row per partition and group tells how many values come
    before; that names the partition, two at most, of a group's middle ranks,
    and only its rows are ranked. The checkpoint fixes the ranges, so places and
    counts agree even if a task is run again.
    """
    middle = middle_rows(df, by, value, parts)
    upto = Window.partitionBy("_part", *by).orderBy("_side", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("_before") + F.sum("_n").over(upto)
    first = last - F.col("_n") + 1
    hits = F.col("_lower").between(first, last).cast("int") + F.col("_upper").between(first, last).cast("int")
    placed = middle.withColumn("_hits", hits).where("_hits > 0")
    return placed.groupBy(*by).agg((F.sum(F.col("_value") * F.col("_hits")) / 2).alias(name))


def bracketed(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., _side, _value, _n): how many values lie below (-1) and above (1) the bracket, and each value inside (0)."""
    present = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    ends = F.percentile_approx("_v", [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY)
    brackets = checkpointed(present.groupBy(*[F.col(c).alias(f"_k_{c}") for c in by]).agg(ends.alias("_ends")))
    if brackets.count() <= FEW_GROUPS:
        brackets = F.broadcast(brackets)
    side = F.when(F.col("_v") < F.col("_ends")[0], -1).when(F.col("_v") > F.col("_ends")[1], 1).otherwise(0)
    inside = F.when(side == 0, F.col("_v").cast("double"))
    sided = present.join(brackets, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by])
    # Each task sends two rows of a group, and the values inside.
    return sided.groupBy(*by, side.alias("_side"), inside.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))


def middle_rows(df: DataFrame, by: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """Folded values in the partitions that hold a group's middle ranks.

    ``_n`` is how often the value occurs, ``_before`` how many values of the group lie in earlier partitions;
    ``_lower`` and ``_upper`` are the group's middle ranks.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in by]
    ranged = bracketed(df, by, value).repartitionByRange(parts, *keys, "_side", "_value")
    placed = checkpointed(ranged.withColumn("_part", F.spark_partition_id()))
    runs = placed.groupBy(F.col("_part").alias("_p"), *[F.col(c).alias(f"_k_{c}") for c in by]).agg(F.sum("_n").alias("_run"))
    # A group has one row for each partition that it spans.
    group = Window.partitionBy(*[f"_k_{c}" for c in by])
    earlier = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_run").over(group)
    runs = runs.select(
        "*",
        F.coalesce(F.sum("_run").over(earlier), F.lit(0)).alias("_before"),
        F.floor((total + 1) / 2).alias("_lower"),
        F.floor((total + 2) / 2).alias("_upper"),
    )
    begins, ends = F.col("_before") + 1, F.col("_before") + F.col("_run")
    runs = runs.where(F.col("_lower").between(begins, ends) | F.col("_upper").between(begins, ends))
    match = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]]
    return placed.join(runs, match).select(*by, "_side", "_value", "_n", "_part", "_before", "_lower", "_upper")
