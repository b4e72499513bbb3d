"""Membership intervals: who is active on a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def headcount(members: DataFrame, group: str, joined: str, left: str, name: str = "active") -> DataFrame:
    """(group, from_day, until_day, active): head count of each group over time.

    A range join would emit a row for every member and day. Instead each member
    contributes +1 on joining and -1 on the day after leaving; the changes are
    summed per day first, so the running total sees at most one row per group
    and calendar day. A member without a leaving day stays. ``until_day`` is
    exclusive, NULL for the last stretch.
    """
    changes = (
        members.select(
            group,
            F.explode(
                F.array(
                    F.struct(F.col(joined).alias("day"), F.lit(1).alias("step")),
                    F.struct(F.date_add(left, 1).alias("day"), F.lit(-1).alias("step")),
                )
            ).alias("c"),
        )
        .select(group, "c.day", "c.step")
        .where(F.col("day").isNotNull())
        .groupBy(group, "day")
        .agg(F.sum("step").alias("step"))
    )
    w = Window.partitionBy(group).orderBy("day")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changes.select(
        group,
        F.col("day").alias("from_day"),
        F.lead("day").over(w).alias("until_day"),
        F.sum("step").over(running).alias(name),
    )


def active_on(needs: DataFrame, day: str, group: str, members: DataFrame, joined: str, left: str) -> DataFrame:
    """For each (group, day) needed: members active in the group, and in all groups when it has none.

    Adds ``active_in_group``, ``used_fallback`` and ``available``. The needed
    days are matched to the head-count stretches by replaying both in one
    ordered pass per group, so no row is multiplied.
    """
    wanted = needs.select(F.col(group).alias("_g"), F.col(day).alias("_d")).distinct()
    per_group = _value_at(headcount(members, group, joined, left), group, wanted, "_g", "_d", "active_in_group")
    everyone = members.withColumn("_all", F.lit("all"))
    all_days = wanted.select(F.lit("all").alias("_ga"), "_d").distinct()
    overall = _value_at(headcount(everyone, "_all", joined, left), "_all", all_days, "_ga", "_d", "active_anywhere")
    answers = (
        per_group.join(overall.select("_d", "active_anywhere"), "_d", "left")
        .withColumn("used_fallback", F.col("active_in_group") == 0)
        .withColumn(
            "available", F.when(F.col("used_fallback"), F.col("active_anywhere")).otherwise(F.col("active_in_group"))
        )
        .drop("active_anywhere")
    )
    return needs.join(answers, (F.col(group).eqNullSafe(F.col("_g"))) & (F.col(day) == F.col("_d")), "left").drop(
        "_g", "_d"
    )


def _value_at(
    stretches: DataFrame, group: str, wanted: DataFrame, wanted_group: str, wanted_day: str, name: str
) -> DataFrame:
    """Head count at each wanted (group, day): last stretch that began on or before the day."""
    marks = stretches.select(F.col(group).alias(wanted_group), F.col("from_day").alias(wanted_day), F.col("active"))
    asked = wanted.select(wanted_group, wanted_day).withColumn("_asked", F.lit(True))
    both = marks.join(asked, [wanted_group, wanted_day], "full")
    w = Window.partitionBy(wanted_group).orderBy(wanted_day)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        both.withColumn(name, F.coalesce(F.last("active", ignorenulls=True).over(upto), F.lit(0)))
        .where("_asked")
        .select(wanted_group, wanted_day, name)
    )
