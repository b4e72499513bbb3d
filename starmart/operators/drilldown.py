"""Hierarchy totals from mergeable states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drill_down(
    df: DataFrame, levels: Sequence[str], sums: Mapping[str, Column], distinct: Mapping[str, str] | None = None
) -> DataFrame:
    """Sums and exact distinct counts at every level of a hierarchy, and the grand total.

    ``level`` is 0 for the grand total up to ``len(levels)`` for the finest
    rows. ``sums`` are aggregates that add up; ``distinct`` names whole-number
    columns. The rows are read once, at the finest level: a sum is a number
    there, and the values of a distinct count are bits in Spark's bitmaps, one
    for each 32,768 neighbouring values. Coarser levels merge the sums and the
    bitmaps of the level below, so no row is repeated for a level and nothing is
    counted twice; a bitmap is 4 KB, whatever it holds. Null values do not count.
    """
    distinct = dict(distinct or {})
    depth = len(levels)
    assert depth > 0
    finest = df.groupBy(*levels).agg(*[v.alias(n) for n, v in sums.items()])
    totals = [finest]
    for d in range(depth - 1, -1, -1):
        totals.append(totals[-1].groupBy(*levels[:d]).agg(*[F.sum(n).alias(n) for n in sums]))
    found = [labelled(t, levels, depth - i, list(sums)) for i, t in enumerate(totals)]
    for name, column in distinct.items():
        value = F.col(column).cast("bigint")
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("_bits")
        present = df.where(F.col(column).isNotNull())
        state = present.groupBy(*levels, F.bitmap_bucket_number(value).alias("_bucket")).agg(bits)
        for i in range(depth + 1):
            own = list(levels[: depth - i])
            if i:
                state = state.groupBy(*own, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))
            counts = state.groupBy(*own).agg(F.sum(F.bitmap_count("_bits")).alias(name))
            found[i] = joined(found[i], counts, own, name)
    return reduce(DataFrame.unionByName, [f.select(*levels, "level", *sums, *distinct) for f in found])


def labelled(totals: DataFrame, levels: Sequence[str], level: int, names: Sequence[str]) -> DataFrame:
    """Totals of a level with the columns of all levels; those below it are null."""
    kinds = {f.name: f.dataType for f in totals.schema.fields}
    columns = [F.col(c) if c in kinds else F.lit(None).alias(c) for c in levels]
    return totals.select(*columns, F.lit(level).alias("level"), *names)


def joined(totals: DataFrame, counts: DataFrame, own: Sequence[str], name: str) -> DataFrame:
    """Totals with a distinct count; 0 where all its values are null."""
    if not own:
        return totals.withColumn(name, F.coalesce(counts.select(name).scalar(), F.lit(0).cast("bigint")))
    counts = counts.withColumnsRenamed({c: f"_k_{c}" for c in own})
    match = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in own]
    named = totals.join(counts, match, "left").drop(*[f"_k_{c}" for c in own])
    return named.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
