"""Duplicate removal and completeness."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import releasing, shared_path, written

COPIES = "_copies"
#: The marks of repeated keys take at most so many bits (32 MB), and this many a key as long as they do.
MOST_BITS, BITS_A_KEY = 1 << 28, 32
#: Bits in each of Spark's bitmaps.
BITMAP = 1 << 15
#: With more repeated keys the rows are ordered in slices, one after the other, so shuffle files hold one slice at a time.
SLICE_KEYS = 1 << 24
#: Counts of repeated keys are sent to every executor only if there are at most so many.
FEW_KEYS = 200_000


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: str | Sequence[str]) -> DataFrame:
    """One row per key, the one with the smallest ordinal, plus ``_copies``.

    The first pass reads the keys alone and counts them. Keys that occur more
    than once are marked in bitmaps of bounded size. The second pass lets every
    row through whose mark is not set; only the others are ordered, and each
    task keeps the first of its rows of a key before they shuffle, so a key that
    holds a third of the table is one row per task. A unique key with another
    one's mark is ordered for nothing. The counts are looked up by the key as
    the rows were dealt out to be ordered, so kept rows do not shuffle again.
    Very many repeated keys are ordered slice by slice; each reads the rows.
    ``sum(_copies)`` is the raw row count. Null keys are equal to each other; of
    equal ordinals any row is kept.
    """
    order = [ordinal] if isinstance(ordinal, str) else list(ordinal)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 1)
    counts = written(counts, "repeated-keys")
    repeated = counts.count()
    single = F.lit(1).cast("bigint").alias(COPIES)
    if not repeated:
        return df.select("*", single)
    bits = BITMAP
    while bits < min(MOST_BITS, BITS_A_KEY * repeated):
        bits *= 2
    marks = F.broadcast(written(marked(counts, keys, bits), "marks"))  # at most MOST_BITS
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    at = place.bitwiseAND(BITMAP - 1)
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    isset = F.col("_bits").isNotNull() & (F.expr("shiftright(_byte, cast(_at & 7 as int)) & 1") == 1)
    rows = df.withColumn("_at", at).join(marks, F.shiftright(place, 15) == F.col("_bucket"), "left")
    rows = rows.withColumn("_byte", byte).withColumn("_marked", F.coalesce(isset, F.lit(False)))
    passed = rows.where(~F.col("_marked")).select(*df.columns, single)
    key = F.struct(*keys).alias("_key")
    slices = math.ceil(repeated / SLICE_KEYS)
    if slices == 1:
        named = counts.select(key, COPIES)
        kept = firsts(rows, keys, order, df.columns, F.broadcast(named) if repeated <= FEW_KEYS else named.hint("merge"))
        return passed.unionByName(kept)
    path = shared_path(df.sparkSession, "kept")
    for k in range(slices):
        own = F.pmod(F.shiftright(F.xxhash64(*keys), 40), F.lit(slices)) == k
        some = counts.where(own).select(key, COPIES).hint("merge")
        with releasing(df.sparkSession):
            firsts(rows.where(own), keys, order, df.columns, some).write.mode("append").parquet(path)
    return passed.unionByName(df.sparkSession.read.parquet(path))


def firsts(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], named: DataFrame) -> DataFrame:
    """The first of the marked rows of every key, with its count in ``named`` or 1."""
    first = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    # A struct is equal to another with nulls in the same fields, and is never null itself.
    key = F.struct(*keys).alias("_key")
    rest = [c for c in columns if c in order or c not in keys]
    ordered = rows.where("_marked").select(key, *rest).withColumn("_place", first).where("_place = 1")
    kept = ordered.join(named, "_key", "left")
    whole = [F.col(c) if c in rest else F.col("_key")[c].alias(c) for c in columns]
    return kept.select(*whole, F.coalesce(COPIES, F.lit(1)).cast("bigint").alias(COPIES))


def marked(keys_frame: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(_bucket, _bits): bitmaps with a bit set for the hash of every key."""
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    at = place.bitwiseAND(BITMAP - 1)
    return keys_frame.groupBy(F.shiftright(place, 15).alias("_bucket")).agg(F.bitmap_construct_agg(at).alias("_bits"))


def removed_count(deduped: DataFrame) -> DataFrame:
    """(rows_in, rows_out, removed) of a ``keep_first`` result."""
    n_in, n_out = F.coalesce(F.sum(COPIES), F.lit(0)), F.count(F.lit(1))
    return deduped.agg(n_in.alias("rows_in"), n_out.alias("rows_out"), (n_in - n_out).alias("removed"))


def completeness(columns: Sequence[str]) -> Column:
    """Share of non-null cells over several columns, as one aggregate; 1 for no rows."""
    filled = sum((F.count(c) for c in columns[1:]), F.count(columns[0]))
    cells = F.count(F.lit(1)) * len(columns)
    return F.when(cells == 0, F.lit(1.0)).otherwise(F.round(F.try_divide(filled, cells), 4))
