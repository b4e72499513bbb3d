"""Key lookups and referential checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import written

#: Missing keys are sent to every executor only if a count shows at most so many.
FEW_MISSING = 200_000


def lookup(df: DataFrame, key: str, dim: DataFrame, dim_key: str, take: dict[str, str]) -> DataFrame:
    """Left join ``dim`` on ``key`` and add ``take`` (dim column -> new name).

    No broadcast hint: Spark compares the size of ``dim`` with its broadcast
    limit, and AQE does so again with the measured size.
    """
    side = dim.select(F.col(dim_key).alias("_lookup"), *[F.col(c).alias(n) for c, n in take.items()])
    return df.join(side, df[key] == side["_lookup"], "left").drop("_lookup")


def flag_missing(
    df: DataFrame, key: str, parent: DataFrame, parent_key: str, flag: str, among: DataFrame | None = None
) -> DataFrame:
    """Add a boolean: the key has no row in ``parent`` (a missing key counts as missing).

    ``among`` is a frame that has every key of ``df`` and is cheap to read, such as its raw rows. Keys alone are
    compared first, then; if few of them are missing, only these are looked up and the wide rows do not shuffle.
    """
    keys = parent.select(F.col(parent_key).alias("_parent")).where(F.col("_parent").isNotNull()).distinct()
    if among is not None:
        own = among.select(F.col(key).alias("_missing")).where(F.col("_missing").isNotNull()).distinct()
        missing = written(own.join(keys, own["_missing"] == keys["_parent"], "left_anti"), "missing-keys")
        if missing.limit(FEW_MISSING + 1).count() <= FEW_MISSING:
            absent = df[key].isNull() | F.col("_missing").isNotNull()
            looked_up = df.join(F.broadcast(missing), df[key] == missing["_missing"], "left")
            return looked_up.withColumn(flag, absent).drop("_missing")
    return df.join(keys, df[key] == keys["_parent"], "left").withColumn(flag, F.col("_parent").isNull()).drop("_parent")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key does not resolve."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return df.where(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("_parent"), "left_anti")


def resolved(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key resolves."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return df.join(keys, F.col(key) == F.col("_parent"), "left_semi")


def spread_blank(key: Column, row_id: Column) -> Column:
    """Replace a blank join key by a value unique to the row that matches nothing.

    Rows without a key would otherwise all hash to one shuffle partition. The
    leading space cannot occur in a stripped key.
    """
    return F.when((key.isNull()) | (key == ""), F.concat(F.lit(" "), row_id.cast("string"))).otherwise(key)
