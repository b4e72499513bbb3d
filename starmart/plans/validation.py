"""Contract checks: every row rule of a table in one aggregate, plus keys and references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.lookup import orphans
from starmart.schemas import Contract


def row_rules(contract: Contract) -> list[tuple[str, str, Column]]:
    """(column, check, failed) for every null, enum and range rule."""
    rules = []
    for name, f in contract.fields.items():
        if not f.nullable:
            rules.append((name, "not_null", F.col(name).isNull()))
        rules += [(name, c.label, ~F.coalesce(c.passes(F.col(name)), F.lit(True))) for c in f.checks]
    return rules


def rule_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """(column, check, failures) of all row rules from a single scan."""
    rules = row_rules(contract)
    one = df.agg(*[F.count_if(failed).alias(f"r{i}") for i, (_, _, failed) in enumerate(rules)])
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), F.col(f"r{i}").alias("failures"))
        for i, (c, k, _) in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*rows)))


def duplicate_count(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """(column, check, failures): rows that share a non-null key with another row."""
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    groups = df.where(present).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    failures = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return groups.agg(failures.alias("failures")).select(
        F.lit(",".join(key)).alias("column"), F.lit("unique").alias("check"), "failures"
    )


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """All failures of a contract as counts; nothing is dropped."""
    keys = [duplicate_count(df, key) for key in contract.keys]
    return reduce(DataFrame.unionByName, keys, rule_counts(df, contract))


def failure_cases(df: DataFrame, contract: Contract) -> DataFrame:
    """(column, check, value, rows): the offending values and how often each occurs."""
    cases = [
        F.struct(
            F.lit(c).alias("column"), F.lit(k).alias("check"), F.col(c).cast("string").alias("value"),
            failed.alias("failed"),
        )
        for c, k, failed in row_rules(contract)
    ]
    failed_rules = F.filter(F.array(*cases), lambda r: r["failed"])
    found = df.select(F.inline(failed_rules)).groupBy("column", "check", "value").agg(F.count(F.lit(1)).alias("rows"))
    for key in contract.keys:
        twice = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").dropna(subset=list(key))
        found = found.unionByName(
            twice.select(
                F.lit(",".join(key)).alias("column"),
                F.lit("unique").alias("check"),
                F.concat_ws(",", *[F.col(c).cast("string") for c in key]).alias("value"),
                "rows",
            )
        )
    return found


def first_failures(df: DataFrame, contract: Contract, n: int = 10) -> DataFrame:
    """A short sample for the job log."""
    return failure_cases(df, contract).orderBy("column", "check", "value").limit(n)


def schema_gaps(df: DataFrame, contract: Contract) -> list[tuple[str, str, str | None]]:
    """(column, expected, found) for missing columns and wrong types."""
    expected = T.StructType.fromDDL(contract.ddl)
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [
        (f.name, f.dataType.simpleString(), found.get(f.name))
        for f in expected.fields
        if found.get(f.name) != f.dataType.simpleString()
    ]


def reference_counts(tables: dict[str, DataFrame], contracts: dict[str, Contract], name: str) -> DataFrame:
    """(table, column, failures): non-null foreign keys of a table that do not resolve."""
    checks = []
    for column, (parent, parent_key) in contracts[name].references.items():
        # Count per key before the join: a hot key becomes one row per task.
        per_key = tables[name].groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        missing = orphans(per_key, column, tables[parent], parent_key)
        checks.append(
            missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")).select(
                F.lit(name).alias("table"), F.lit(column).alias("column"), "failures"
            )
        )
    return reduce(DataFrame.unionByName, checks)


def invariants(bookings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Warehouse invariants as violation counts."""
    # Fixed value: a total may exceed the list price by rounding only.
    slack = F.lit("1.50").cast("decimal(18,2)")
    b = bookings.agg(
        F.count_if(~F.col("party_size").between(1, 3)).alias("party_size_1_to_3"),
        F.count_if(F.col("total_price") > F.col("list_price") + slack).alias("total_within_list_price"),
        F.count_if(~F.col("discount_applied") & (F.col("discount_pct") != 0)).alias("undiscounted_has_no_pct"),
    )
    r = reviews.agg(F.count_if(~F.col("overall_rating").between(1, 5)).alias("rating_1_to_5"))
    rows = [
        df.select(F.lit(c).alias("rule"), F.col(c).alias("violations")) for df in (b, r) for c in df.columns
    ]
    return reduce(DataFrame.unionByName, rows)


def reconcile(left: DataFrame, left_value: str, right: DataFrame, right_value: str) -> DataFrame:
    """Totals of two frames side by side: (left_total, right_total, difference)."""
    a = left.agg(F.sum(left_value).alias("v")).select(F.lit("left").alias("side"), "v")
    b = right.agg(F.sum(right_value).alias("v")).select(F.lit("right").alias("side"), "v")
    both = a.unionByName(b)
    return both.agg(
        F.sum(F.when(F.col("side") == "left", F.col("v"))).alias("left_total"),
        F.sum(F.when(F.col("side") == "right", F.col("v"))).alias("right_total"),
    ).withColumn("difference", F.col("left_total") - F.col("right_total"))
