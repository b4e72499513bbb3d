"""The data-quality log: one aggregate per table, unpivoted to (table, metric, stage, value, notes)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.numbers import count_rows, ratio
from starmart.operators.dedupe import COPIES, completeness
from starmart.plans.ledger import events, stored_tables
from starmart.schemas import QUALITY_LOG

CLEANING = "cleaning"


@dataclass
class Cleaned:
    """A cleaned table together with the issue flags found on the way.

    ``frame`` holds the contract columns, one boolean per issue and, for
    deduplicated tables, the number of raw rows behind each row. It is written
    as it is: the log is then one scan over a few flag columns of the written
    table, which gives the same counts even if tasks were run again.
    """

    name: str
    frame: DataFrame
    columns: list[str]
    issues: dict[str, str] = field(default_factory=dict)  # metric -> note; the flag column is ``dq_<metric>``
    complete_over: Sequence[str] = ()
    removed_metric: str = "duplicates_removed"

    @property
    def rows(self) -> DataFrame:
        return self.frame.select(*self.columns)

    def quality(self, source: DataFrame | None = None, started: datetime | None = None) -> DataFrame:
        """Log rows. Issues are listed when they occur; row counts and completeness always."""
        df = self.frame if source is None else source
        cleaned = count_rows()
        raw = F.coalesce(F.sum(COPIES), F.lit(0)) if COPIES in df.columns else cleaned
        totals = {"raw": raw, "cleaned": cleaned, "complete": completeness(self.complete_over)}
        totals |= {f"dq_{m}": F.count_if(F.col(f"dq_{m}")) for m in self.issues}
        one = df.agg(*[v.alias(k) for k, v in totals.items()])
        rows = [
            log_row("row_count", "raw", F.col("raw"), always=True),
            log_row("row_count", "cleaned", F.col("cleaned"), always=True),
            log_row("completeness", CLEANING, F.col("complete"), always=True),
        ]
        if COPIES in df.columns:
            rows.append(log_row(self.removed_metric, CLEANING, F.col("raw") - F.col("cleaned")))
        rows += [log_row(m, CLEANING, F.col(f"dq_{m}"), note) for m, note in self.issues.items()]
        return unpivoted(one, self.name, rows, started)


def log_row(metric: str, stage: str, value: Column, notes: str = "", always: bool = False) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        F.lit(stage).alias("stage"),
        value.cast("double").alias("value"),
        F.lit(notes).alias("notes"),
        F.lit(always).alias("always"),
    )


def unpivoted(one: DataFrame, table: str, rows: list[Column], started: datetime | None) -> DataFrame:
    stamp = F.lit(started).cast("timestamp") if started else F.current_timestamp()
    return (
        one.select(F.explode(F.array(*rows)).alias("r"))
        .where("r.always OR r.value > 0")
        .select(
            stamp.alias("run_started_at"), F.lit(table).alias("table"), "r.metric", "r.stage", "r.value", "r.notes"
        )
    )


def failures_row(counts: DataFrame, table: str, started: datetime | None = None) -> DataFrame:
    """The ``validation_failures`` entry of a table, written even when 0."""
    total = counts.agg(F.coalesce(F.sum("failures"), F.lit(0)).alias("n"))
    return unpivoted(total, table, [log_row("validation_failures", CLEANING, F.col("n"), always=True)], started)


def row_count_entry(df: DataFrame, table: str, stage: str, started: datetime | None = None) -> DataFrame:
    """Row count of one table at one stage."""
    one = df.agg(count_rows().alias("n"))
    return unpivoted(one, table, [log_row("row_count", stage, F.col("n"), always=True)], started)


def metric_entry(one: DataFrame, table: str, metric: str, value: str, started: datetime | None = None) -> DataFrame:
    """Any single-row aggregate as a log entry."""
    return unpivoted(one, table, [log_row(metric, CLEANING, F.col(value), always=True)], started)


def to_log(spark: SparkSession, records: list[tuple], started: datetime) -> DataFrame:
    """Hand-made records (table, metric, stage, value, notes) stamped with the run start."""
    return spark.createDataFrame([(started, *r) for r in records], QUALITY_LOG)


# ------------------------------------------------------------------ reading a log of many runs


def read_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """The stored log as of now: for each table the entries of the run that stored it last.

    Entries of a run that died before it had stored the table do not count.
    """
    complete = stored_tables(events(spark, log_dir)).select("table", "run_id")
    return spark.read.parquet(log_dir).join(complete, ["table", "run_id"], "left_semi")


def latest(log: DataFrame) -> DataFrame:
    """Of each table the entries of the newest run in the log; a log without run ids is one run."""
    if "run_id" not in log.columns:
        return log
    newest = F.max_by("run_id", F.struct("run_started_at", "run_id")).alias("_newest")
    per_table = log.groupBy(F.col("table").alias("_table")).agg(newest)
    match = (F.col("table") == F.col("_table")) & (F.col("run_id") == F.col("_newest"))
    return log.join(per_table, match, "left_semi")


def stage_summary(log: DataFrame) -> DataFrame:
    """Row counts per table, one column per stage, of each table's newest run."""
    counts = latest(log).where("metric = 'row_count'")
    return counts.groupBy("table").pivot("stage", ["raw", "cleaned"]).agg(F.first("value"))


def metric_summary(log: DataFrame) -> DataFrame:
    """Everything but row counts, of each table's newest run."""
    return latest(log).where("metric <> 'row_count'").select("table", "metric", "value", "notes")


def log_kpis(log: DataFrame) -> DataFrame:
    """Completeness %, total validation failures and duplicates removed over the newest run of every table.

    Duplicates are those of the metric of that name; booking references have a metric of their own.
    """
    v, metric = F.col("value"), F.col("metric")
    return latest(log).agg(
        F.avg(F.when(metric == "completeness", v)).alias("completeness_pct"),
        F.sum(F.when(metric == "validation_failures", v)).alias("total_validation_failures"),
        F.sum(F.when(metric == "duplicates_removed", v)).alias("total_duplicates_removed"),
    )


# The metrics that count rows removed as duplicates of a table.
REMOVED_METRICS = ("duplicates_removed", "duplicate_booking_references_removed")


def table_rates(log: DataFrame) -> DataFrame:
    """Per table's newest run: duplicates removed / raw rows, validation failures / cleaned rows."""
    v, metric, stage = F.col("value"), F.col("metric"), F.col("stage")
    raw = F.max(F.when((metric == "row_count") & (stage == "raw"), v))
    cleaned = F.max(F.when((metric == "row_count") & (stage == "cleaned"), v))
    removed = F.coalesce(F.sum(F.when(metric.isin(*REMOVED_METRICS), v)), F.lit(0.0))
    failed = F.coalesce(F.sum(F.when(metric == "validation_failures", v)), F.lit(0.0))
    return latest(log).groupBy("table").agg(
        ratio(removed, raw).alias("duplicate_rate"), ratio(failed, cleaned).alias("validation_failure_rate")
    )
