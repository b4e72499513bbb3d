"""The run ledger: what a job did and when, as appended events.

A run begins, stores tables and ends, or it never ends; each of these is one
row (run_id, job, table, state, at, note). Nothing is ever changed, so a job
that dies leaves what it had recorded, and jobs may write at the same time.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import RUN_EVENTS

STARTED, STORED, FINISHED, FAILED, UNFINISHED = "started", "stored", "finished", "failed", "unfinished"


def ledger_dir(log_dir: str) -> str:
    """The ledger lies beside the log whose runs it tells of."""
    return f"{log_dir.rstrip('/')}-runs"


class Run:
    """One run of a job: ``with Run(...) as run`` records its start and its end, or that it failed."""

    def __init__(self, spark: SparkSession, log_dir: str, job: str):
        self.spark, self.folder, self.job = spark, ledger_dir(log_dir), job
        self.run_id = uuid.uuid4().hex
        self.started = datetime.now(timezone.utc)

    def record(self, state: str, table: str | None = None, note: str = "", at: datetime | None = None) -> None:
        row = (self.run_id, self.job, table, state, at or datetime.now(timezone.utc), note)
        self.spark.createDataFrame([row], RUN_EVENTS).coalesce(1).write.mode("append").parquet(self.folder)

    def stored(self, table: str) -> None:
        """The table and its log entries are complete."""
        self.record(STORED, table)

    def __enter__(self) -> Run:
        self.record(STARTED, at=self.started)
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, _: TracebackType | None) -> None:
        self.record(FAILED if kind else FINISHED, note=str(error)[:500] if kind else "")


def events(spark: SparkSession, log_dir: str) -> DataFrame:
    return spark.read.schema(RUN_EVENTS).parquet(ledger_dir(log_dir))


def runs(recorded: DataFrame) -> DataFrame:
    """(run_id, job, state, started_at, ended_at, duration_seconds, tables) of every run.

    A run without an end is unfinished and has no duration, however long ago it began.
    """
    state, at = F.col("state"), F.col("at")
    ended = state.isin(FINISHED, FAILED)
    one = recorded.groupBy("run_id", "job").agg(
        F.min(F.when(state == STARTED, at)).alias("started_at"),
        F.max(F.when(ended, at)).alias("ended_at"),
        F.max_by(F.when(ended, state), F.when(ended, at)).alias("_end"),
        F.count_if(state == STORED).alias("tables"),
    )
    seconds = (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1_000_000
    return one.select(
        "run_id",
        "job",
        F.coalesce("_end", F.lit(UNFINISHED)).alias("state"),
        "started_at",
        "ended_at",
        seconds.alias("duration_seconds"),
        "tables",
    )


def stored_tables(recorded: DataFrame) -> DataFrame:
    """(table, run_id, at): the run that stored each table last."""
    stored = recorded.where(F.col("state") == STORED)
    newest = F.max_by(F.struct("run_id", "at"), F.struct("at", "run_id")).alias("_newest")
    return stored.groupBy("table").agg(newest).select("table", "_newest.run_id", "_newest.at")
