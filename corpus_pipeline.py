"""From raw documents to packed sequences, stage by stage; each stage's result is written as Parquet and read again.

All stages but the last keep the rows they pass as they are. A null text is no reason to reject a row; an empty table
passes through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontamination, exact_dedup, ngram_join, packing, queries, toxicity
from starmart.llm.common import bounded_batches
from starmart.session import shared_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_texts(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score as toxic go. Labels of held-out rows are not learned from."""
    return toxicity.clean(docs, queries.table(spark, folder, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that links by five-word shingles at a similarity of 0.8 stays."""
    return ngram_join.dedup(docs, ngram_join.Rule(words=5, percent=80))


def benchmark_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Contaminated documents go."""
    return decontamination.clean(docs, queries.table(spark, folder, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What is left, packed: one row per piece."""
    return queries.digests(packing.pack(docs, queries.vocabulary("word_bpe_49k.json")))


def bounded(stage: Stage) -> Stage:
    """``stage`` with its texts in batches of bounded size: workers and heap of earlier stages leave little room."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, folder)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", bounded(toxic_texts)),
    ("exact_dedup", bounded(exact_copies)),
    ("ngram_join", bounded(near_copies)),
    ("decontamination", bounded(benchmark_passages)),
    ("packing", bounded(sequences)),
]

#: Model scores and token sequences have no SQL form; tests/llm/ compares each stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
