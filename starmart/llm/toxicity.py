"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed character n-grams that occur in it, once each. For every feature the log-count ratio
compares the share it has in toxic texts with its share in the others; the counts behind it are taken over the fitted
sample by a distributed sum. The ``n_features`` features whose ratio stands out most against its standard error are
kept, their presence is scaled by the ratio, and a logistic regression on the scaled features gives the score.

The model is fitted on a sample with a documented bound (``max_docs`` labelled texts of each label, chosen by a hash of
the id; its selected features are gathered on the driver). Each sampled text counts for as many as its label has for
one in the sample, so the labels weigh what they weigh in the whole table. The bias is shifted by the offset that
serves F1 best on ``FOLDS`` folds of the sample, each scored by a model whose counts, features and weights come from
the others; so 0.5 is the threshold at every size. Every text is scored as a whole. Tables sent along have 2**bits
entries whatever the input.

A null text counts as empty and is scored like any text without features. If nothing can be learned (no labels, or one
label only), the score is the share of label 1 among the labels, or 0 without labels. Rows with several labels count
with each. Repeated rows are scored alike; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.chargrams import text_buckets
from starmart.llm.common import held_out, small

ORDERS, BITS = (3, 4, 5), 20
#: Labelled texts of each label that the model is fitted on, at most (in expectation).
MAX_DOCS = 4000
N_FEATURES = 1 << 13
SMOOTHING = 1.0
#: A feature in fewer fitted texts is not kept.
LEAST_DOCS = 4
#: Weight of the squared length of the weights, and passes of the solver.
PENALTY, PASSES = 1e-3, 300
STEPS = 1 << 30
#: Folds of the sample, by a hash of the id, on which the offset of the decision is chosen.
FOLDS = 3


@dataclass
class Model:
    """Index of each kept bucket (or -1), the weight of each index (ratio times regression weight), and the bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float

    def features(self, text: str | None) -> np.ndarray:
        """Kept features of a text, once each."""
        found = [i[i >= 0] for i in (self.index[part] for part in text_buckets(text or "", ORDERS, BITS))]
        return np.unique(np.concatenate(found))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        sums = np.array([self.weight[self.features(t)].sum() for t in texts], float) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = MAX_DOCS) -> Model:
    """Fits on the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, label) covers."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = np.full(1 << BITS, -1, np.int32), np.zeros(0)
    if len(sizes) < 2:
        return Model(*nothing, 700.0 if 1 in sizes else -700.0)
    share = lambda y: F.lit(int(min(1, max_docs / sizes[y]) * STEPS))
    chosen = known.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(STEPS)) < F.when(F.col("y") == 1, share(1)).otherwise(share(0))
    )
    # Bounded by max_docs, whatever the tables hold; small() checks it.
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    sample = docs.select("doc_id", "text").join(small(chosen), "doc_id").select("text", "y", fold)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, FOLDS, 1 << BITS), np.int32)
        for batch in batches:
            for text, y, k in zip(*(batch.column(c).to_pylist() for c in ("text", "y", "fold")), strict=True):
                totals[y, k, np.unique(np.concatenate(list(text_buckets(text or "", ORDERS, BITS))))] += 1
        bucket = np.flatnonzero(totals.any(axis=(0, 1)))
        counts = [pa.array(totals[y, k, bucket], pa.int64()) for y, k in CELLS]
        yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), *counts], ["b", *NAMES])

    counted = sample.mapInArrow(count, "b int, " + ", ".join(f"{c} bigint" for c in NAMES)).groupBy("b")
    counted = counted.agg(*[F.sum(c).alias(c) for c in NAMES]).where(F.expr(f"{' + '.join(NAMES)} >= {LEAST_DOCS}"))
    # At most 2**BITS rows of seven numbers.
    table = counted.toArrow()
    bucket = table.column("b").to_numpy().astype(np.int64)
    counts = np.array([table.column(c).to_numpy() for c in NAMES], np.int64).reshape(2, FOLDS, len(bucket))
    del table
    # The last choice of features is that of the whole sample, the others leave out one fold each.
    choices = [selected(bucket, *(counts.sum(axis=1) - counts[:, k])) for k in range(FOLDS)]
    choices.append(selected(bucket, *counts.sum(axis=1)))
    indexes = [index for index, _ in choices]
    del bucket, counts
    pa.default_memory_pool().release_unused()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            found = [[] for _ in indexes]
            for text in batch.column("text").to_pylist():
                buckets = np.unique(np.concatenate(list(text_buckets(text or "", ORDERS, BITS))))
                for own, index in zip(found, indexes, strict=True):
                    own.append(np.sort(index[buckets][index[buckets] >= 0]))
            found = [pa.array(own, kind) for own in found]
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("fold"), *found], ["y", "fold", *PICKED])

    picked = sample.mapInArrow(pick, "y int, fold int, " + ", ".join(f"{c} array<int>" for c in PICKED)).toArrow()
    y, folds, rows = gathered(picked)
    del picked
    pa.default_memory_pool().release_unused()
    if not rows:
        return Model(*nothing, -700.0)
    drawn = np.bincount(y.astype(int), minlength=2)
    counts_for = np.where(y == 1, sizes[1] / max(drawn[1], 1), sizes[0] / max(drawn[0], 1))
    apart = np.full(len(rows), np.nan)
    for k in range(FOLDS):
        rest, own = np.flatnonzero(folds != k), np.flatnonzero(folds == k)
        if len(np.unique(y[rest])) == 2:
            ratio = choices[k][1]
            weight, bias = regression([rows[i][k] for i in rest], y[rest], counts_for[rest], ratio)
            apart[own] = [(weight * ratio)[rows[i][k]].sum() + bias for i in own]
    index, ratio = choices[-1]
    weight, bias = regression([r[-1] for r in rows], y, counts_for, ratio)
    judged = ~np.isnan(apart)
    return Model(index, weight * ratio, bias - threshold(apart[judged], y[judged], counts_for[judged]))


CELLS = [(y, k) for y in (0, 1) for k in range(FOLDS)]
NAMES = [f"n{y}_{k}" for y, k in CELLS]
PICKED = [f"f{k}" for k in range(FOLDS + 1)]


def gathered(picked: pa.Table) -> tuple[np.ndarray, np.ndarray, list[list[np.ndarray]]]:
    """Label, fold and kept features (for each choice) of the sampled texts, in an order that the tasks have no part in.

    Features stay arrays: as lists of numbers they would take nine times the memory of the driver.
    """
    y, folds = picked.column("y").to_numpy(), picked.column("fold").to_numpy()
    features = []
    for name in PICKED:
        lists = picked.column(name).combine_chunks()
        ends = lists.offsets.to_numpy()
        # Big-endian bytes stand in the order of the numbers.
        values = lists.values.to_numpy().astype(">i4")
        features.append([values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
    found = list(zip(*features, strict=True))
    order = sorted(range(len(found)), key=lambda i: (y[i], folds[i], *(f.tobytes() for f in found[i])))
    return y[order].astype(float), folds[order], [found[i] for i in order]


def selected(bucket: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each kept bucket (or -1) and the log-count ratio of each index, from texts of each label that hold it."""
    index = np.full(1 << BITS, -1, np.int32)
    often = n0 + n1 >= LEAST_DOCS
    bucket, p, q = bucket[often], n1[often] + SMOOTHING, n0[often] + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum()) if len(bucket) else np.zeros(0)
    standing = np.abs(ratio) / np.sqrt(1 / p + 1 / q)
    kept = np.lexsort((bucket, -standing))[:N_FEATURES]
    index[bucket[kept]] = np.arange(len(kept), dtype=np.int32)
    return index, ratio[kept]


def threshold(score: np.ndarray, y: np.ndarray, counts_for: np.ndarray) -> float:
    """The log-odds from which on a text is called toxic with the best F1; half-way between two scores.

    0, the model's own, unless another does better.
    """
    order = np.argsort(-score, kind="stable")
    score, y, counts_for = score[order], y[order], counts_for[order]
    total = (counts_for * y).sum()
    f1 = lambda hit, called: 2 * hit / (called + total)
    at = np.flatnonzero(score[:-1] > score[1:])
    if not len(at) or not total:
        return 0.0
    found = f1(np.cumsum(counts_for * y)[at], np.cumsum(counts_for)[at])
    own = score >= 0
    best = int(found.argmax())
    if found[best] <= f1((counts_for * y)[own].sum(), counts_for[own].sum()):
        return 0.0
    return float((score[at[best]] + score[at[best] + 1]) / 2)


def regression(
    rows: list[np.ndarray], y: np.ndarray, counts_for: np.ndarray, scale: np.ndarray
) -> tuple[np.ndarray, float]:
    """Logistic regression on features of value ``scale``: accelerated gradient steps on the penalised mean loss.

    In the mean each row counts for ``counts_for`` rows.
    """
    part = counts_for / counts_for.sum()
    toxic = float((counts_for * y).sum())
    lengths = np.array([len(r) for r in rows])
    columns = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    value = scale[columns]
    weight, bias = np.zeros(len(scale)), float(np.log((toxic + 1) / (counts_for.sum() - toxic + 1)))
    first, second = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)
    for k in range(1, PASSES + 1):
        score = np.bincount(row, value * weight[columns], len(rows)) + bias
        error = part * (1 / (1 + np.exp(-np.clip(score, -700, 700))) - y)
        gradient = np.bincount(columns, value * error[row], len(scale)) + PENALTY * weight
        gradient = np.append(gradient, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        step = 0.03 * first / (1 - 0.9**k) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        weight, bias = weight - step[:-1], bias - float(step[-1])
    return weight, bias


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(model.scores(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from the labels of rows not held out, applied to all."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    rows = score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, as they are; nothing shuffles."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return docs.where(scored(F.col("text").cast("string")) < 0.5)
