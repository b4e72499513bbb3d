"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is fitted on a sample with a documented bound (``max_docs`` texts of each language, chosen by a hash of the
id); every text is scored as a whole. The matrix of log-probabilities has 2**bits rows and a column for each language,
so its size is fixed; it travels with the scoring function.

A null text or one without a letter is ``und`` with score 0, as is every text if nothing can be learned (an empty
table, no language given). Ties go to the language that sorts first. Repeated rows are scored alike; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.chargrams import PIECE, text_buckets
from starmart.llm.common import held_out

ORDERS, BITS = (1, 2, 3), 16
#: Texts of each language that the model is fitted on, at most (in expectation).
MAX_DOCS = 3000
#: Added to each count.
SMOOTHING = 0.1
#: Scored n-grams are gathered up to so many before they are summed by text.
GATHER = 1 << 20
STEPS = 1 << 30


class Model:
    """Languages in order, and the log-probability of each bucket in each language, with the prior as last row."""

    def __init__(self, languages: list[str], counts: np.ndarray, docs: np.ndarray):
        smooth = counts + SMOOTHING
        self.languages = languages
        self.logp = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float64).copy()
        self.prior = np.log(docs / docs.sum()) if len(docs) else np.zeros(0)


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id") -> Model:
    """Fits on the rows of ``docs`` (id, text, lang) with a language and a text, up to ``max_docs`` of each language."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 1 << BITS)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, int(min(1, max_docs / sizes[k]) * STEPS))])
    sample = rows.where(F.pmod(F.xxhash64(id_col), F.lit(STEPS)) < F.element_at(share, F.col("lang")))
    at = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(at), 1 << BITS), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                for part in text_buckets(text, ORDERS, BITS):
                    totals[at[lang]] += np.bincount(part, minlength=1 << BITS)
        lang, bucket = totals.nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[lang, bucket], pa.int64())],
            ["lang", "bucket", "n"],
        )

    counted = sample.select("text", "lang").mapInArrow(count, "lang int, bucket int, n bigint")
    counts = np.zeros((len(languages), 1 << BITS))
    # At most 2**BITS rows for each language.
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["lang"], r["bucket"]] = r["n"]
    return Model(languages, counts, np.array([sizes[k] for k in languages], float))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score (the model's probability of lang_pred)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            for rows, likelihood in likelihoods(batch.column("text"), model):
                total = likelihood + model.prior
                odds = np.exp(total - total.max(axis=1, keepdims=True))
                best = odds.argmax(axis=1)
                scores[rows] = odds[np.arange(len(rows)), best] / odds.sum(axis=1)
                for r, b in zip(rows, best, strict=True):
                    names[r] = model.languages[b]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def likelihoods(texts: pa.Array, model: Model) -> Iterator[tuple[list[int], np.ndarray]]:
    """Rows that have a letter, and their log-likelihoods; sums over the n-grams that occur, some texts at a time."""
    rows: list[int] = []
    found: list[np.ndarray] = []
    held = 0
    for r, text in enumerate(texts.to_pylist()):
        if not text or not model.languages or not any(map(str.isalpha, text)):
            continue
        if len(text) > PIECE:
            yield [r], sum(summed([p], model) for p in text_buckets(text, ORDERS, BITS) if len(p))
            continue
        rows.append(r)
        found.append(next(text_buckets(text, ORDERS, BITS)))
        held += len(found[-1])
        if held >= GATHER:
            yield rows, summed(found, model)
            rows, found, held = [], [], 0
    if rows:
        yield rows, summed(found, model)


def summed(found: list[np.ndarray], model: Model) -> np.ndarray:
    starts = np.cumsum([0, *map(len, found[:-1])])
    return np.add.reduceat(model.logp[np.concatenate(found)], starts, axis=0)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out, applied to all."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
