"""Benchmark decontamination by winnowing.

Words are maximal runs of letters, digits and all that is not ASCII, with A-Z lowered. Every ``window`` consecutive
words of an item are one item window; an item of fewer words is one window as a whole. A document word inside any
occurrence of an item window is hit.

Of the hashes of all k-grams, the smallest in each run of ``window - k + 1`` is kept as a fingerprint. Two equal
windows hold the same k-grams, so they keep the same smallest one: every shared span of ``window`` words or more meets
in the join of fingerprints. A hit is extended to the windows that its fingerprint stands for, and these are compared
as a whole by a second hash. Neighbouring windows with the same fingerprint travel as one row, so a text costs about
2 / (window - k + 2) rows a word. Items shorter than a window are looked up by grams of their own length, one pass for
each length that occurs.

A null text has no words and is never contaminated; an empty benchmark contaminates nothing; items without words match
nothing. Repeated document rows are judged one by one, repeated items count once. Passages of items
without an id count like all others; these items are one in ``n_items`` and are not named. Only DataFrame functions run
here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ascii_lower, row_key, small, without_keys
from starmart.session import checkpointed

WINDOW, GRAM = 13, 8
#: All that separates words, once A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(rows: DataFrame, text: str) -> DataFrame:
    """Replaces the text by ``_h1``, the hashes of its words, and adds their number, ``_n``."""
    words = F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS)
    hashes = F.array_remove(F.transform(words, lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))
    rows = rows.withColumn("_h1", hashes).drop(text)
    return rows.withColumn("_n", F.size("_h1"))


def positions(size: int) -> Column:
    """Where runs of ``size`` words start."""
    return F.when(F.col("_n") >= size, F.sequence(F.lit(0), F.col("_n") - size)).otherwise(F.array().cast("array<int>"))


def overlapped(rows: DataFrame, source: str, size: int, combine, into: str) -> DataFrame:
    """Adds ``into``: element i combines source[i : i + size]; each step at most doubles the reach, by overlap."""
    rows, reach = rows.withColumn(into, F.col(source)), 1
    while reach < size:
        step = min(reach, size - reach)
        length = F.greatest(F.size(into) - step, F.lit(0))
        rows = rows.withColumn(into, F.zip_with(F.slice(into, 1, length), F.slice(into, step + 1, length), combine))
        reach += step
    return rows


def with_grams(rows: DataFrame, size: int, into: str) -> DataFrame:
    """Adds a hash for each run of ``size`` words."""
    return overlapped(rows, "_h1", size, lambda a, b: F.xxhash64(a, b), into)


def winnowed(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Adds ``_runs``: (start, fp, windows) for each run of neighbouring windows with the same smallest gram.

    A window's own hash is that of its first and last gram, which together hold all its words (2 * gram >= window).
    """
    if not window // 2 < gram <= window:
        raise ValueError("gram must be over half a window and at most a window")
    width = window - gram + 1
    rows = overlapped(with_grams(rows, gram, "_gram"), "_gram", width, lambda a, b: F.least(a, b), "_min")
    first = lambda i: (i == 0) | (F.get("_min", i) != F.get("_min", i - 1))
    rows = rows.withColumn("_starts", F.filter(positions(window), first))
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts") - 1, F.lit(0))), F.array(F.size("_min")))
    runs = F.zip_with(
        "_starts",
        F.when(F.size("_starts") > 0, ends).otherwise(F.array().cast("array<int>")),
        lambda a, b: F.struct(
            a.alias("start"),
            F.lit(window).alias("len"),
            F.get("_min", a).alias("fp"),
            F.transform(
                F.sequence(a, b - 1), lambda i: F.xxhash64(F.get("_gram", i), F.get("_gram", i + width - 1))
            ).alias("windows"),
        ),
    )
    return rows.withColumn("_runs", runs).drop("_gram", "_min", "_starts")


def short_runs(size: int) -> Column:
    """A run for each gram of ``size`` words in ``_h{size}``, which is its own fingerprint."""
    return F.transform(
        f"_h{size}",
        lambda h, i: F.struct(i.alias("start"), F.lit(size).alias("len"), h.alias("fp"), F.array(h).alias("windows")),
    )


def item_windows(benchmark: DataFrame, window: int, gram: int) -> tuple[DataFrame, list[int]]:
    """(len, fp, window, item_id) of all items, and the lengths of items below a window (fewer than ``window``)."""
    items = with_words(benchmark.select("item_id", F.col("text").cast("string").alias("_text")), "_text")
    lengths = [r[0] for r in items.where((F.col("_n") > 0) & (F.col("_n") < window)).select("_n").distinct().collect()]
    parts = [winnowed(items, window, gram).select("item_id", "_runs")]
    for size in sorted(lengths):
        short = with_grams(items.where(F.col("_n") == size), size, f"_h{size}")
        parts.append(short.select("item_id", short_runs(size).alias("_runs")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # explode() would infer filters on the arrays, and these would repeat the whole chain below each project.
    rows = rows.select("item_id", F.explode_outer("_runs").alias("r")).where("r is not null")
    rows = rows.select(
        F.col("r.len").alias("_len"),
        F.col("r.fp").alias("_fp"),
        F.explode_outer("r.windows").alias("_window"),
        F.col("item_id").alias("_item"),
    )
    return rows.distinct(), sorted(lengths)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document row: doc_id, n_words, hits [(start, end)], items [item_id], n_hit, n_items, contaminated.

    ``hits`` are the occurrences of item windows, ``items`` the sorted ids of the items they belong to; a document is
    contaminated if it has a hit word and at least a twentieth of its words are hit.
    """
    known, lengths = item_windows(benchmark, window, gram)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("_text"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = winnowed(with_words(rows, "_text"), window, gram)
    for size in lengths:
        rows = with_grams(rows, size, f"_h{size}")
    runs = [F.col("_runs"), *map(short_runs, lengths)]
    # One more row for each document, which meets no fingerprint, so that all documents come out of the same pass.
    whole = F.struct(
        F.lit(-1).alias("start"),
        F.lit(0).alias("len"),
        F.xxhash64("_row", F.lit("whole")).alias("fp"),
        F.array().cast("array<bigint>").alias("windows"),
    )
    rows = rows.select("doc_id", "_row", "_n", F.explode_outer(F.concat(F.array(whole), *runs)).alias("r"))
    rows = rows.select(
        "doc_id", "_row", "_n", *[F.col(f"r.{c}").alias(f"_{c}") for c in ("start", "len", "fp", "windows")]
    )
    prints = known.select("_len", "_fp", F.lit(True).alias("_known")).distinct()
    rows = rows.join(small(prints), ["_len", "_fp"], "left").where("_known or _start < 0")
    rows = rows.select("doc_id", "_row", "_n", "_len", "_start", F.posexplode_outer("_windows").alias("_at", "_window"))
    windows = known.select("_len", "_window", "_item", F.lit(True).alias("_hit")).distinct()
    rows = rows.join(small(windows), ["_len", "_window"], "left").where("_hit or _start < 0")
    start = F.col("_start") + F.col("_at")
    found = F.when(F.col("_start") >= 0, F.struct(start.alias("start"), (start + F.col("_len")).alias("end")))
    rows = rows.groupBy("_row", "doc_id", F.col("_n").cast("bigint").alias("n_words")).agg(
        F.sort_array(F.collect_set(found)).alias("hits"),
        F.sort_array(F.collect_set("_item")).alias("items"),
        F.max(F.expr("cast(_hit and _item is null as int)")).alias("_unnamed"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")),
        lambda acc, h: F.struct(
            (acc["sum"] + F.greatest(h["end"] - F.greatest(h["start"], acc["end"]), F.lit(0))).alias("sum"),
            F.greatest(acc["end"], h["end"]).alias("end"),
        ),
        lambda acc: acc["sum"].cast("bigint"),
    )
    n_items = (F.size("items") + F.coalesce("_unnamed", F.lit(0))).cast("bigint")
    rows = rows.withColumn("n_hit", covered).withColumn("n_items", n_items).drop("_row", "_unnamed")
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    found = contamination(docs.select(F.struct(*row_key()).alias("doc_id"), "text"), benchmark)
    # The keys are counted before they are joined: found once, not twice.
    rejected = checkpointed(found.where("contaminated").select("doc_id.*").distinct())
    return without_keys(docs, rejected)
