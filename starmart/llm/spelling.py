"""Spelling variants: words that differ by one inserted, deleted or replaced letter, grouped under the frequent form.

Near words are found by pivotal grams. Bigrams have one order, the rarest first. A word's prefix is its three first
bigrams in it, and all others as rare as the last of these. Three bigrams hold two that do not overlap: dynamic
programming over the prefix chooses such a pair, the pivots, of the least expected number of matches. One edit spares
one of the pivots; if the other word's prefix ends no earlier in the order, it holds the spared one. So every near pair
meets where the pivots of one word are looked up among the prefixes of the others, and no other bigrams are indexed.

An edit behind the left pivot leaves everything up to it in place, an edit before the right pivot everything from there
on. That fixes the positions: the left pivot must stand equally far from the start, the right one from the end. The side
that holds the edit differs in length by one letter at most and keeps one of its halves; that half and the length are
part of the entry. Whatever meets is verified by the edit distance, so entries decide what work is done, not the result.

Bigrams are counted over all words. There are at most 90 letters, so at most 8,100 bigrams, and their counts fit in each
task. Everything else is joined and summed by Spark. The table of words is written to the shared folder.

Null texts have no words; a null document id counts as an empty one. Repeated rows count as often as they occur. Of near
words equally frequent the first in code-point order is the form. Other columns are never read; an empty table gives no
words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ascii_lower, small, written

LETTERS = "A-Za-zÀ-ÿ"
#: Links from words to their forms are sent to every executor only if a count shows at most so many (two words each).
FEW_LINKS = 200_000
#: What a known letter more is taken to divide the number of matches by; it guides the choice of pivots only.
PER_LETTER = 4.0


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word): every maximal run of letters in every text, A to Z lowered."""
    found = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]+"), F.lit(0)))
    return docs.select(F.col(id_col).alias("doc_id"), found.alias("word")).withColumn("word", ascii_lower(F.col("word")))


def misspelled(doc_id: Column, word: Column, one_in: int = 199) -> Column:
    """The word less one letter where its hash with the document's id is divisible by ``one_in``."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word)
    h = F.crc32(named.cast("binary"))
    at = (h % F.length(word)).cast("int")
    less = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % one_in == 0, less).otherwise(word)


def counted(words: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """(word, n) of the words long and frequent enough. Tasks count first, so a hot word is one row of each."""
    if least_length < 4:
        raise ValueError("words of three letters have no two bigrams that do not overlap")
    long = words.where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# ------------------------------------------------------------------ pivots and prefixes


def prefix(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[int], int]:
    """Places of the prefix bigrams, ascending, and the last one's place in the order."""
    ranks = [order[word[i : i + 2]][0] for i in range(len(word) - 1)]
    last = sorted(ranks)[min(2, len(ranks) - 1)]
    return [i for i, r in enumerate(ranks) if r <= last], last


def pivots(word: str, places: list[int], order: dict[str, tuple[int, int]]) -> tuple[int, int]:
    """Two places of bigrams that do not overlap, the left for edits behind it, the right for edits before it."""
    size = len(word)

    def cost(at: int, known: int) -> float:
        # Half of the letters on the side of the edit are known too.
        return order[word[at : at + 2]][1] * PER_LETTER ** -(known + (size - 2 - known) // 2)

    best, chosen = (float("inf"), -1), (float("inf"), -1, -1)
    waiting = 0
    for right in places:
        # The cheapest left pivot that ends before this bigram.
        while places[waiting] + 2 <= right:
            left = places[waiting]
            best = min(best, (cost(left, left), left))
            waiting += 1
        if best[1] >= 0:
            chosen = min(chosen, (best[0] + cost(right, size - 2 - right), best[1], right))
    return chosen[1], chosen[2]


def sides(word: str, at: int) -> tuple[tuple[str, str, str], tuple[str, str, str]]:
    """What a bigram splits: (side of the edit, what is equal, what holds the edit)."""
    return (">", word[: at + 2], word[at + 2 :]), ("<", word[at:], word[:at])


def prefix_keys(word: str, places: list[int]) -> Iterator[str]:
    """Entries under which the word is found."""
    for at in places:
        for side, same, zone in sides(word, at):
            half = len(zone) // 2
            yield f"{side}{len(zone)} {same} {zone[:half]}-"
            yield f"{side}{len(zone)} {same} -{zone[half:]}"


def pivot_keys(word: str, left: int, right: int) -> Iterator[str]:
    """Entries of the words that differ from this one by an edit."""
    for side, same, zone in (sides(word, left)[0], sides(word, right)[1]):
        size = len(zone)
        for other in range(max(0, size - 1), size + 2):
            half = other // 2
            if half <= size:
                yield f"{side}{other} {same} {zone[:half]}-"
            if other - half <= size:
                yield f"{side}{other} {same} -{zone[size - other + half :]}"


def entries(words: DataFrame, order: dict[str, tuple[int, int]], index: bool) -> DataFrame:
    """(key, word, n, last) of every word: those of its prefix, or of its pivots."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                keys, own, lasts = [], [], []
                for i, word in enumerate(part.column("word").to_pylist()):
                    places, last = prefix(word, order)
                    found = prefix_keys(word, places) if index else pivot_keys(word, *pivots(word, places, order))
                    before = len(keys)
                    keys += dict.fromkeys(found)
                    own += [i] * (len(keys) - before)
                    lasts += [last] * (len(keys) - before)
                rows = part.take(pa.array(own, pa.int32()))
                arrays = [pa.array(keys, pa.string()), *rows.columns, pa.array(lasts, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "word", "n", "last"])

    found = words.mapInArrow(made, "key string, word string, n bigint, last int")
    return found.withColumn("key", F.xxhash64("key"))


def few_or_sorted(df: DataFrame) -> DataFrame:
    """``df`` to be sent to every executor if a count shows few links, else to be joined by sorting.

    Spark would go by the size of compressed files, which is a fraction of what the driver would have to hold.
    """
    found = small(df, FEW_LINKS)
    return df.hint("merge") if found is df else found


def near(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every two words one edit apart, in both directions, once each.

    Entries are joined by sorting whatever Spark takes their size to be: it does not see that Python makes dozens of a word.
    """
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    counts = sorted((r["count"], r["gram"]) for r in grams.groupBy("gram").count().collect())
    order = {gram: (rank, count) for rank, (count, gram) in enumerate(counts)}
    one = entries(words, order, index=False)
    two = entries(words, order, index=True).toDF("key", "other", "other_n", "other_last")
    apart = F.expr("levenshtein(word, other, 1) = 1")
    met = one.hint("merge").join(two.hint("merge"), "key").where((F.col("last") <= F.col("other_last")) & (F.col("word") != F.col("other")) & apart)
    met = met.select("word", "n", "other", "other_n")
    return met.union(met.select("other", "other_n", "word", "n")).distinct()


# ------------------------------------------------------------------ forms and roots


def variants(words: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every (word, n) row of ``counted``.

    The form is the most frequent near word if it is at least ``times`` as frequent as the word.
    """
    words = written(words.sparkSession, words, "words")
    best = F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), "other"))
    known = near(words).groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    frequent = F.col("best.other_n") >= times * F.col("n")
    forms = known.select(
        "word",
        "n_near",
        F.when(frequent, F.col("best.other")).alias("form"),
        F.when(frequent, F.col("best.other_n")).alias("form_n"),
    )
    forms = written(words.sparkSession, forms, "forms")
    found = words.join(few_or_sorted(forms), "word", "left")
    roots = rooted(forms.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(few_or_sorted(roots), "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        "form_n",
    )


def rooted(links: DataFrame) -> DataFrame:
    """(word, root) with every root followed to the end.

    Each round doubles the steps taken; a form is several times as frequent as its word, so chains are short.
    """
    while True:
        links = written(links.sparkSession, links, "roots")
        on = few_or_sorted(links.select(F.col("word").alias("root"), F.col("root").alias("_next")))
        followed = links.join(on, "root", "left")
        if followed.where("_next is not null").isEmpty():
            return links
        links = followed.select("word", F.coalesce("_next", "root").alias("root"))


def group(docs: DataFrame, alter: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``variants`` of the words of all texts; ``alter`` takes doc_id and word and gives the word to count."""
    words = runs(docs)
    if alter:
        words = words.withColumn("word", alter(F.col("doc_id"), F.col("word")))
    return variants(counted(words))
