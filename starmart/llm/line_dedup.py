"""Line dedup: an exact edit-distance join of lines by segments, and the first line of each class stays.

Lines are what newlines separate, without the white space around them. Equal lines are one class; lines of at least
``least_chars`` characters whose edit distance is at most ``edits`` link, and links join classes. Of each class the
first line stays: that of the smallest document id (null last), then the first in its text.

The join. Lengths are dealt into bands. A line of a band is cut into edits + 1 segments of the sizes that the band's
shortest line has, the first half of them counted from the left, the others from the right; what a longer line has more
lies between them. If two lines are within ``edits``, the edits in and before some segment i of the shorter one are i,
all of them before it: the first i for which the edits up to its end are at most i. So the longer line holds that
segment unchanged, moved by i at most, and by edits - i at most if counted from the right. Every line indexes its
segments in its own band; it probes its own band, and the band below if its partners reach there, with those
substrings. Lines that meet in an entry of few lines are compared pair by pair.

An entry of many lines is split: an edit changes the counts of two characters at most, so of 2 * edits + 1 groups of
characters two lines within ``edits`` agree on the counts of one at least, and they meet again under this group. A few
rounds deal out the characters anew; what is then still together is compared pair by pair.

A pair is dropped at the join if the lengths, or the parities of 64 classes of characters or of pairs of neighbours,
differ by more than the edits can change. The rest is verified by a banded bit-parallel edit distance after the common
ends are cut off.

Lines are known by 63 bits of a 64-bit hash. A null text has no lines. White-space lines stay and are no class. Rows
equal in id and text are one document. Other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import small, written
from starmart.llm.components import components
from starmart.llm.shingles import mixed
from starmart.session import checkpointed

EDITS, LEAST_CHARS = 2, 20
#: An index entry of more lines is split; changes the work, not the result.
MANY = 256
#: Rounds in which entries are split; changes the work, not the result.
ROUNDS = 2
#: A band of lengths ends before so many times its start.
BAND = 1.25
INDEXED, PROBES = 1, 0


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of edits + 1 segments, as even as can be, the longer ones last."""
    count = edits + 1
    base, longer = divmod(length, count)
    sizes = [base] * (count - longer) + [base + 1] * longer
    return [(sum(sizes[:i]), n) for i, n in enumerate(sizes)]


def bands(length: int, edits: int) -> list[int]:
    """Shortest lengths of a line's own band and of those below that a line within ``edits`` can lie in."""
    starts = [edits + 1]
    while (after := max(starts[-1] + 1, int(starts[-1] * BAND))) <= length:
        starts.append(after)
    # A band ends where the next one starts; the last one holds the line.
    ends = [*starts[1:], length + 1]
    return [start for start, end in zip(starts, ends, strict=True) if end > length - edits]


def places(length: int, edits: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(role, band, segment number, start, size) of the substrings that a line of a length stands under.

    A segment's own place in the line's own band is index and probe in one entry.
    """
    if length <= edits:
        return
    own = max(bands(length, edits))
    for band in bands(length, edits):
        for i, (start, size) in enumerate(segments(band, edits)):
            place = start if 2 * i <= edits else start + length - band
            reach = min(i, edits - i)
            for at in range(max(place - reach, 0), min(place + reach, length - size) + 1):
                yield (INDEXED if band == own and at == place else PROBES), band, i, at, size


_PLACES: dict[tuple[int, int], list[tuple[int, int, int, int, int]]] = {}


def places_of(length: int, edits: int) -> list[tuple[int, int, int, int, int]]:
    if (length, edits) not in _PLACES:
        if len(_PLACES) > 5000:
            _PLACES.clear()
        _PLACES[length, edits] = list(places(length, edits))
    return _PLACES[length, edits]


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: bit vectors over a band of 2 * edits + 1 diagonals."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    start = 0
    while start < len(a) and a[start] == b[start]:
        start += 1
    ends = 0
    while ends < len(a) - start and a[-1 - ends] == b[-1 - ends]:
        ends += 1
    a, b = a[start : len(a) - ends], b[start : len(b) - ends]
    if not a:
        return len(b) <= edits
    # reach[k]: diagonals (bit d: column - row = d - edits) that k edits reach, each at its furthest; row by row.
    width, band = 2 * edits + 1, (1 << (2 * edits + 1)) - 1
    # Bit d of row i is set in level k if a[:i] and b[: i + d - edits] are within k edits.
    levels = []
    for k in range(edits + 1):
        levels.append(sum(1 << (edits + j) for j in range(k + 1)))
    for i, c in enumerate(a):
        equal = 0
        for d in range(width):
            j = i + d - edits
            if 0 <= j < len(b) and b[j] == c:
                equal |= 1 << d
        new = []
        for k in range(edits + 1):
            # Same diagonal: a match, or a substitution from one level below; deletion of c moves a diagonal down.
            bits = levels[k] & equal
            if k:
                bits |= levels[k - 1] | (levels[k - 1] >> 1)
                # Insertion of a character of b moves a diagonal up within the row.
                bits |= new[k - 1] << 1
            new.append(bits & band)
        levels = new
        if not levels[-1]:
            return False
    return bool(levels[edits] >> (len(b) - len(a) + edits) & 1)


# ---------------------------------------------------------------- lines


def document_key(docs: DataFrame) -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text").cast("string"))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, doc (key of the document), at, line of every line that is not empty."""
    rows = docs.select("doc_id", document_key(docs).alias("doc"), F.split(F.col("text").cast("string"), "\n").alias("_l"))
    rows = rows.select("doc_id", "doc", F.posexplode("_l").alias("at", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(" \t\r\x0b\x0c"))).where("line <> ''")
    return rows


def line_id(line: str = "line") -> Column:
    return F.shiftright(F.xxhash64(line), 1)


def entries(lines: DataFrame, edits: int) -> DataFrame:
    """(key, entry) of lines (id, line): entry is 2 * id + role."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for whole in batches:
            for start in range(0, whole.num_rows, 4000):
                batch = whole.slice(start, 4000)
                keys, ids = [], []
                for i, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    codes = line.encode("utf-32-le", "surrogatepass")
                    for role, band, number, at, size in places_of(len(line), edits):
                        keys.append(digest(codes[4 * at : 4 * (at + size)], (band << 8) ^ number))
                        ids.append(2 * i + role)
                found = pa.array(np.array(keys, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([found, pa.array(ids, pa.int64())], ["key", "entry"])

    return lines.mapInArrow(rows, "key bigint, entry bigint")


# ---------------------------------------------------------------- pairs


SKETCH = ["n", "chars", "grams"]


def code_points(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def parities(values: np.ndarray) -> int:
    """64 bits: whether the number of values of a class is odd."""
    odd = np.bincount((mixed(values) >> np.uint64(58)).astype(np.int64), minlength=64) & 1
    return int(np.packbits(odd.astype(np.uint8)).view(np.int64)[0])


def sketched(lines: DataFrame) -> DataFrame:
    """``lines`` (id, line) with their lengths and the parities of their characters and pairs of neighbours."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [code_points(x) for x in batch.column("line").to_pylist()]
            grams = [(c[:-1] << np.uint64(32)) + c[1:] for c in codes]
            found = [[len(c) for c in codes], [parities(c) for c in codes], [parities(g) for g in grams]]
            columns = [batch.column("id"), batch.column("line"), *(pa.array(x, pa.int64()) for x in found)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "line", *SKETCH])

    return lines.select("id", "line").mapInArrow(rows, "id bigint, line string, n bigint, chars bigint, grams bigint")


def close(edits: int) -> Column:
    """Whether the lines a and b can be within ``edits``: an edit changes two characters and four pairs at most."""
    flips = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    return (F.abs(F.col("n_a") - F.col("n_b")) <= edits) & (flips("chars") <= 2 * edits) & (flips("grams") <= 4 * edits)


def side(rows: DataFrame, name: str, *keep: str) -> DataFrame:
    """``rows`` as one side of a pair: other columns than those to keep get the name as suffix."""
    return rows.select(*[F.col(c).alias(c if c in keep else f"{c}_{name}") for c in rows.columns])


def paired(members: DataFrame, edits: int) -> DataFrame:
    """(a, b), a < b, of lines that meet in an entry, one of them at least as indexed, and can be within ``edits``."""
    met = side(members, "a", "key").join(side(members, "b", "key"), "key")
    a, b = F.shiftright("entry_a", 1), F.shiftright("entry_b", 1)
    # Of two that are both indexed each comes first once.
    once = (a != b) & (F.col("entry_a").bitwiseAND(1) == 1) & ((F.col("entry_b").bitwiseAND(1) == 0) | (a < b))
    return met.where(once & close(edits)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def dealt(members: DataFrame, texts: DataFrame, edits: int, turn: int) -> DataFrame:
    """``members`` of crowded entries under the counts of each of 2 * edits + 1 groups of characters."""
    groups = 2 * edits + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((batch.num_rows, groups), np.uint64)
            for i, line in enumerate(batch.column("line").to_pylist()):
                values = mixed(code_points(line) + np.uint64(turn + 1 << 32))
                group = values % np.uint64(groups)
                sums[i] = [values[group == g].sum(dtype=np.uint64) for g in range(groups)]
            under = batch.column("key").to_numpy().view(np.uint64)[:, None]
            keys = mixed(under ^ mixed(sums + np.arange(1, groups + 1, dtype=np.uint64))).view(np.int64)
            again = batch.select(["entry", *SKETCH]).take(pa.array(np.repeat(np.arange(batch.num_rows), groups)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *again.columns], ["key", "entry", *SKETCH])

    lines = members.withColumn("id", F.shiftright("entry", 1)).join(texts.select("id", "line"), "id")
    kinds = ", ".join(f"{c} bigint" for c in ["key", "entry", *SKETCH])
    return lines.select("key", "entry", *SKETCH, "line").mapInArrow(rows, kinds)


def candidates(spark: SparkSession, docs: DataFrame, edits: int, least_chars: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) of lines that share an index entry and can be within ``edits``; the lines that share entries."""
    if edits >= least_chars:
        raise ValueError("a line that is compared needs a character for each segment")
    lines = lines_of(docs).select(line_id().alias("id"), "line").where(F.length("line") >= least_chars)
    index = written(spark, entries(lines, edits), "entries")
    met = index.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("entry").alias("x"),
        F.max("entry").alias("y"),
        F.max(F.col("entry").bitwiseAND(1)).alias("indexed"),
    )
    met = written(spark, met.where("shiftright(x, 1) <> shiftright(y, 1) and indexed = 1"), "met")
    two = met.where("n = 2").select(F.shiftright("x", 1).alias("a"), F.shiftright("y", 1).alias("b")).distinct()
    members = index.join(small(met.where("n > 2").select("key")), "key").select("key", "entry").distinct()
    members = written(spark, members, "members")
    ids = two.select(F.col("a").alias("id")).union(two.select("b")).union(members.select(F.shiftright("entry", 1)))
    texts = lines.join(small(checkpointed(ids.distinct())), "id", "left_semi").dropDuplicates(["id"])
    texts = written(spark, sketched(texts), "texts")
    sketch = texts.select("id", *SKETCH)
    pairs = two.join(side(sketch, "a").withColumnRenamed("id_a", "a"), "a")
    pairs = pairs.join(side(sketch, "b").withColumnRenamed("id_b", "b"), "b").where(close(edits)).select("a", "b")
    members = members.withColumn("id", F.shiftright("entry", 1)).join(sketch, "id").drop("id")
    members = written(spark, members, "sketched")
    for turn in range(ROUNDS + 1):
        sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n_lines"))
        crowded = checkpointed(sizes.where(F.col("n_lines") > (MANY if turn < ROUNDS else 1 << 62)).select("key"))
        few = members.join(small(crowded), "key", "left_anti")
        pairs = pairs.union(written(spark, paired(few, edits).distinct(), "paired"))
        if crowded.isEmpty():
            break
        split = dealt(members.join(small(crowded), "key"), texts, edits, turn)
        members = written(spark, split.distinct(), "split")
    return pairs.distinct(), texts


def links(spark: SparkSession, docs: DataFrame, edits: int, least_chars: int) -> DataFrame:
    """(a, b) of lines within ``edits``."""
    pairs, texts = candidates(spark, docs, edits, least_chars)
    texts = texts.select("id", "line")
    both = pairs.join(texts.toDF("a", "line_a"), "a").join(texts.toDF("b", "line_b"), "b")

    @F.pandas_udf("boolean")
    def near(a, b):
        import pandas as pd

        return pd.Series([within(x, y, edits) for x, y in zip(a, b, strict=True)], dtype=bool)

    return both.where(near("line_a", "line_b")).select("a", "b")


def dropped_lines(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, dropped): for documents that lose lines, the positions of these lines."""
    spark = docs.sparkSession
    found = links(spark, docs, edits, least_chars)
    classes = checkpointed(components(checkpointed(found)))
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "doc", "at")
    seen = written(spark, lines_of(docs).select(line_id().alias("id"), place.alias("place")), "lines")
    first = seen.groupBy("id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.join(classes.withColumnRenamed("node", "id"), "id", "left")
    first = written(spark, first.where("n > 1 or component is not null"), "first")
    of_class = first.groupBy(F.coalesce("component", "id").alias("c")).agg(F.min("first").alias("stays"))
    repeated = first.select("id", F.coalesce("component", "id").alias("c")).join(of_class, "c").select("id", "stays")
    repeated = checkpointed(repeated)
    lost = seen.join(small(repeated), "id").where("place <> stays").select("place.doc", "place.at").distinct()
    return lost.groupBy("doc").agg(F.collect_list("at").alias("dropped"))


def dedup(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, text (without the lines that went), n_lines (not empty), n_dropped of every row."""
    lost = checkpointed(dropped_lines(docs, edits, least_chars).withColumnRenamed("doc", "_doc"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), document_key(docs).alias("_doc"))
    rows = rows.join(small(lost), "_doc", "left").withColumn("_lines", F.split("text", "\n"))
    full = F.filter("_lines", lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")) != "")
    kept = F.filter("_lines", lambda x, i: ~F.array_contains("dropped", i))
    return rows.select(
        "doc_id",
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(full), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
