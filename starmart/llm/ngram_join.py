"""N-gram Jaccard join by a partition of the universe of shingles, exact, down to connected components.

Two documents link when the Jaccard similarity of their sets of word shingles reaches a threshold. Sets whose
similarity reaches it differ in at most H shingles, where H follows from the sizes. So:

1. Size bands. A pair belongs to the band of its smaller set; a set enters its own band and, if a smaller partner
   can lie there, the band below. Every band has its own H.
2. Segments. In a band all shingles are dealt by hash into more than H + 1 segments. A set of n shingles differs from
   its partners in at most h <= H, so of s segments it agrees with each on s - h at least. It leaves out the s - h - 1
   with the fewest shingles (ties: the first ones), which say least, and indexes h + 1, each by a hash of its shingles.
   No link is lost: segments that two sets agree on stand in the same order in both, so the two leave out only as many
   of these as the one that leaves out more does, which is fewer than they agree on.
   If more segments of a set are empty than it may leave out, it indexes all that are not, and makes up for the empty
   ones: if two such sets agree on t empty segments only, all others differ, and at most t - 1 of them by more than one
   shingle; so one of the first 2t segments differs by exactly one. A set with e empty segments indexes under each of
   them the first 2e segments, whole and less one shingle. If e is over FEW_EMPTY or half the segments, its empty
   segments stay in the index too, and 2 * FEW_EMPTY segments are enough: of two sets one has few, or both agree on an
   entry. Partners that leave segments out leave out all their empty ones, and are found on one that is not.
3. Candidates. First each set of an index entry is paired with one of them, that which stands in most entries and so
   is closest to what they have in common; this joins the bulk of a group of near copies without its pairs. Then, in
   entries of at most MANY sets, the pairs of sets of different components are candidates.
4. Cost-based allocation. Where an entry of many sets still holds several components, the sets outside its largest
   component probe once more: the dearest s - h - 1 segments are skipped, and more where that is cheaper; each of these
   is made up for by another one (of the first eighth) on which one difference is allowed, found by deleting one shingle
   on either side. Costs are the counted sizes of the entries. With v = -1 (skipped), 0 (equal) or 1 (one difference) on
   each segment and the sum of v + 1 at least h + 1, a similar partner is found on some segment; so no link between
   different components is lost.
5. Verification. A pair is dropped at the join if its sizes rule it out, or if the parities of 256 classes of shingles
   differ in more classes than the sets can differ in shingles; then by parities of as many classes as the sets need.
   Where sets probe entries of any size the join itself has 1,024 classes: 256 tell sets of 400 shingles and a
   similarity of 0.7 from links too rarely, so that a large group of them would make pairs with the square of its size.
   The rest is compared exactly, set against set, from texts that move compressed.

Equal sets are one set from the start. Sets are known by a 64-bit id (half of a 128-bit hash of their shingles, which
are 64-bit hashes themselves).

A null or empty text, or one of white space only, has an empty set and links with nothing; a text of fewer words than
a shingle has is one shingle. Ties cannot arise: the component is named by its smallest document id (null ids count
last). Repeated rows link with each other. Other columns are never read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import row_key, small, without_keys, written
from starmart.llm.components import components
from starmart.llm.shingles import mixed, shingle_set
from starmart.session import checkpointed

#: An index entry of more sets is not compared pair by pair; changes the work, not the result.
MANY = 64
#: One segment for so many is added to those that the differences need, to be left out; changes the work, not the result.
SPARE = 4
#: Empty segments of a set that are all made up for by others.
FEW_EMPTY = 3
#: Upper end of a band over its lower end, about.
BAND = 1.5
#: One segment in so many allows a difference where others are skipped; changes the work, not the result.
NEAR = 8
MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; two sets link when 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    def band(self, size: int) -> tuple[int, int]:
        """Lower and upper end of the band of a size."""
        low = 1
        while True:
            high = max(low, int(low * BAND))
            if size <= high:
                return low, high
            low = high + 1

    def differences(self, one: int, two: int) -> int:
        """Shingles in which two sets of these sizes that link can differ."""
        return (one + two) * (100 - self.percent) // (100 + self.percent)

    def segments(self, high: int) -> int:
        """Segments of a band: one more than the shingles in which a pair can differ, and a part of that to spare."""
        needed = self.differences(high, high * 100 // self.percent) + 1
        return needed + needed // SPARE

    def spare(self, size: int, high: int) -> int:
        """Segments of a band that a set may leave out: all but one more than it can differ in from a partner there.

        In a band below its own a set is the larger one of a pair.
        """
        partner = size * 100 // self.percent if size <= high else high
        return self.segments(high) - 1 - self.differences(size, partner)

    def bands(self, size: int) -> list[int]:
        """Upper ends of the bands a set enters."""
        low, high = self.band(size)
        least = -(-size * self.percent // 100)
        ends = [high]
        while least < low and low > 1:
            low, below = self.band(low - 1)
            ends.append(below)
        return ends


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def segment_keys(sums: np.ndarray, segment: np.ndarray, high: int) -> np.ndarray:
    """Index keys of sums of shingles in segments of a band."""
    salt = mixed(segment.astype(np.uint64) + np.uint64(high << 32))
    return mixed(sums ^ salt).view(np.int64)


def dealt(shingles: np.ndarray, high: int, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each shingle and the sum of each segment (modulo 2**64)."""
    count = rule.segments(high)
    segment = (shingles >> np.uint64(8)) % np.uint64(count)
    sums = np.zeros(count, np.uint64)
    np.add.at(sums, segment.astype(np.int64), shingles)
    return segment, sums


def set_keys(shingles: np.ndarray, high: int, rule: Rule) -> np.ndarray:
    """Index keys of a set in a band."""
    segment, sums = dealt(shingles, high, rule)
    count = len(sums)
    held = np.bincount(segment.astype(np.int64), minlength=count)
    filled = held > 0
    empty = np.flatnonzero(~filled)
    spare = rule.spare(len(shingles), high)
    if len(empty) <= spare:
        fullest = np.argsort(held, kind="stable")[spare:]
        return segment_keys(sums[fullest], fullest, high)
    plain = np.arange(count) if len(empty) > min(FEW_EMPTY, count // 2) else np.flatnonzero(filled)
    reach = min(count, 2 * min(FEW_EMPTY, len(empty)))
    front = segment < np.uint64(reach)
    at = segment[front].astype(np.int64)
    first = np.arange(reach)
    values = np.concatenate([sums[first], sums[at] - shingles[front]])
    places = np.concatenate([first, at])
    found = [segment_keys(sums[plain], plain, high)]
    for e in empty:
        found.append(segment_keys(values, places + (int(e) + 1) * count, high))
    return np.concatenate(found)


# ---------------------------------------------------------------- index


#: Columns of 64 classes each.
PARITIES = ["p0", "p1", "p2", "p3"]
FINE = [f"q{i}" for i in range(16)]


def parities(shingles: np.ndarray, columns: list[str] = PARITIES) -> np.ndarray:
    """A bit a class: whether its number of shingles is odd. Each shingle that two sets differ in flips one bit."""
    bits = 64 * len(columns)
    odd = np.bincount((shingles >> np.uint64(65 - bits.bit_length())).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_parities(shingles: np.ndarray) -> bytes:
    """Parities of at least twice as many classes as shingles (a power of two), so that few differences hide."""
    bits = 1 << max(8, (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def flips(a: bytes, b: bytes) -> int:
    """Classes in which two wide parities differ; the longer one is folded to the length of the shorter."""
    one, two = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] ^ two[len(two) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def close(rule: Rule, columns: list[str] = PARITIES) -> Column:
    """Whether the pair of rows a and b can link, by sizes and parities (columns with the suffixes _a and _b)."""
    total = F.col("n_a") + F.col("n_b")
    odd = sum(F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in columns)
    sizes = 100 * F.least("n_a", "n_b") >= rule.percent * F.greatest("n_a", "n_b")
    return sizes & ((100 + rule.percent) * odd <= (100 - rule.percent) * total)


def side(rows: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` as one side of a pair: sid becomes the name, other columns but those to keep get it as suffix."""
    return rows.select(
        *[F.col(c).alias(name if c == "sid" else c if c in keep else f"{c}_{name}") for c in rows.columns]
    )


def described(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, text_key, n_shingles, sid, parities, wide parities, keys (index entries of the set) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, int] = {}
        for batch in batches:
            # Some rows at a time, as the keys of a whole batch may be many.
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes, sids, keys, odd, wide = [], [], [], [], []
                for text in part.column("text").to_pylist():
                    shingles = shingle_set(text, rule.words)
                    sizes.append(len(shingles))
                    sids.append(set_id(shingles) if len(shingles) else None)
                    odd.append(parities(shingles))
                    wide.append(wide_parities(shingles))
                    found = [np.zeros(0, np.int64)]
                    for high in rule.bands(len(shingles)) if len(shingles) else []:
                        # One segment: only equal sets can link, and these are one set already.
                        if cache.setdefault(high, rule.segments(high)) > 1:
                            found.append(set_keys(shingles, high, rule))
                    keys.append(np.concatenate(found))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(sizes, pa.int64()),
                        pa.array(sids, pa.int64()),
                        *map(pa.array, np.stack(odd, axis=1)),
                        pa.array(wide, pa.binary()),
                        lists,
                    ],
                    ["doc_id", "text_key", "n_shingles", "sid", *PARITIES, "wide", "keys"],
                )

    text = F.col("text").cast("string")
    named = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    sketch = ", ".join(f"{p} bigint" for p in PARITIES)
    return named.mapInArrow(
        rows, f"doc_id {kind}, text_key bigint, n_shingles bigint, sid bigint, {sketch}, wide binary, keys array<bigint>"
    )


# ---------------------------------------------------------------- verification


def plausible(pairs: DataFrame, narrow: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that wide parities do not rule out: a set's parities are an eighth of its text, about."""
    wide = narrow.join(small(checkpointed(ends(pairs))), "sid", "left_semi")
    wide = wide.select("sid", F.col("n_shingles").alias("n"), "wide").dropDuplicates(["sid"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "wide_a", "wide_b"))
            found = [
                (100 + rule.percent) * flips(a, b) <= (100 - rule.percent) * (n + m)
                for n, m, a, b in zip(*columns, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return pairs.join(side(wide, "a"), "a").join(side(wide, "b"), "b").mapInArrow(rows, "a bigint, b bigint")


def ends(pairs: DataFrame) -> DataFrame:
    """(sid) of the sets in pairs."""
    return pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()


def packed(text: str) -> bytes:
    """A text as it is moved about: compressed, as hashed shingles take more bytes than it and do not compress."""
    return zstandard.compress(text.encode("utf-8"))


def unpacked(held: bytes, rule: Rule) -> np.ndarray:
    """The set of a packed text."""
    return shingle_set(zstandard.decompress(held).decode("utf-8"), rule.words)


def sets_of(docs: DataFrame, narrow: DataFrame, sids: DataFrame, rule: Rule) -> DataFrame:
    """(sid, packed) of the given sets, from one text of each."""
    chosen = narrow.join(sids, "sid").groupBy("sid").agg(F.min("text_key").alias("text_key"))
    chosen = checkpointed(chosen.select("text_key").distinct())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                texts = batch.column("text").slice(at, 200).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_id(shingle_set(t, rule.words)) for t in texts], pa.int64()),
                        pa.array(map(packed, texts), pa.binary()),
                    ],
                    ["sid", "packed"],
                )

    text = F.col("text").cast("string")
    texts = docs.select(text.alias("text"), F.xxhash64(text).alias("text_key"))
    texts = texts.where("text is not null").join(small(chosen), "text_key", "left_semi").select("text")
    return texts.mapInArrow(rows, "sid bigint, packed binary").dropDuplicates(["sid"])


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    both = pairs.join(side(sets, "a"), "a").join(side(sets, "b"), "b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Neighbouring rows often share a set.
        last: dict[str, tuple[int, np.ndarray]] = {}

        def held(name: str, sid: int, value: pa.Scalar) -> np.ndarray:
            if name not in last or last[name][0] != sid:
                last[name] = sid, unpacked(value.as_py(), rule)
            return last[name][1]

        for batch in batches:
            ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            keep = []
            for i, (a, b) in enumerate(ids):
                one = held("a", a, batch.column("packed_a")[i])
                two = held("b", b, batch.column("packed_b")[i])
                common = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * common >= rule.percent * (len(one) + len(two) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return both.select("a", "b", "packed_a", "packed_b").mapInArrow(rows, "a bigint, b bigint")


# ---------------------------------------------------------------- allocation


def near_segments(count: int) -> int:
    """How many of the segments, the first ones, may allow one difference. Only these need one-deletion entries."""
    return min(count, max(2, count // NEAR))


def neighbourhoods(sets: DataFrame, rule: Rule) -> DataFrame:
    """(sid, band, segment, deleted, key): index entries of whole segments and of near segments less one shingle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, held in zip(batch.column("sid").to_pylist(), batch.column("packed"), strict=True):
                shingles = unpacked(held.as_py(), rule)
                for high in rule.bands(len(shingles)):
                    segment, sums = dealt(shingles, high, rule)
                    segment = segment.astype(np.int64)
                    near = segment < near_segments(len(sums))
                    less = sums[segment[near]] - shingles[near]
                    segments = np.concatenate([np.arange(len(sums)), segment[near]])
                    keys = segment_keys(np.concatenate([sums, less]), segments, high)
                    n = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, sid, np.int64)),
                            pa.array(np.full(n, high, np.int32)),
                            pa.array(segments.astype(np.int32)),
                            pa.array(np.arange(n) >= len(sums)),
                            pa.array(keys),
                        ],
                        ["sid", "band", "segment", "deleted", "key"],
                    )

    return sets.mapInArrow(rows, "sid bigint, band int, segment int, deleted boolean, key bigint")


def finely(sets: DataFrame, rule: Rule) -> DataFrame:
    """(sid, fine parities) of the given sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = [parities(unpacked(held.as_py(), rule), FINE) for held in batch.column("packed")]
            columns = map(pa.array, np.array(odd, np.int64).reshape(-1, len(FINE)).T.copy())
            yield pa.RecordBatch.from_arrays([batch.column("sid"), *columns], ["sid", *FINE])

    return sets.mapInArrow(rows, "sid bigint, " + ", ".join(f"{q} bigint" for q in FINE))


def allocated(costs: list[tuple[int, int, int]], spare: int = 0) -> list[tuple[int, int]]:
    """(segment, v) of the segments that are not skipped, from (segment, cost of v = 0, cost of v = 1).

    Skips the dearest ``spare`` segments. Starts from v = 0 on the others and, while it saves, skips the dearest segment
    left and allows one difference on the segment where that costs least more; the sum of v + 1 stays what it was.
    """
    dear = sorted(costs, key=lambda c: -c[1])
    level = {s: -1 if i < spare else 0 for i, (s, _, _) in enumerate(dear)}
    cheap = sorted(costs, key=lambda c: c[2] - c[1])
    at = 0
    for segment, equal, _ in dear:
        if level[segment]:
            continue
        while at < len(cheap) and (level[cheap[at][0]] or cheap[at][0] == segment):
            at += 1
        if at == len(cheap) or cheap[at][2] - cheap[at][1] >= equal:
            break
        level[segment], level[cheap[at][0]] = -1, 1
    return [(s, v) for s, v in level.items() if v >= 0]


def probes(index: DataFrame, sets: DataFrame, probers: DataFrame, rule: Rule) -> DataFrame:
    """(sid, key, v, deleted): what the probing sets look up, by the cheapest allocation for each set and band.

    A segment costs the sets that hold it whole, and with v = 1 also those that hold it less one shingle.
    """
    counts = index.groupBy("key").agg(
        F.count(F.when(~F.col("deleted"), 1)).alias("whole"), F.count(F.when(F.col("deleted"), 1)).alias("less")
    )
    own = index.where("not deleted").join(small(probers), "sid", "left_semi").join(counts, "key")
    # As many segments as the set has in its bands.
    own = own.groupBy("sid").agg(F.collect_list(F.struct("band", "segment", "whole", "less")).alias("costs"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = zip(*(batch.column(c) for c in ("sid", "packed", "costs")), strict=True)
            for sid, held, costs in listed:
                shingles = unpacked(held.as_py(), rule)
                by_band: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
                for c in costs.as_py():
                    by_band[c["band"]].append((c["segment"], c["whole"], c["whole"] + c["less"]))
                for high, cost in by_band.items():
                    reach = near_segments(len(cost))
                    cost = [(s, equal, near if s < reach else MASK) for s, equal, near in cost]
                    segment, sums = dealt(shingles, high, rule)
                    segment = segment.astype(np.int64)
                    level = np.full(len(sums), -1)
                    for place, v in allocated(cost, rule.spare(len(shingles), high)):
                        level[place] = v
                    whole = np.flatnonzero(level >= 0)
                    near = level[segment] == 1
                    places = np.concatenate([whole, segment[near]])
                    values = np.concatenate([sums[whole], sums[segment[near]] - shingles[near]])
                    columns = [
                        pa.array(np.full(len(places), sid.as_py(), np.int64)),
                        pa.array(segment_keys(values, places, high)),
                        pa.array(level[places].astype(np.int32)),
                        pa.array(np.arange(len(places)) >= len(whole)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["sid", "key", "v", "deleted"])

    return sets.join(own, "sid").mapInArrow(rows, "sid bigint, key bigint, v int, deleted boolean")


def probed(
    index: DataFrame, sets: DataFrame, probers: DataFrame, owner: DataFrame, rule: Rule
) -> DataFrame:
    """Pairs (a, b) of sets of different components that the probing sets find in the index and that can link.

    ``owner``: (sid, component, n, fine parities) of the sets in the index.
    """
    one = side(probes(index, sets, probers, rule).join(owner, "sid"), "a", ("key",))
    two = side(index.select("sid", "key", "deleted").join(owner, "sid"), "b", ("key",))
    allowed = ~(F.col("deleted_a") & F.col("deleted_b")) & ((F.col("v_a") == 1) | ~F.col("deleted_b"))
    met = one.join(two, "key").where(allowed & (F.col("component_a") != F.col("component_b")) & close(rule, FINE))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


# ---------------------------------------------------------------- the join


def linked_sets(spark: SparkSession, docs: DataFrame, narrow: DataFrame, rule: Rule) -> DataFrame:
    """(node, component) of the sets that link with another set. ``narrow``: described(docs), written."""
    entries = narrow.where("sid is not null").select(F.explode("keys").alias("key"), "sid")
    met = entries.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("sid").alias("a"), F.max("sid").alias("b")
    )
    met = written(spark, met.where("a <> b"), "met")
    sketch = narrow.where("sid is not null").select("sid", F.col("n_shingles").alias("n"), *PARITIES)
    sketch = sketch.dropDuplicates(["sid"])
    # Entries of two sets are their pair; larger ones need their members.
    two = met.where("n = 2").select("a", "b").distinct()
    two = two.join(side(sketch, "a"), "a").join(side(sketch, "b"), "b").where(close(rule)).select("a", "b")
    members = entries.join(small(met.where("n > 2").select("key")), "key").select("key", "sid").distinct()
    members = written(spark, members.join(sketch, "sid"), "members")
    common = members.groupBy("sid").agg(F.count(F.lit(1)).alias("w"))
    sizes = members.join(common, "sid").groupBy("key").agg(
        F.count(F.lit(1)).alias("n_sets"), F.max_by(F.struct("sid", "n", *PARITIES), F.struct("w", "sid")).alias("c")
    )
    sizes = written(spark, sizes, "sizes")
    centre = side(sizes.select("key", "c.*"), "a", ("key",))
    stars = side(members, "b", ("key",)).join(centre, "key").where((F.col("a") != F.col("b")) & close(rule))
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(spark, two.union(stars).distinct(), "pairs")
    links = linking(spark, docs, narrow, pairs, rule)
    found = checkpointed(components(links))

    # Entries that are not one component yet.
    parts = members.join(found.withColumnRenamed("node", "sid"), "sid", "left")
    parts = parts.withColumn("component", F.coalesce("component", "sid"))
    open_keys = parts.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    parts = parts.join(open_keys.select("key"), "key").join(sizes.select("key", "n_sets"), "key")
    parts = written(spark, parts, "open")
    few = parts.where(F.col("n_sets") <= MANY).drop("n_sets")
    apart = (F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b")) & close(rule)
    paired = side(few, "a", ("key",)).join(side(few, "b", ("key",)), "key").where(apart).select("a", "b").distinct()
    paired = written(spark, paired.join(pairs, ["a", "b"], "left_anti"), "paired")
    links = links.union(linking(spark, docs, narrow, paired, rule))
    tried = pairs.union(paired)
    crowd = checkpointed(parts.where(F.col("n_sets") > MANY).drop("n_sets"))
    owner = checkpointed(crowd.drop("key").dropDuplicates(["sid"]))
    if owner.isEmpty():
        return components(links)
    weight = owner.groupBy("component").agg(F.count(F.lit(1)).alias("w"))
    crowd = crowd.select("key", "sid", "component").join(weight, "component")
    # Of two components in an entry one at most is its largest, so of two sets one at least probes.
    largest = crowd.groupBy("key").agg(F.max(F.struct("w", "component")).alias("top"))
    outside = crowd.join(largest, "key").where("component <> top.component")
    probers = checkpointed(outside.select("sid").distinct())
    sets = written(spark, sets_of(docs, narrow.select("sid", "text_key"), owner.select("sid"), rule), "crowd_sets")
    index = written(spark, neighbourhoods(sets, rule), "neighbourhoods")
    owner = checkpointed(owner.drop(*PARITIES).join(finely(sets, rule), "sid"))
    candidates = probed(index, sets, probers, owner, rule).join(tried, ["a", "b"], "left_anti")
    candidates = plausible(written(spark, candidates, "candidates"), narrow, rule)
    return components(links.union(written(spark, verified(candidates, sets, rule), "links")))


def linking(spark: SparkSession, docs: DataFrame, narrow: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs whose sets link, written."""
    pairs = written(spark, plausible(pairs, narrow, rule), "plausible")
    sets = written(spark, sets_of(docs, narrow.select("sid", "text_key"), ends(pairs), rule), "sets")
    return written(spark, verified(pairs, sets, rule), "links")


def join(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept, text_key.

    ``component_id`` is the smallest document id reachable by links. ``kept`` is true for the rows that stand for
    their component: those with the smallest (id, text); rows equal in both stay together.
    """
    spark = docs.sparkSession
    narrow = written(spark, described(docs, rule), "described")
    found = linked_sets(spark, docs, narrow, rule).select(F.col("node").alias("sid"), "component")
    rows = narrow.select("doc_id", "text_key", "n_shingles", "sid")
    rows = rows.join(found, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), F.col("text_key").alias("t"))
    named = rows.where("component is not null").groupBy("component").agg(F.min(order).alias("first"))
    rows = rows.join(named, "component", "left")
    alone = F.col("component").isNull()
    return rows.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.id")).alias("component_id"),
        (alone | F.col("first").eqNullSafe(order)).alias("kept"),
        "text_key",
    )


def dedup(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` that stand for their component, as they are."""
    rows = docs.select(F.struct(*row_key()).alias("doc_id"), "text")
    rejected = join(rows, rule).where("not kept").select("doc_id.*").distinct()
    # The keys are counted before they are joined: found once, not twice.
    return without_keys(docs, checkpointed(rejected))
