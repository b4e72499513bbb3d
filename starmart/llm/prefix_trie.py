"""Trie of conversations: every distinct beginning is a node, with counts over its subtree.

A turn is known by 16 bytes of a SHA-256 of its role and text, the first d turns of a conversation by a digest chained
over them; texts are read once and never move. A conversation is the path of its digests. Paths are sorted over range
partitions, so a subtree is a run of neighbouring rows, however hot its first turns are, and copies of one conversation
are neighbours too, spread over as many partitions as they need.

Tasks cut their rows into shards of about ``SHARD`` digests. Of a shard's distinct digests, ``SlotTable`` makes a minimal
perfect hash: each digest has a slot of its own, and a lookup compares the digest kept there, so none is taken for
another. Counts are scattered into flat arrays by slot, an array holds each slot's parent, and sums are added up
through it, the deepest nodes first. Only the nodes on a shard's first and last path can be shared with other shards.
The others are finished and leave the shard as rows; those two paths leave with what has been added to their nodes so
far, and are the rows of the next round, in which they meet the paths of other shards. Each round keeps two rows of a
shard of ``LEAST_ROWS`` at least; the last one is so small that one task finishes it.

Each round is written to the shared folder. Memory holds one shard and the turns of one family of conversations as
digests, never texts; a conversation is at least as long as its turns' digests, as a text is. A digest over the ids that end in
a node is one pass in the ids' order by nature: shards join ids to texts of up to ``IDS`` ids, and these are hashed one
after another, without holding them.

Null roles and texts count as empty. Turns come by their number, null first; equal numbers by their digest, and repeated
rows are turns like others. Rows without a conversation are left out. Other columns are never read. An empty table gives
no nodes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import small, written

#: Digests of a shard; a shard goes on to ``LEAST_ROWS`` rows if they are longer.
SHARD, LEAST_ROWS = 1 << 18, 8
#: A round over at most so many digests, or ``LEAST_ROWS`` rows, is the last one.
LAST = 1 << 20
#: Ids hashed together.
IDS = 8192
#: Nodes on paths between shards are sent to every executor only if a count shows at most so many (24 bytes each).
FEW_OPEN = 200_000
WIDTH = 16
ROOT = bytes(WIDTH)
MOST = np.iinfo(np.int64).max
SIDES = ("n", "first", "size", "saved", "leaves", "children")
NODE, PATH, ENDS = 0, 1, 2
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ paths of digests


def paths(
    conversations: DataFrame,
    family: Callable[[str], str] | None = None,
    rebuild: Callable[[dict[int, list]], Iterable[tuple[int, list]]] = dict.items,
) -> DataFrame:
    """conv_id, path (digests one after another), sizes (UTF-8 bytes of each turn's text).

    ``family`` turns the name of a column into SQL for the conversations that ``rebuild`` sees together, by default one
    by one; ``rebuild`` takes {conv_id: turns} of a family and gives the turns of each conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.where("conv_id is not null").select(
        F.expr((family or str)("conv_id")).cast("bigint").alias("family"),
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.unhex(F.substring(F.sha2(named, 256), 1, 2 * WIDTH)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    order = ["family", "conv_id", F.col("turn").asc_nulls_first(), "digest"]
    # Sorted rows stream by, so only the digests of one family are held.
    dealt = turns.repartition("family").sortWithinPartitions(*order).drop("turn")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, bytes, list[int]]] = []
        now, held = None, {}

        def close() -> None:
            for conv_id, found in rebuild(held):
                last, path = b"", []
                for digest, _ in found:
                    last = hashlib.sha256(last + digest).digest()[:WIDTH]
                    path.append(last)
                done.append((conv_id, b"".join(path), [size for _, size in found]))
            held.clear()

        def flushed() -> pa.RecordBatch:
            types = [pa.int64(), pa.binary(), pa.list_(pa.int64())]
            columns = zip(*done, strict=True) if done else ([], [], [])
            arrays = [pa.array(v, t) for v, t in zip(columns, types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "path", "sizes"])

        for batch in batches:
            for kin, conv_id, digest, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kin != now:
                    close()
                    now = kin
                held.setdefault(conv_id, []).append((digest, size))
            if len(done) >= 10_000:
                yield flushed()
        close()
        yield flushed()

    return dealt.mapInArrow(chained, "conv_id bigint, path binary, sizes array<bigint>")


def borrowed(turns: dict[int, list]) -> Iterator[tuple[int, list]]:
    """Conversation c with its first crc32(c) % 9 turns taken from conversation c - c % 5."""
    for conv_id, own in turns.items():
        h = zlib.crc32(str(conv_id).encode()) % 9
        # Spark's remainder has the sign of the dividend.
        source = turns.get(conv_id - int(np.fmod(conv_id, 5)), [])
        yield conv_id, source[:h] + own[h:]


# ------------------------------------------------------------------ shards


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each (high, low) pair."""
    x = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(seed * 0xD1B54A32D192ED03 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SlotTable:
    """A minimal perfect hash of distinct 16-byte digests: n digests have the slots 0 to n - 1.

    Each level hashes the digests left over into twice as many places; those alone in their place stay there, and their
    slot is the number of taken places before it.
    """

    LEVELS = 48

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.rest: dict[bytes, int] = {}
        self.keys = np.empty_like(keys)
        left, used = keys, 0
        while len(left) and len(self.levels) < self.LEVELS:
            size = 2 * len(left)
            place = mixed(left, len(self.levels)) % np.uint64(size)
            held = np.bincount(place.astype(np.int64), minlength=size)
            slots = np.where(held == 1, used + np.cumsum(held == 1) - 1, -1)
            self.levels.append(slots)
            slot = slots[place]
            self.keys[slot[slot >= 0]] = left[slot >= 0]
            used += int((slot >= 0).sum())
            left = left[slot < 0]
        for key in left:
            self.keys[used] = key
            self.rest[key.tobytes()] = used
            used += 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for one that is not in the table."""
        found, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, slots in enumerate(self.levels):
            slot = slots[mixed(keys[left], level) % np.uint64(len(slots))]
            found[left[slot >= 0]] = slot[slot >= 0]
            left = left[slot < 0]
        if self.rest:
            found[left] = [self.rest.get(keys[i].tobytes(), -1) for i in left]
        other = (found >= 0) & (self.keys[found] != keys).any(axis=1) if len(self.keys) else found >= 0
        found[other] = -1
        return found


class Shard:
    """Sorted paths with values for each of their nodes, the root first."""

    def __init__(self, size: int = SHARD):
        self.size = size
        self.paths: list[bytes] = []
        self.values: dict[str, list] = {s: [] for s in SIDES}
        self.ends: list[int] = []
        self.digests = 0

    def add(self, path: bytes, values: dict[str, list], end: int | None) -> None:
        self.paths.append(path)
        for side, value in values.items():
            self.values[side] += value
        if end is not None:
            self.ends.append(end)
        self.digests += len(path) // WIDTH + 1

    def full(self) -> bool:
        return self.digests >= self.size and len(self.paths) >= LEAST_ROWS

    def rows(self, last_round: bool) -> Iterator[dict]:
        """Finished nodes, the two outer paths, and the ids that end in nodes of these."""
        depths = np.array([len(p) // WIDTH for p in self.paths])
        starts = np.concatenate([[0], np.cumsum(depths + 1)])
        keys = np.frombuffer(b"".join(ROOT + p for p in self.paths), "<u8").reshape(-1, 2)
        row = np.repeat(np.arange(len(depths)), depths + 1)
        depth = np.arange(len(keys)) - starts[row]
        # Sorted: what the row before does not begin with is new.
        above = starts[row - 1] + depth
        known = (row > 0) & (depth <= depths[row - 1])
        known[known] = (keys[above[known]] == keys[known]).all(axis=1)
        new = np.flatnonzero(~known)
        table = SlotTable(keys[new])
        slots = table.find(keys)
        node = {s: np.zeros(len(new), np.int64) for s in SIDES}
        values = {s: np.array(v, np.int64) for s, v in self.values.items()}
        node["first"][:] = MOST
        np.minimum.at(node["first"], slots, values["first"])
        node["size"][slots] = values["size"]
        for side in ("n", "saved", "leaves", "children"):
            np.add.at(node[side], slots, values[side])
        level, parent = np.zeros(len(new), np.int64), np.full(len(new), -1)
        level[slots[new]] = depth[new]
        below = new[depth[new] > 0]
        parent[slots[below]] = slots[below - 1]
        closed = np.ones(len(new), bool)
        outer = [slots[starts[i] : starts[i + 1]] for i in sorted({0, len(depths) - 1})]
        if not last_round:
            closed[np.concatenate(outer)] = False
        by_level = np.flatnonzero(closed)
        by_level = by_level[np.argsort(level[by_level], kind="stable")]
        cuts = np.searchsorted(level[by_level], np.arange(level.max() + 2))
        for d in range(level.max(), -1, -1):
            at = by_level[cuts[d] : cuts[d + 1]]
            node["saved"][at] += (node["n"][at] - 1) * node["size"][at]
            node["leaves"][at] += node["children"][at] == 0
            if d:
                np.add.at(node["saved"], parent[at], node["saved"][at])
                np.add.at(node["leaves"], parent[at], node["leaves"][at])
                np.add.at(node["children"], parent[at], 1)
        hashes = {}
        if self.ends:
            last = starts[1:] - 1
            begins = np.flatnonzero(~known[last] | (depths != np.concatenate([[-1], depths[:-1]])))
            for a, b in zip(begins, [*begins[1:], len(depths)], strict=True):
                slot = int(slots[last[a]])
                if closed[slot]:
                    hashes[slot] = hashlib.sha256(",".join(map(str, self.ends[a:b])).encode()).hexdigest()
                    continue
                for at in range(a, b, IDS):
                    ids = self.ends[at : min(b, at + IDS)]
                    yield {"kind": ENDS, "digest": table.keys[slot].tobytes(), "conv_id": ids[0], "ids": ",".join(map(str, ids)).encode()}
        first = node["first"].tolist()
        columns = {s: node[s].tolist() for s in ("n", "children", "leaves", "saved")}
        for slot in np.flatnonzero(closed).tolist():
            up = int(parent[slot])
            known_up = up >= 0 and closed[up]
            yield {
                "kind": NODE,
                "conv_id": first[slot],
                "depth": int(level[slot]),
                "parent_conv_id": first[up] if known_up else None,
                "parent": table.keys[up].tobytes() if up >= 0 and not known_up else None,
                "n_convs": columns["n"][slot],
                "n_children": columns["children"][slot],
                "n_leaves": columns["leaves"][slot],
                "saved_tokens": columns["saved"][slot],
                "ends_sha256": hashes.get(slot, NO_ENDS),
                "digest": table.keys[slot].tobytes(),
            }
        if not last_round:
            told = np.zeros(len(new), bool)
            for i, own in zip(sorted({0, len(depths) - 1}), outer, strict=True):
                found = {s: node[s][own] for s in SIDES}
                for side in ("n", "saved", "leaves", "children"):
                    found[side][told[own]] = 0  # the first path carries what both share
                told[own] = True
                if i == 0 or self.paths[i] != self.paths[0]:
                    yield {"kind": PATH, "path": self.paths[i]} | {s: v.tolist() for s, v in found.items()}


FIELDS = {
    "kind": ("int", pa.int32()),
    "conv_id": ("bigint", pa.int64()),
    "depth": ("bigint", pa.int64()),
    "parent_conv_id": ("bigint", pa.int64()),
    "n_convs": ("bigint", pa.int64()),
    "n_children": ("bigint", pa.int64()),
    "n_leaves": ("bigint", pa.int64()),
    "saved_tokens": ("bigint", pa.int64()),
    "ends_sha256": ("string", pa.string()),
    "digest": ("binary", pa.binary()),
    "parent": ("binary", pa.binary()),
    "path": ("binary", pa.binary()),
    "ids": ("binary", pa.binary()),
    **{s: ("array<bigint>", pa.list_(pa.int64())) for s in SIDES},
}
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sharded(rows: DataFrame, size: int, last_round: bool = False) -> DataFrame:
    """``Shard.rows`` of sorted rows: paths of conversations in the first round, outer paths in the others."""
    first_round = "sizes" in rows.columns
    held = shard_fields()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(size)
        for batch in batches:
            for r in batch.to_pylist():
                path = r["path"]
                if first_round:
                    nodes = len(path) // WIDTH + 1
                    zero = [0] * nodes
                    values = {"n": [1] * nodes, "first": [r["conv_id"]] * nodes, "size": [0, *r["sizes"]]}
                    shard.add(path, values | {s: zero for s in ("saved", "leaves", "children")}, r["conv_id"])
                else:
                    shard.add(path, {s: r[s] for s in SIDES}, None)
                if shard.full() and not last_round:
                    yield from batched(shard.rows(False))
                    shard = Shard(size)
        if shard.paths:
            yield from batched(shard.rows(last_round))

    return rows.mapInArrow(work, held)


def shard_fields() -> str:
    return ", ".join(f"{name} {kind}" for name, (kind, _) in FIELDS.items())


def batched(rows: Iterator[dict], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []

    def flushed() -> pa.RecordBatch:
        arrays = [pa.array([r.get(name) for r in held], kind) for name, (_, kind) in FIELDS.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(arrays, list(FIELDS))

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield flushed()
    if held:
        yield flushed()


# ------------------------------------------------------------------ the trie


def trie(found: DataFrame, size: int = SHARD, last: int = LAST) -> DataFrame:
    """The nodes of ``paths``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = found.sparkSession
    # The ranges are taken from a sample of the table, so it is computed once before.
    found = written(spark, found, "trie-paths")
    order = ["path", "conv_id"]
    rounds = [written(spark, sharded(found.repartitionByRange(*order).sortWithinPartitions(*order), size), "trie-round")]
    outer = ["path", *SIDES]
    while True:
        left = rounds[-1].where(f"kind = {PATH}").select(*outer)
        rows, digests = left.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("path") / WIDTH + 1), F.lit(0))).first()
        if not rows:
            break
        last_round = rows <= LEAST_ROWS or digests <= last
        parts = 1 if last_round else max(1, min(int(digests // last), rows // (2 * LEAST_ROWS)))
        dealt = left.coalesce(1) if last_round else left.repartitionByRange(parts, "path")
        rounds.append(written(spark, sharded(dealt.sortWithinPartitions("path"), size, last_round), "trie-round"))
        if last_round:
            break
    finished = [r.where(f"kind = {NODE}").select(*RESULT, "digest", "parent") for r in rounds]
    # Nodes of later rounds lie on paths between shards of the first.
    later = reduce(DataFrame.unionByName, finished[1:]) if finished[1:] else finished[0].limit(0)
    names = small(later.select(F.col("digest").alias("parent"), F.col("conv_id").alias("_named")), FEW_OPEN)
    ends = hashed_ends(rounds[0].where(f"kind = {ENDS}").select("digest", "conv_id", "ids"))
    later = later.join(ends, "digest", "left").withColumn("ends_sha256", F.coalesce("_ends", "ends_sha256"))
    every = finished[0].unionByName(later.select(finished[0].columns))
    whole = every.where("parent is null").select(*RESULT)
    joined = every.where("parent is not null").join(names, "parent").withColumn("parent_conv_id", F.col("_named"))
    return whole.unionByName(joined.select(*RESULT))


def hashed_ends(parts: DataFrame) -> DataFrame:
    """(digest, _ends): SHA-256 of each digest's ids in their order, joined by commas."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def close() -> None:
            if now is not None:
                done.append((now, state.hexdigest()))

        for batch in batches:
            for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if digest != now:
                    close()
                    now, state = digest, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
        close()
        columns = zip(*done, strict=True) if done else ([], [])
        arrays = [pa.array(v, t) for v, t in zip(columns, (pa.binary(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["digest", "_ends"])

    sorted_parts = parts.repartition("digest").sortWithinPartitions("digest", "conv_id").select("digest", "ids")
    return sorted_parts.mapInArrow(hashed, "digest binary, _ends string")
