"""The trie of conversations against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        convs[c] = tuple((own.get(c - c % 5, [])[:h] if rebuild else []) + turns[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, held in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(held) - 1) * len(key[-1][1].encode()) if key else 0
    return sorted(
        (
            min(held), len(key), min(members[key[:-1]]) if key else None, len(held), len(children[key]), leaves[key],
            saved[key], hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest(),
        )
        for key, held in members.items()
    )


def sorted_rows(df):
    assert df.columns == prefix_trie.RESULT
    return sorted(map(tuple, df.collect()))


def crowd(seed, convs=300, hot=100):
    """Random walks over few texts, with many copies of one conversation and a hot first turn."""
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randrange(1, 9)):
            rows.append((c, t, r.choice(["user", "assistant"]), "hot" if t == 0 and c % 3 else r.choice("abé")))
    for c in range(convs, convs + hot):
        rows += [(c, t, "user", f"same {t} ü") for t in range(12)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "last"), [(prefix_trie.SHARD, prefix_trie.LAST), (20, 300), (4, 1)])
@pytest.mark.parametrize("rebuild", [True, False])
def test_nodes(spark, size, last, rebuild):
    rows = crowd(1)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    how = (lambda c: f"{c} - {c} % 5", prefix_trie.borrowed) if rebuild else ()
    assert sorted_rows(prefix_trie.trie(prefix_trie.paths(table, *how), size, last)) == brute(rows, rebuild)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 3, "a", "x"), (1, 3, "a", "x"), (2, 1, "", ""), (None, 1, "a", "b"), (7, 2, "ab", "c"), (8, 2, "a", "bc")]
    rows += [(9, t, "user", "word " * 4000) for t in range(300)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("other") for c in ("path", "digest", "family", "kind", "size", "n")})
    for how in ((), (lambda c: f"{c} - {c} % 5", prefix_trie.borrowed)):
        assert sorted_rows(prefix_trie.trie(prefix_trie.paths(table, *how))) == brute(rows, bool(how))
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.paths(none)).collect() == []
    assert prefix_trie.trie(prefix_trie.paths(table.where("conv_id is null"))).collect() == []
    # The root is a leaf where no conversation has a turn left.
    alone = [(c, 0, "user", "gone") for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    found = prefix_trie.trie(prefix_trie.paths(spark.createDataFrame(alone, SCHEMA), lambda c: f"{c} - {c} % 5", prefix_trie.borrowed))
    assert sorted_rows(found) == brute(alone) and found.count() == 1


def test_equal_numbers_come_by_digest(spark):
    rows = [(c, 0, "user", t) for c, order in ((1, "xyz"), (2, "zyx")) for t in order]
    found = sorted_rows(prefix_trie.trie(prefix_trie.paths(spark.createDataFrame(rows, SCHEMA))))
    assert [r[3] for r in found] == [2, 2, 2, 2]


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = r.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
        table = prefix_trie.SlotTable(keys)
        assert sorted(table.find(keys)) == list(range(n)) and (table.keys[table.find(keys)] == keys).all()
        assert (table.find(r.integers(0, 1 << 63, (100, 2), dtype=np.uint64)) == -1).all()
    prefix_trie_levels = prefix_trie.SlotTable.LEVELS
    try:
        prefix_trie.SlotTable.LEVELS = 1
        table = prefix_trie.SlotTable(keys)
        assert table.rest and sorted(table.find(keys)) == list(range(n))
    finally:
        prefix_trie.SlotTable.LEVELS = prefix_trie_levels


def test_query_and_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = sorted_rows(queries.op13_prefix_trie(spark, folder))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS FROM '{folder}/conversations.parquet'")
        result = con.sql(queries.ORACLES["op13_prefix_trie"])
        assert result.columns == prefix_trie.RESULT
        assert found == sorted(result.fetchall())
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found == brute(rows)
