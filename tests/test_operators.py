"""Operators against brute force, with one key holding a third of the rows."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from starmart.operators import dedupe, drilldown, intervals, lookup, median, ranking, series


@pytest.fixture(scope="module")
def skewed(spark):
    """(key, value, id): key 0 holds a third of the rows, some keys are NULL, values tie."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rng.choice([None, *range(1, 40)])
        rows.append((key, rng.choice([None, *[round(rng.uniform(0, 50), 1)] * 20]), i))
    return rows, spark.createDataFrame(rows, "key int, value double, id int").repartition(6).cache()


def groups(rows):
    out = {}
    for key, value, i in rows:
        out.setdefault(key, []).append((value, i))
    return out


def test_numbered_within_groups(skewed):
    rows, df = skewed
    got = {(r.key, r.id): r.n for r in ranking.numbered(df, "n", [F.desc_nulls_last("value"), F.asc("id")], ["key"]).collect()}
    assert len(got) == len(rows)
    for key, members in groups(rows).items():
        ordered = sorted(members, key=lambda m: (m[0] is None, -(m[0] or 0), m[1]))
        assert [got[key, i] for _, i in ordered] == list(range(1, len(members) + 1))


def test_numbered_whole_table(skewed):
    rows, df = skewed
    got = sorted((r.n, r.id) for r in ranking.numbered(df, "n", [F.desc("id")]).collect())
    assert got == [(n, 2999 - (n - 1)) for n in range(1, 3001)]


def test_group_median(skewed):
    rows, df = skewed
    got = {r.key: r.m for r in median.group_median(df, ["key"], "value", "m").collect()}
    for key, members in groups(rows).items():
        present = [v for v, _ in members if v is not None]
        if present:
            assert got[key] == pytest.approx(statistics.median(present), abs=1e-12)
        else:
            assert key not in got


def test_group_median_beyond_the_exact_range_of_the_sketch(spark):
    df = spark.range(300_001).select((F.col("id") % 2).alias("g"), F.pow("id", F.lit(2)).alias("v")).repartition(6)
    got = {r.g: r.m for r in median.group_median(df, ["g"], "v", "m").collect()}
    assert got == {0: float(150_000**2), 1: (149_999**2 + 150_001**2) / 2}


def test_a_hot_group_is_ranked_in_a_slice_only(spark):
    """A group of 10^6 distinct values: no task ranks more than a partition's share of them."""
    hot = spark.range(1_000_000).select(F.lit("hot").alias("g"), F.xxhash64("id").alias("v"))
    rest = spark.range(3_000).select(F.concat(F.lit("g"), (F.col("id") % 300).cast("string")).alias("g"), F.col("id").alias("v"))
    df = hot.unionByName(rest)
    left = median.middle_rows(df, ["g"], "v", parts=40)
    share = left.groupBy("_part", "g").count().agg(F.max("count")).first()[0]
    assert share < 1_003_000 / 40  # in fact a share of the values inside the bracket
    assert left.where("g = 'hot'").select("_part").distinct().count() <= 2
    got = {r.g: r.m for r in median.group_median(df, ["g"], "v", "m", parts=40).collect()}
    expected = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got.keys() == expected.keys() and all(got[g] == pytest.approx(expected[g]) for g in got)
    windows = [w for w in plan(median.group_median(df, ["g"], "v", "m", parts=40)).split("\n") if "Window [" in w]
    # Values are ordered inside (partition, group) only; a group as such is ordered by its partitions.
    assert windows and all("_part" in w for w in windows if "_value" in w)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first(skewed):
    rows, df = skewed
    got = {r.key: (r.id, r[dedupe.COPIES]) for r in dedupe.keep_first(df, ["key"], "id").collect()}
    expected = {k: (min(i for _, i in m), len(m)) for k, m in groups(rows).items()}
    assert got == expected
    counts = dedupe.removed_count(dedupe.keep_first(df, ["key"], "id")).first()
    assert tuple(counts) == (3000, len(expected), 3000 - len(expected))


@pytest.mark.parametrize("bits", [dedupe.MOST_BITS, dedupe.BITMAP])
def test_keep_first_against_brute_force(spark, monkeypatch, bits):
    """A hot key, null keys, keys that occur once, equal ordinals, two key columns; marks that many keys share."""
    monkeypatch.setattr(dedupe, "MOST_BITS", bits)
    monkeypatch.setattr(dedupe, "BITS_A_KEY", 1 if bits == dedupe.BITMAP else dedupe.BITS_A_KEY)
    rng = random.Random(11)
    rows = []
    for i in range(40_000):
        key = ("hot", 0) if i % 3 == 0 else (None, rng.choice([None, 1])) if i % 50 == 1 else (f"k{rng.randrange(60_000)}", i % 2)
        rows.append((*key, rng.randrange(5000), f"row {i}"))
    df = spark.createDataFrame(rows, "a string, b int, at int, rest string").repartition(7)
    found = dedupe.keep_first(df, ["a", "b"], "at")
    assert found.columns == [*df.columns, dedupe.COPIES]
    least, copies = {}, {}
    for a, b, at, _ in rows:
        least[a, b] = min(least.get((a, b), at), at)
        copies[a, b] = copies.get((a, b), 0) + 1
    got = found.collect()
    assert len(got) == len(least)
    known = set(rows)
    for r in got:
        assert (r.at, r[dedupe.COPIES]) == (least[r.a, r.b], copies[r.a, r.b]) and tuple(r)[:4] in known


def test_unique_rows_do_not_shuffle(spark, tmp_path):
    ids = F.col("id")
    df = spark.range(100_000).select(F.when(ids < 30_000, F.lit(-1)).otherwise(ids).alias("k"), ids.alias("at"), F.repeat(ids.cast("string"), F.lit(9)).alias("wide"))
    df.repartition(6).write.parquet(str(tmp_path / "t"))
    found = dedupe.keep_first(spark.read.parquet(str(tmp_path / "t")), ["k"], "at")
    assert found.count() == 70_001 and "SortAggregate" not in plan(found)
    executed = found.select("*")
    executed.collect()
    # Only the first row of the hot key in each task reaches the exchange of wide rows.
    nodes = spark_nodes(executed)
    wide = [rows for name, rows, text in nodes if name == "Exchange" and "hashpartitioning(k" in text and "rows" in text]
    assert "WindowGroupLimit" in plan(found)
    assert all(rows <= 8 for rows in wide)


def spark_nodes(df):
    """(name, shuffle records written, text) of the executed plan's exchanges."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            metric = node.metrics().get("shuffleRecordsWritten")
            found.append((name, metric.get().value() if metric.isDefined() else 0, f"rows {node.simpleString(200)}"))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def shuffled_bytes(spark):
    """Bytes in shuffle files that were not removed; a count leaves some dozens."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data"))


def repeated_rows(spark, path):
    """Keys of two columns, nulls among them, one to four times each."""
    rng = random.Random(5)
    rows = [(rng.choice([None, f"k{rng.randrange(900)}"]), rng.choice([None, 1, 2]), i, f"row {i}") for i in range(4_000)]
    spark.createDataFrame(rows, "a string, b int, at int, rest string").repartition(5).write.parquet(path)
    least, copies = {}, {}
    for a, b, at, rest in rows:
        least.setdefault((a, b), (a, b, at, rest))
        copies[a, b] = copies.get((a, b), 0) + 1
    return spark.read.parquet(path), {(*row, copies[key]) for key, row in least.items()}


def test_kept_rows_shuffle_once(spark, tmp_path, monkeypatch):
    df, expected = repeated_rows(spark, str(tmp_path / "t"))
    monkeypatch.setattr(dedupe, "FEW_KEYS", 0)
    before = shuffled_bytes(spark)
    found = dedupe.keep_first(df, ["a", "b"], "at")
    assert shuffled_bytes(spark) < before + 1_000
    assert {tuple(r) for r in found.collect()} == expected
    executed = found.select("*")
    executed.collect()
    # The marked rows, and the counts of their keys.
    assert sum(name == "Exchange" and "hashpartitioning" in text for name, _, text in spark_nodes(executed)) == 2


def test_slices_of_repeated_keys(spark, tmp_path, monkeypatch):
    df, expected = repeated_rows(spark, str(tmp_path / "t"))
    monkeypatch.setattr(dedupe, "SLICE_KEYS", 300)
    before = shuffled_bytes(spark)
    found = dedupe.keep_first(df, ["a", "b"], "at")
    assert shuffled_bytes(spark) < before + 1_000 and "Exchange hash" not in plan(found)
    assert found.columns == [*df.columns, dedupe.COPIES] and {tuple(r) for r in found.collect()} == expected


def test_keep_first_of_nothing(spark):
    empty = spark.createDataFrame([], "k int, at int")
    assert dedupe.keep_first(empty, ["k"], "at").collect() == []
    assert tuple(dedupe.removed_count(dedupe.keep_first(empty, ["k"], "at")).first()) == (0, 0, 0)


def test_completeness_of_nothing_is_one(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert empty.agg(dedupe.completeness(["a", "b"])).first()[0] == 1.0


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 4), ("a", 3), ("b", 1)], "g string, v int")
    got = sorted((r.g, r.v, r.r) for r in ranking.top_ranked(df, ["g"], [F.desc("v")], 3, "r").collect())
    assert got == [("a", 4, 3), ("a", 5, 1), ("a", 5, 1), ("b", 1, 1)]


def test_top_n_and_other_is_whole(spark):
    df = spark.createDataFrame([(f"r{i}", 10 - i) for i in range(10)], "label string, v int")
    got = {r.label: r.v for r in ranking.top_n_and_other(df, "label", "v", 3).collect()}
    assert got == {"r0": 10, "r1": 9, "r2": 8, "Other": sum(range(1, 8))}


def test_latest_known_skips_null(spark):
    rows = [(1, "old", 1), (1, "new", 2), (1, None, 3), (2, None, 1)]
    df = spark.createDataFrame(rows, "k int, name string, at int")
    got = {r.k: r.n for r in df.groupBy("k").agg(ranking.latest_known("name", F.struct("at")).alias("n")).collect()}
    assert got == {1: "new", 2: None}


def test_orphans_and_missing(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "p int")
    assert [r.k for r in lookup.orphans(child, "k", parent, "p").collect()] == [2]
    flags = {r.k: r.f for r in lookup.flag_missing(child, "k", parent, "p", "f").collect()}
    assert flags == {1: False, 2: True, None: True}


@pytest.mark.parametrize("most", [lookup.FEW_MISSING, 1])
def test_few_missing_keys_spare_the_wide_rows(spark, tmp_path, monkeypatch, most):
    child = [(None if i % 50 == 0 else i % 300, f"row {i}") for i in range(3_000)]
    spark.createDataFrame(child, "k int, wide string").write.parquet(str(tmp_path / "child"))
    spark.createDataFrame([(i,) for i in range(290)] * 2 + [(None,)], "p int").write.parquet(str(tmp_path / "parent"))
    child, parent = (spark.read.parquet(str(tmp_path / n)) for n in ("child", "parent"))
    monkeypatch.setattr(lookup, "FEW_MISSING", most)
    before, limit = shuffled_bytes(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = lookup.flag_missing(child.where("k IS NULL OR k <> 7"), "k", parent, "p", "f", child)
        assert most == 1 or ("Exchange hash" not in plan(flagged) and shuffled_bytes(spark) < before + 1_000)
        got = flagged.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert flagged.columns == ["k", "wide", "f"] and len(got) == 2_990
    assert all(r.f == (r.k is None or r.k >= 290) for r in got)


def test_spread_blank_keys_are_distinct(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "id int, k string")
    keys = [r[0] for r in df.select(lookup.spread_blank(F.col("k"), F.col("id"))).collect()]
    assert len(set(keys)) == 3 and "a" in keys


def test_active_on_against_brute_force(spark):
    rng = random.Random(3)
    day0 = datetime.date(2020, 1, 1)

    def day(n):
        return day0 + datetime.timedelta(n)

    members = []
    for i in range(120):
        joined = rng.randrange(0, 300)
        left = None if rng.random() < 0.3 else day(joined + rng.randrange(0, 80))
        members.append((i, "hot" if i % 3 == 0 else rng.choice("ab"), day(joined), left))
    needs = [(g, day(n)) for g in ("hot", "a", "b", "empty") for n in range(0, 400, 7)]
    m = spark.createDataFrame(members, "id int, g string, joined date, left_on date")
    got = {
        (r.g, r.day): (r.active_in_group, r.used_fallback, r.available)
        for r in intervals.active_on(spark.createDataFrame(needs, "g string, day date"), "day", "g", m, "joined", "left_on").collect()
    }
    assert len(got) == len(needs)
    for g, at in needs:
        active = [x[1] for x in members if x[2] <= at and (x[3] is None or x[3] >= at)]
        own = active.count(g)
        assert got[g, at] == (own, own == 0, own or len(active))


def test_same_period_last_year_survives_gaps(spark):
    df = spark.createDataFrame([(2019, 1, 10), (2020, 2, 5), (2020, 1, 20), (2022, 1, 7)], "year int, month int, v int")
    got = {(r.year, r.month): r.past for r in series.same_period_last_year(df, "year", "v", "past", ["month"]).collect()}
    assert got == {(2019, 1): None, (2020, 2): None, (2020, 1): 10, (2022, 1): None}


def test_drill_down_against_brute_force(spark):
    """Null levels, null values, values far apart and below zero; no row is read for more than the finest level."""
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, -5, 7, 10**12, *range(40_000, 40_050)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "x string, y int, who long, n long")
    found = drilldown.drill_down(df, ["x", "y"], {"rows": F.count(F.lit(1)), "total": F.sum("n")}, {"people": "who"})
    got = {(r.level, r.x, r.y): (r.rows, r.total, r.people) for r in found.collect()}
    expected = {}
    for level in range(3):
        for x, y, who, n in rows:
            key = (level, x if level else None, y if level > 1 else None)
            count, total, people = expected.setdefault(key, [0, 0, set()])
            expected[key] = [count + 1, total + n, people | ({who} - {None})]
    assert got == {k: (c, t, len(p)) for k, (c, t, p) in expected.items()}
    assert "Expand" not in plan(found)
    none = drilldown.drill_down(df.limit(0), ["x"], {"rows": F.count(F.lit(1))}, {"people": "who"})
    assert [(r.level, r.people) for r in none.collect()] == [(0, 0)]
