"""Raw files in their true order."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import dedupe, ranking
from starmart.plans.cleaning import ORDINAL
from starmart.registry import cleansing, messy
from starmart.sources import files, tpch


def test_lines_of_several_files_keep_their_order(spark, tmp_path):
    """The second file is the largest and is split; Spark reads it first, and packs the small ones together."""
    folder = tmp_path / "regions_raw.csv"
    folder.mkdir()
    ids = iter(range(1_000_000))
    lines = []
    for name, count in (("a.csv", 3), ("b.csv", 60_000), ("c.csv", 500), ("d.csv", 4_000)):
        own = [f"{next(ids) % 7_000},{name} {k}" for k in range(count)]
        lines += own
        (folder / name).write_text("\n".join(["region_id,region_name_raw", *own]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        raw = files.read_raw(spark, str(tmp_path), "regions")
        assert raw.rdd.getNumPartitions() > 4 and raw.select(f"{ORDINAL}.split").distinct().count() > 4
        numbered = ranking.numbered(raw, "line", [F.col(ORDINAL)]).orderBy("line").collect()
        assert [f"{r.region_id},{r.region_name_raw}" for r in numbered] == lines
        assert [r.line for r in numbered] == list(range(1, len(lines) + 1))
        first = dedupe.keep_first(raw, ["region_id"], ORDINAL).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {}
    for line in lines:
        expected.setdefault(int(line.split(",")[0]), line.split(",")[1])
    assert {r.region_id: r.region_name_raw for r in first} == expected
    assert sum(r[dedupe.COPIES] for r in first) == len(lines)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Line items with ties, repeated rows and nulls, and the tables that they are looked up in."""
    rng = random.Random(9)
    day = lambda: rng.choice([None, datetime.datetime(2020, 1, rng.randrange(1, 29))])
    lines = [(rng.randrange(60), rng.choice([None, 1, 2]), rng.randrange(4), rng.randrange(3), float(rng.randrange(50)), 10.5, 0.05, 0.04, "A", "O", day()) for _ in range(700)]
    nothing = {"nation": [(0, "N", 0), (24, "A", 1)], "region": [(0, "ASIA"), (1, "EUROPE")], "supplier": [(0, "s", 0, 1.0), (1, "s", 24, -1.0)]}
    nothing |= {"customer": [(i, f"C{i}", i % 2, i - 2.5, "AUTO") for i in range(6)]}
    root = tmp_path_factory.mktemp("tables")
    for name, rows in {"lineitem": lines + lines[:90], **nothing}.items():
        spark.createDataFrame(rows, tpch.SCHEMAS[name]).coalesce(1).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


@pytest.mark.parametrize("name", ["bookings", "weather", "guides"])
def test_raw_files_are_compressed_and_in_order(spark, folder, monkeypatch, name):
    monkeypatch.setattr(messy, "ROWS_A_FILE", 1 if name == "guides" else 100)
    path = cleansing.raw_files(spark, folder, [name])
    stored = [n for n in os.listdir(f"{path.removeprefix('file:')}/{name}_raw.csv") if n.startswith("part-")]
    assert stored and all(n.endswith(".csv.gz") for n in stored) and (name == "guides" or len(stored) > 4)
    raw = files.read_raw(spark, path, name)
    found = [tuple(r)[:-2] for r in ranking.numbered(raw, "line", [F.col(ORDINAL)]).orderBy("line").collect()]
    whole = cleansing.RAW_TABLES[name](spark, folder).orderBy(ORDINAL).drop(ORDINAL).collect()
    blank = lambda rows: [tuple(v.strip() or None if isinstance(v, str) else v for v in r) for r in rows]
    found, whole = blank(found), blank(whole)
    assert sorted(map(str, found)) == sorted(map(str, whole))
    # Rows that tie may change places.
    keyed = cleansing.RAW_TABLES[name](spark, folder).groupBy(ORDINAL).count().where("count = 1").count()
    assert sum(a == b for a, b in zip(found, whole, strict=True)) >= keyed // 2


def test_a_table_goes_once_its_entries_are_stored(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    log = cleansing.full_log(spark, folder, ("Region", "Marketing"), datetime.datetime(2024, 1, 1))
    assert not [n for n in set(os.listdir(shared)) - before if n.startswith(("Region-", "Marketing-"))]
    got = {(r.table, r.metric, r.stage): r.value for r in log.collect()}
    assert got["Region", "row_count", "raw"] == 2 and got["Marketing", "row_count", "cleaned"] == 6
    assert got["Marketing", "negative_spend_rows", "cleaning"] == 3 and got["Region", "validation_failures", "cleaning"] == 0
