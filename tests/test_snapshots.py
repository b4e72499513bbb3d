"""Versioned snapshots, and views registered by dependency."""

import pytest
from pyspark.sql import functions as F

from starmart.plans import reports, snapshots


def test_a_refresh_that_dies_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "ltv")
    with pytest.raises(FileNotFoundError):
        snapshots.current(spark, path)
    first = spark.range(100).withColumn("v", F.lit("first"))
    snapshots.publish(first, path)
    held = snapshots.current(spark, path)
    # Some tasks have written their files when another fails.
    broken = spark.range(0, 1000, 1, 4).withColumn("v", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise("second"))
    with pytest.raises(Exception, match="lost"):
        snapshots.publish(broken, path)
    assert {r.v for r in snapshots.current(spark, path).collect()} == {"first"} and snapshots.versions(spark, path).count() == 1
    snapshots.publish(spark.range(5).withColumn("v", F.lit("third")), path)
    assert [tuple(r) for r in snapshots.current(spark, path).groupBy("v").count().collect()] == [("third", 5)]
    assert [(r.number, r.rows) for r in snapshots.versions(spark, path).orderBy("number").collect()] == [(1, 100), (2, 5)]
    assert held.count() == 100  # a reader that began before goes on with its version


def test_an_empty_snapshot_is_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "empty")
    snapshots.publish(spark.range(0), path)
    assert snapshots.current(spark, path).collect() == []


def test_views_are_built_after_those_they_read(spark):
    built = []

    def view(name, *reads):
        def build(star):
            built.append(name)
            return star[reads[0]].withColumn(name, F.lit(name))

        return reports.View(build, reads)

    registry = {"v_top": view("v_top", "v_mid"), "v_mid": view("v_mid", "v_low"), "v_low": view("v_low", "base")}
    for _ in range(2):
        assert reports.register_views({"base": spark.range(3)}, registry) == ["v_low", "v_mid", "v_top"]
    assert built[:3] == ["v_low", "v_mid", "v_top"]
    assert spark.sql("SELECT * FROM v_top").columns == ["id", "v_low", "v_mid", "v_top"]
    with pytest.raises(KeyError, match="nowhere"):
        reports.register_views({"base": spark.range(9)}, registry | {"v_bad": view("v_bad", "nowhere")})
    assert spark.sql("SELECT count(*) FROM base").first()[0] == 3  # nothing was replaced
