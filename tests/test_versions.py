"""Stores with versions: zones, appends, conflicts, clones and regions."""

import pytest
from pyspark.sql import functions as F

from zephyrgrid.operators import qc
from zephyrgrid.session import place_by
from zephyrgrid.sources import versions


def _rows(spark, first, end, cells=256, shift=0.0):
    days = spark.range(first, end).select(F.col("id").alias("ord"))
    return spark.range(cells).select(F.col("id").alias("cell")).crossJoin(days).withColumn("tas", 280.0 + F.col("cell") % 10 + F.col("ord") % 5 + shift)


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "store")
    assert versions.create(_rows(spark, 0, 730), path) == 1
    return path


def test_an_append_opens_only_files_it_may_overlap(spark, store):
    assert versions.entries(spark, store).count() == 2 * 4
    batch = _rows(spark, 700, 760, cells=70)  # two of four tiles; the second year and a new one
    zone = versions.touched(spark, store, batch)
    assert {(r["year"], r["tile"]) for r in zone.collect()} == {(1971, 0), (1971, 1)}
    assert versions.append(batch, store) == 2
    found = versions.entries(spark, store)
    assert {(r["year"], r["tile"], r["first"], r["last"]) for r in found.where("year = 1972").collect()} == {(1972, 0, 730, 759), (1972, 1, 730, 759)}
    assert versions.read(spark, store).count() == 730 * 256 + 30 * 70
    assert versions.read(spark, store, version=1).count() == 730 * 256
    # Days of the new year lie in two files; nothing else is opened.
    few = versions.read(spark, store, days=(740, 745))
    assert few.count() == 5 * 70 and len(few.inputFiles()) == 2


def test_the_same_batch_twice_changes_nothing(spark, store):
    batch = _rows(spark, 725, 735)
    assert versions.append(batch, store) == 2
    assert versions.append(batch, store) == 2 and versions.versions(spark, store) == [1, 2]
    assert versions.append(batch.where("false"), store) == 2


def test_of_two_writers_one_fails_and_nothing_is_lost(spark, store):
    assert versions.append(_rows(spark, 730, 731), store, base=1) == 2
    with pytest.raises(versions.Conflict):
        versions.append(_rows(spark, 731, 732), store, base=1)
    assert versions.versions(spark, store) == [1, 2] and versions.read(spark, store).agg(F.max("ord")).first()[0] == 730
    assert versions.append(_rows(spark, 731, 732), store) == 3
    with pytest.raises(FileExistsError):
        versions.create(_rows(spark, 0, 1), store)


def test_a_clone_shares_files_until_a_region_changes(spark, store, tmp_path):
    other = str(tmp_path / "clone")
    versions.clone(spark, store, other)
    files = {r["file"] for r in versions.entries(spark, store).collect()}
    assert {r["file"] for r in versions.entries(spark, other).collect()} == files
    region = versions.read(spark, other, days=(365, 730), tiles=[2]).withColumn("tas", F.col("tas") + 200)
    assert versions.replace_region(region, other) == 2
    assert len(files & {r["file"] for r in versions.entries(spark, other).collect()}) == len(files) - 1
    changed = versions.changed_partitions(versions.entries(spark, store), versions.entries(spark, other)).collect()
    assert [tuple(r) for r in changed] == [(1971, 2, 365 * 64, 365 * 64)]
    # Quality control of both versions: only the clone leaves the bounds.
    for path, bad in ((store, False), (other, True)):
        report = qc.variable_report(versions.read(spark, path), ["tas"], 730, 0.75).first()
        assert report["bounds_ok"] is (not bad)
    assert versions.changed_partitions(versions.entries(spark, other, 1), versions.entries(spark, store)).count() == 0


def test_digests_do_not_depend_on_order_or_files(spark, store, tmp_path):
    again = str(tmp_path / "again")
    versions.create(_rows(spark, 0, 400).orderBy(F.rand(3)), again)
    versions.append(_rows(spark, 390, 730), again)
    assert versions.entries(spark, again).count() > versions.entries(spark, store).count()
    assert versions.changed_partitions(versions.entries(spark, store), versions.entries(spark, again)).count() == 0


def test_missing_versions_are_refused(spark, store, tmp_path):
    with pytest.raises(FileNotFoundError):
        versions.entries(spark, store, 7)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "nowhere"))
    assert versions.read(spark, store, days=(9000, 9001)).count() == 0


def test_listing_many_files_takes_a_few_tasks(spark, tmp_path):
    path = str(tmp_path / "many")
    versions.create(_rows(spark, 0, 3, cells=120), path, 1)
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.sparkContext.setJobGroup("many-files", "reading 120 files")
    assert versions.read(spark, path).count() == 360
    spark.sparkContext.setJobGroup("other", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("many-files") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before


def test_writing_small_partitions_is_spread_over_tasks(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(versions, "place_by", lambda df, *keys: seen.append(keys) or place_by(df, *keys))
    versions.create(_rows(spark, 0, 3, cells=4), str(tmp_path / "few"), 1)
    assert seen == [("year", "tile")]
