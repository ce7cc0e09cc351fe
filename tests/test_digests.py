"""Digests by content, refusal of stale presets, discovery of the history."""

import pytest
from pyspark.sql import functions as F

from zephyrgrid.operators import adjustment as adj
from zephyrgrid.sources import digests, stores


def _rows(spark, shift=0.0, count=4000):
    return spark.range(count).select((F.col("id") % 4).alias("cell"), F.col("id").alias("ord"), (F.col("id") % 17 + shift).alias("v"))


def test_only_changed_files_are_read_and_rewritten_data_counts(spark, tmp_path):
    path, cache = str(tmp_path / "data"), str(tmp_path / "cache")
    _rows(spark).repartition(4).write.partitionBy("cell").parquet(path)
    first, read = digests.table_digest(spark, path, cache)
    assert read == 16 and digests.table_digest(spark, path, cache) == (first, 0)
    # One partition rewritten with other values at the same path.
    stores.write_region(_rows(spark, 0.5).where("cell = 2").coalesce(1), path, ["cell"])
    second, read = digests.table_digest(spark, path, cache)
    assert read == 1 and second != first
    # The old values again, in other files and another order: the first digest is back.
    stores.write_region(_rows(spark).where("cell = 2").orderBy(F.desc("ord")), path, ["cell"])
    third, read = digests.table_digest(spark, path, cache)
    assert third == first and read >= 1 and digests.table_digest(spark, path, cache) == (first, 0)


def test_a_fit_is_trained_again_when_its_data_changes(spark, tmp_path):
    path, cache = str(tmp_path / "data"), str(tmp_path / "cache")
    calls = []

    def fitted():
        key = adj.fit_key({"method": "scaling", "data": digests.table_digest(spark, path, cache)[0]})

        def build():
            calls.append(1)
            return spark.read.parquet(path).groupBy("cell").agg(F.avg("v").alias("m"))

        return adj.cached_fit(spark, f"{cache}/fit", key, build)

    _rows(spark).write.parquet(path)
    assert [fitted()[1], fitted()[1]] == [False, True] and len(calls) == 1
    _rows(spark, 1.0).write.mode("overwrite").parquet(path)
    frame, hit = fitted()
    assert not hit and len(calls) == 2 and frame.agg(F.min("m")).first()[0] > 8


def test_stale_presets_are_refused(spark, tmp_path):
    path = str(tmp_path / "hurs")
    with pytest.raises(ValueError, match="stale hurs"):
        digests.require_current(spark, path, "hurs")
    stores.prepare_store(spark, path, {"grid": 1, "revision": 3}, "v double")
    with pytest.raises(ValueError, match="revision 3, expected 4"):
        digests.require_current(spark, path, "hurs")
    stores.prepare_store(spark, path, {"grid": 1, "revision": 4}, "v double")
    assert digests.require_current(spark, path, "hurs") == 4 and digests.require_current(spark, str(tmp_path / "tas"), "tas") == 1


def test_history_is_found_beside_a_projection(spark, tmp_path):
    root = tmp_path / "MODEL"
    (root / "ssp585" / "projection").mkdir(parents=True)
    assert digests.history_root(spark, str(root / "ssp585" / "projection")) is None
    (root / "historical" / "hist").mkdir(parents=True)
    assert digests.history_root(spark, str(root / "ssp585" / "projection")) == str(root / "historical" / "hist")
    assert digests.history_root(spark, str(root / "historical" / "hist")) is None
