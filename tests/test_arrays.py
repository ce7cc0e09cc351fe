"""Array stores: round trips, pruning, foreign layouts, failures."""

import gzip
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from zephyrgrid.operators.packing import specification
from zephyrgrid.operators.regrid import Axis
from zephyrgrid.sources import arrays, stores

LAT, LON = Axis(-45.0, 30.0, 4), Axis(30.0, 60.0, 6)
DAYS = (365 * 31, 365 * 31 + 90)


def _rows(spark):
    cube = spark.range(DAYS[0], DAYS[1]).select(F.col("id").alias("ord")).crossJoin(spark.range(4).select(F.col("id").alias("fi"))).crossJoin(
        spark.range(6).select(F.col("id").alias("fj")))
    value = F.when(F.expr("(ord + fi) % 7 <> 0"), 250.0 + F.col("fi") + F.col("fj") / 8 + (F.col("ord") - DAYS[0]) / 64)
    return cube.select("ord", "fi", "fj", value.alias("tas"))


def _values(df):
    return {(r["ord"], r["fi"], r["fj"]): r["tas"] for r in df.where("tas IS NOT NULL").select("ord", "fi", "fj", "tas").collect()}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("arrays") / "tas.zarr")
    arrays.write_array(_rows(spark), path, "tas", DAYS, LAT, LON, "time=20,lat=3,lon=-1", specification("tas"), "K")
    return path


def test_round_trip_keeps_packed_values_and_axes(spark, store):
    back = stores.open_cube(spark, store, "tas")
    want, found = _values(_rows(spark)), _values(back)
    assert want.keys() == found.keys() and back.count() == 90 * 24
    assert max(abs(found[k] - v) for k, v in want.items()) <= specification("tas")[0] / 2 + 1e-9
    first = back.orderBy("ord", "fi", "fj").first()
    assert (first["year"], first["month"], first["day"], first["lat"], first["lon"]) == (2001, 1, 1, -45.0, 30.0)
    assert not [n for n in os.listdir(os.path.dirname(store)) if "staging" in n]


def test_filters_reduce_the_tasks(spark, store):
    back = arrays.open_array(spark, store, "tas")
    assert back.rdd.getNumPartitions() == 5 * 2
    assert back.where(F.col("ord") < DAYS[0] + 20).rdd.getNumPartitions() == 2
    narrow = back.where((F.col("lat") > 40) & (F.col("ord") >= DAYS[0] + 30) & (F.col("ord") <= DAYS[0] + 45) & (F.col("fj") == 2))
    assert narrow.rdd.getNumPartitions() == 2
    assert narrow.count() == 16 and {r["fi"] for r in narrow.select("fi").collect()} == {3}
    nothing = back.where("month = 3 AND lon > 1000")
    assert nothing.rdd.getNumPartitions() == 1 and nothing.count() == 0


def test_foreign_layout_is_read(spark, tmp_path):
    """Big-endian, column order, gzip, slash-separated chunks, a calendar with leap days, a missing chunk."""
    root = tmp_path / "x.zarr"
    data = np.arange(5 * 2 * 3, dtype=">f4").reshape(5, 2, 3)
    lines = {"time": (np.arange(5.0), {"units": "days since 2000-02-27", "calendar": "standard"}), "lat": (np.array([1.0, 2.0]), {}), "lon": (np.array([3.0, 4.0, 5.0]), {})}
    for name, (line, attributes) in lines.items():
        (root / name).mkdir(parents=True)
        (root / name / ".zarray").write_text(json.dumps({"shape": [len(line)], "chunks": [len(line)], "dtype": "<f8", "compressor": None, "filters": None, "fill_value": 0, "order": "C", "zarr_format": 2}))
        (root / name / ".zattrs").write_text(json.dumps({"_ARRAY_DIMENSIONS": [name], **attributes}))
        (root / name / "0").write_bytes(line.tobytes())
    (root / "v" / "0" / "0").mkdir(parents=True)
    meta = {"shape": [5, 2, 3], "chunks": [4, 2, 3], "dtype": ">f4", "compressor": {"id": "gzip", "level": 1}, "filters": None, "fill_value": None, "order": "F", "zarr_format": 2, "dimension_separator": "/"}
    (root / "v" / ".zarray").write_text(json.dumps(meta))
    (root / "v" / ".zattrs").write_text(json.dumps({"_ARRAY_DIMENSIONS": ["time", "lat", "lon"], "missing_value": 7.0}))
    (root / "v" / "0" / "0" / "0").write_bytes(gzip.compress(data[:4].tobytes(order="F")))
    rows = {(r["month"], r["day"], r["fi"], r["fj"]): (r["v"], r["ord"]) for r in stores.open_cube(spark, str(root), "v").collect()}
    assert len(rows) == 30 and rows[2, 28, 0, 0][0] == 6.0 and rows[2, 28, 0, 1][0] is None and rows[3, 1, 1, 2] == (23.0, 30 * 365 + 59)
    assert rows[2, 29, 1, 0] == (15.0, None) and all(v[0] is None for k, v in rows.items() if k[:2] == (3, 2))
    meta["compressor"] = {"id": "blosc"}
    (root / "v" / ".zarray").write_text(json.dumps(meta))
    with pytest.raises(Exception, match="raw, zlib and gzip"):
        stores.open_cube(spark, str(root), "v").count()


@pytest.mark.parametrize("bad, message", [("tas * 1000", "packing range"), ("NULL", "twice"), ("outside", "outside the axes")])
def test_a_failed_write_leaves_nothing(spark, tmp_path, bad, message):
    path = str(tmp_path / "bad.zarr")
    rows = _rows(spark)
    if bad == "NULL":
        rows = rows.unionByName(rows.where("ord % 40 = 0"))
    elif bad == "outside":
        rows = rows.withColumn("fi", F.col("fi") + F.when(F.col("ord") == DAYS[0] + 50, 9).otherwise(0))
    else:
        rows = rows.withColumn("tas", F.expr(f"CASE WHEN ord = {DAYS[0] + 50} THEN {bad} ELSE tas END"))
    with pytest.raises(Exception, match=message):
        arrays.write_array(rows, path, "tas", DAYS, LAT, LON, "time=20,lat=2,lon=2", specification("tas"))
    assert os.listdir(tmp_path) == []
    with pytest.raises(Exception, match="no array"):
        stores.open_cube(spark, path, "tas").count()


def test_existing_stores_are_replaced_only_when_asked(spark, tmp_path):
    path = str(tmp_path / "one.zarr")
    few = _rows(spark).where(F.col("ord") < DAYS[0] + 3)
    arrays.write_array(few, path, "tas", (DAYS[0], DAYS[0] + 3), LAT, LON)
    with pytest.raises(Exception, match="FileExists"):
        arrays.write_array(few, path, "tas", (DAYS[0], DAYS[0] + 3), LAT, LON)
    arrays.write_array(few.where("fi = 1"), path, "tas", (DAYS[0], DAYS[0] + 3), LAT, LON, overwrite=True)
    found = arrays.open_array(spark, path, "tas")
    assert {r["fi"] for r in found.where("tas IS NOT NULL").collect()} == {1} and os.listdir(tmp_path) == ["one.zarr"]
    with pytest.raises(ValueError, match="chunk names"):
        arrays.write_array(few, path + "2", "tas", DAYS, LAT, LON, "depth=3")
    with pytest.raises(ValueError, match="NetCDF"):
        stores.open_cube(spark, "x.nc", "tas")
