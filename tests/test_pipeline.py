"""The chain from a biased coarse model to published fine fields, and fire products."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zephyrgrid.operators import downscale
from zephyrgrid.operators.regrid import Axis
from zephyrgrid.functions.presets import Bounds
from zephyrgrid.plans import pipeline

ROWS, COLUMNS, FACTOR = 3, 4, 2
FINE = (Axis(-37.5, 15.0, ROWS * FACTOR), Axis(22.5, 45.0, COLUMNS * FACTOR, True))


def cube(spark, rows, columns, first_year, last_year, seed, shift, missing=(), names=("fi", "fj")):
    rng = np.random.RandomState(seed)
    days = np.arange((first_year - 1970) * 365, (last_year + 1 - 1970) * 365)
    parts = []
    for i in range(rows):
        for j in range(columns):
            season = 285 + 8 * np.sin(2 * np.pi * days / 365) - 2 * i
            v = season + rng.normal(0, 1.5, days.size) + shift
            parts.append(pd.DataFrame({names[0]: i, names[1]: j, "ord": days, "tas": v if (i, j) not in missing else np.nan}))
    frame = pd.concat(parts)
    frame["doy"] = frame["ord"] % 365 + 1
    starts = np.cumsum([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30])
    frame["month"] = np.searchsorted(starts, frame["doy"], side="left")
    return spark.createDataFrame(frame).withColumn("tas", F.when(~F.isnan("tas"), F.col("tas")))


@pytest.fixture(scope="module")
def chain(spark):
    ocean = {(0, 0), (0, 1), (1, 0), (1, 1), (4, 5)}
    reference = cube(spark, 6, 8, 1995, 1998, 1, 0.0, ocean)
    hist = cube(spark, 3, 4, 1995, 1998, 2, 2.0, names=("ci", "cj"))
    sim = cube(spark, 3, 4, 1999, 2000, 3, 2.0, names=("ci", "cj"))
    adjusted, spread = pipeline.adjust_and_downscale(
        reference, hist, sim, "tas", "tas", FINE, ROWS, COLUMNS, FACTOR, iterations=4)
    support = reference.groupBy((F.col("fi") * 8 + F.col("fj")).alias("cell")).agg(
        (F.count("tas") == 4 * 365).alias("support"))
    finished, report = pipeline.finish_and_check(spread, adjusted, support, "tas", "tas", FINE, FACTOR, 730)
    return reference, adjusted, finished.persist(), report, ocean


def test_ocean_is_missing_land_is_complete_and_the_bias_is_gone(chain):
    reference, _, finished, report, ocean = chain
    per_cell = finished.groupBy("fi", "fj").agg(F.count("tas").alias("n"), F.avg("tas").alias("m")).collect()
    assert len(per_cell) == 48
    for r in per_cell:
        assert r.n == (0 if (r.fi, r.fj) in ocean else 730)
    means = {(r.fi, r.fj): r.m for r in reference.groupBy("fi", "fj").agg(F.avg("tas").alias("m")).collect()}
    gaps = [abs(r.m - means[r.fi, r.fj]) for r in per_cell if r.n]
    assert max(gaps) < 0.5
    assert report["coverage"]["valid"]


def test_rerun_is_identical(chain, spark):
    reference, adjusted, finished, _, _ = chain
    placed = adjusted.select(F.expr("cell div 4").alias("ci"), F.expr("cell % 4").alias("cj"), "ord", "month", "tas")
    from zephyrgrid.functions.presets import VARIABLES
    again = downscale.downscale(
        reference.repartition(3), placed.repartition(5), "tas", FINE[0], ROWS, COLUMNS, FACTOR,
        VARIABLES["tas"].downscale_bounds, iterations=4)
    left = {(r.fi, r.fj, r.ord): r.tas for r in again.where("fi = 2 AND tas IS NOT NULL").collect()}
    right = {(r.fi, r.fj, r.ord): r.tas for r in finished.where("fi = 2 AND tas IS NOT NULL").collect()}
    assert left == right and left


def test_single_active_cell_copies_the_coarse_series():
    days = np.arange(365)
    month = np.minimum(days // 31 + 1, 12)
    observed = np.full((365, 4), np.nan)
    observed[:, 2] = 280.0
    coarse = 281.0 + np.sin(days)
    out = downscale.downscale_cell(
        observed, month, coarse, np.repeat(coarse[:, None], 4, axis=1), month, np.ones(4), Bounds(), 2, 10, 0, np.nan)
    np.testing.assert_array_equal(out[:, 2], coarse)
    assert np.isnan(out[:, [0, 1, 3]]).all()


def test_inactive_cells_leave_the_others_unchanged():
    rng = np.random.RandomState(4)
    month = np.repeat(np.arange(1, 13), 30)
    observed, guess = rng.gamma(2, 1, (360, 4)), rng.gamma(2, 1, (360, 4))
    coarse = guess.mean(axis=1)
    bounds = Bounds(0.0, 0.1)
    part = downscale.downscale_cell(observed[:, :3], month, coarse, guess[:, :3], month, np.ones(3), bounds, 2, 10, 0, np.nan)
    observed[:, 3] = np.nan
    whole = downscale.downscale_cell(observed, month, coarse, guess, month, np.ones(4), bounds, 2, 10, 0, np.nan)
    np.testing.assert_array_equal(whole[:, :3], part)
    assert np.isnan(whole[:, 3]).all()
    assert ((whole[:, :3] == 0) | (whole[:, :3] >= 0.1)).all()


def test_publication_and_refusal(chain, spark, tmp_path):
    finished = chain[2].where("tas IS NOT NULL")
    report = pipeline.publish(finished, "tas", "tas", str(tmp_path / "tas"))
    assert report["valid_packing"] and report["maximum_error"] <= 0.0025 + 1e-9
    back = spark.read.parquet(str(tmp_path / "tas"))
    assert back.count() == finished.count() and dict(back.dtypes)["code"] == "smallint"
    with pytest.raises(ValueError, match="does not fit"):
        pipeline.publish(finished.withColumn("tas", F.col("tas") + 1000), "tas", "tas", str(tmp_path / "bad"))


def test_preprocessing_contract(spark):
    source = (Axis(-45.0, 90.0, 2), Axis(90.0, 180.0, 2, True))
    rows = [(i, j, 2001, 1 + d // 30, 1 + d % 30, 86.4) for i in range(2) for j in range(2) for d in range(360)]
    raw = spark.createDataFrame(rows, "fi long, fj long, year long, month long, day long, value double")
    out = pipeline.preprocess(raw, "pr", "mm d-1", "360_day", source, (Axis(-67.5, 45.0, 4), Axis(45.0, 90.0, 4, True)))
    report = pipeline.preprocessing_report(out, (Axis(-67.5, 45.0, 4), Axis(45.0, 90.0, 4, True))).first()
    assert report.valid
    totals = [r.s for r in out.groupBy("cell").agg(F.sum("value").alias("s")).collect()]
    np.testing.assert_allclose(totals, 360 * 0.001, rtol=1e-5)


def test_fire_products_warm_up_and_stay_apart(spark):
    days = np.arange(25 * 365, 28 * 365)
    frame = pd.DataFrame({"cell": 3, "ord": days, "lat": 45.0})
    frame["month"] = np.minimum((frame["ord"] % 365) // 31 + 1, 12)
    frame["tas"] = 288.15 + 12 * np.sin(2 * np.pi * (frame["ord"] - 110) / 365)
    frame["hurs"], frame["pr"], frame["wind"] = 40.0, 0.0, 5.0
    support = spark.createDataFrame([(3, True)], "cell long, support boolean")
    daily, annual = pipeline.fire_products(spark.createDataFrame(frame), support, 1997, (1995, 1996))
    assert daily.agg(F.min("ord").alias("a")).first().a == 27 * 365
    cold = pipeline.fire_products(
        spark.createDataFrame(frame[frame["ord"] >= 27 * 365]), support, 1997, (1997, 1997))[0]
    first = lambda df: df.where("dc IS NOT NULL").orderBy("ord").first()
    assert first(daily).dc > first(cold).dc  # the history carries the drought over
    assert annual.where("fwixx IS NULL").count() == 0 and annual.count() == 3


def test_both_first_guesses_agree(spark):
    from zephyrgrid.operators.regrid import bilinear_broadcast

    rng = np.random.RandomState(5)
    field = rng.normal(280, 5, (3, 4))
    field[1, 2] = np.nan
    rows = [(i, j, 1, None if np.isnan(field[i, j]) else float(field[i, j])) for i in range(3) for j in range(4)]
    want = {(r.fi, r.fj): r.v for r in bilinear_broadcast(
        spark.createDataFrame(rows, "ci long, cj long, ord long, v double"), "v", 3, 4, 3).collect()}
    padded = np.full((5, 4), np.nan)
    padded[1:4] = field
    weights = downscale.blend_weights(3, 4, 3)
    for i in range(3):
        for j in range(4):
            near = np.array([[padded[i + a, (j + b - 1) % 4] for a in range(3) for b in range(3)]])
            for k, v in enumerate(downscale.first_guess(near, weights)[0]):
                other = want[i * 3 + k // 3, j * 3 + k % 3]
                assert (np.isnan(v) and other is None) or v == pytest.approx(other)
