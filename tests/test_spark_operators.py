"""Operators on small fixtures, checked against brute force or hand-made values."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zephyrgrid.functions import calendar as cal
from zephyrgrid.functions import physics as ph
from zephyrgrid.functions import units
from zephyrgrid.functions.presets import VARIABLES, Bounds
from zephyrgrid.operators import adjustment as adj
from zephyrgrid.operators import aggregate, align, components, indicators, masks, packing, qc, quantiles, regrid, windows
from zephyrgrid.sources import stores
from zephyrgrid.streaming.ingest import append_increments


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_units_and_bounds(spark):
    assert units.quantity("0.1 mm d-1", "kg m-2 s-1") == pytest.approx(0.1 / 86400)
    with pytest.raises(ValueError):
        units.conversion("K", "Pa")
    df = frame(spark, [(0.05,), (None,), (0.2,)], "v double")
    got = [r.x for r in df.select(ph.threshold_to_bound(F.col("v"), Bounds(0.0, 0.1)).alias("x")).collect()]
    assert got == [0.0, 0.0, 0.2]


def test_derived_variables(spark):
    df = frame(spark, [(280.0, 10.0, 0.25, 4.0, 0.5)], "tas double, tasrange double, tasskew double, pr double, prsnratio double")
    row = ph.derive_components(df).first()
    assert (row.tasmin, row.tasmax, row.prsn) == (277.5, 287.5, 2.0)


def test_leap_day_precipitation_moves_back(spark):
    df = frame(spark, [(1, 2000, 2, 27, 1.0), (1, 2000, 2, 28, 1.0), (1, 2000, 2, 29, 2.0), (1, 2000, 3, 1, 3.0)],
               "cell int, year int, month int, day int, pr double")
    moved = cal.move_leap_accumulation(df, "pr").orderBy("month", "day").collect()
    assert [r.pr for r in moved] == [1.0, 3.0, 3.0]


def test_360_day_insertions_and_total(spark):
    rows = [(1, 2001, d, None if d == 21 else float(d - 1)) for d in range(1, 361)]
    out = cal.expand_360_day(frame(spark, rows, "cell int, year int, doy360 int, v double"), "v").toPandas()
    assert len(out) == 365 and out["v"].isna().sum() == 1
    missing_source = out[~out["doy"].isin(np.rint(365 * np.arange(1, 361) / 360).astype(int))]
    assert sorted(missing_source["doy"]) == [37, 109, 183, 255, 329] and missing_source["v"].notna().all()
    ones = frame(spark, [(1, 2001, d, 1.0) for d in range(1, 361)], "cell int, year int, doy360 int, v double")
    total = cal.expand_360_day(ones, "v", preserve_total=True).agg(F.sum("v").alias("s")).first().s
    assert total == pytest.approx(360.0)


def test_annual_season_indicators(spark):
    rows = [(1, 2001 + t // 365, t, float(t % 100)) for t in range(730)]
    df = frame(spark, rows, "cell int, year int, ord int, fwi double")
    limits = frame(spark, [(1, 94.0, 49.5)], "cell int, q95 double, midrange double")
    first = indicators.annual_season_indicators(df, "fwi", limits).orderBy("year").first()
    assert (first.fwixx, first.fwixd, first.fwils) == (99.0, 15, 165) and first.fwisa > 50


def test_thresholds_skip_inactive_days(spark):
    rows = [(1, d, float(d) if 10 <= d < 20 else None) for d in range(365)]
    df = frame(spark, rows, "cell int, ord int, fwi double")
    mask = frame(spark, [(1, True), (2, True), (3, False)], "cell int, support boolean")
    got = {r.cell: (r.q95, r.midrange) for r in indicators.season_thresholds(df, "fwi", mask).collect()}
    assert got[1] == (pytest.approx(18.55), 14.5) and got[2] == (0.0, 0.0) and got[3] == (None, None)


@pytest.mark.parametrize("skewed", [False, True])
def test_exact_quantiles_match_numpy(spark, skewed):
    rng = np.random.default_rng(0)
    values = rng.lognormal(0, 3, 5000)
    if skewed:
        values[:2000] = 1.5
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.95, 0.999, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"v": values, "k": np.where(np.arange(5000) % 3 == 0, "a", "b")}))
    got = {r.p: r.quantile for r in quantiles.exact_quantiles(df, "v", probabilities).collect()}
    np.testing.assert_allclose([got[p] for p in probabilities], np.quantile(values, probabilities), rtol=1e-12)
    by = quantiles.exact_quantiles(df, "v", [0.5], by="k").toPandas().set_index("k")["quantile"]
    assert by["a"] == pytest.approx(np.median(values[::3]))


def test_components_wrap_and_match_brute_force(spark):
    rng = np.random.default_rng(1)
    side = 12
    mask = rng.random((side, side)) < 0.35
    cells = [(int(i * side + j), int(i), int(j)) for i, j in zip(*np.nonzero(mask))]
    parent = {c: c for c, _, _ in cells}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = {(i, j): c for c, i, j in cells}
    for c, i, j in cells:
        for a in (-1, 0, 1):
            for b in (-1, 0, 1):
                other = where.get((i + a, (j + b) % side))
                if other is not None:
                    low, high = sorted((find(c), find(other)))
                    parent[high] = low
    got = components.periodic_components(frame(spark, cells, "cell long, fi long, fj long"), side)
    assert {r.cell: r.label for r in got.collect()} == {c: find(c) for c in parent}


def test_long_snake_is_one_component(spark):
    side = 16
    cells = [(i * side + j, i, j) for i in range(side) for j in range(1, side - 1)
             if i % 2 == 0 or j == (1 if i % 4 == 1 else side - 2)]
    got = components.periodic_components(frame(spark, cells, "cell long, fi long, fj long"), side)
    assert got.select("label").distinct().count() == 1


def test_packing_round_trip_and_refusals(spark):
    scale, offset = packing.specification("tas")
    df = frame(spark, [(260.0,), (320.123,), (None,)], "v double")
    codes = df.withColumn("c", packing.pack(F.col("v"), scale, offset))
    rows = codes.withColumn("b", packing.unpack(F.col("c"), scale, offset)).collect()
    assert rows[2].c == packing.FILL and rows[2].b is None
    assert all(abs(r.b - r.v) <= scale / 2 + 1e-9 for r in rows[:2])
    for bad in (1e6, float("inf")):
        with pytest.raises(Exception, match="infinite|packing range"):
            frame(spark, [(bad,)], "v double").select(packing.pack(F.col("v"), scale, offset)).collect()
    row = packing.packing_report(df, "v", scale, offset).first()
    assert row.valid_packing and row.maximum_error <= scale / 2 + 1e-9


def test_segments_must_join_daily(spark):
    def part(a, b):
        return frame(spark, [(1, o, 5) for o in range(a, b)], "cell int, ord int, code int")
    spec = (0.005, 253.5)
    assert packing.merge_segments([part(0, 5), part(5, 9)], [spec, spec], ["cell"]).count() == 9
    with pytest.raises(ValueError, match="one day apart"):
        packing.merge_segments([part(0, 5), part(6, 9)], [spec, spec], ["cell"])
    with pytest.raises(ValueError, match="packing"):
        packing.merge_segments([part(0, 5), part(5, 9)], [spec, (0.01, 0.0)], ["cell"])


def test_strict_alignment_and_history(spark):
    a = frame(spark, [(1, 1, 0.0), (1, 2, 0.0)], "cell int, ord int, v double")
    with pytest.raises(ValueError, match="coordinates differ"):
        align.align(a, a.where("ord = 1").withColumnRenamed("v", "w"), ["cell", "ord"])
    later = frame(spark, [(1, 3, 0.0)], "cell int, ord int, v double")
    assert align.concatenate_history(a, later, ["cell"]).count() == 3
    with pytest.raises(ValueError, match="adjacent"):
        align.concatenate_history(a, frame(spark, [(1, 4, 0.0)], "cell int, ord int, v double"), ["cell"])


def test_coastal_plan_wraps_and_prefers_cardinal_donors(spark):
    cells = [(i * 4 + j, i, j, (i, j) in ((1, 3), (0, 1)), True) for i in range(3) for j in range(4)]
    df = frame(spark, cells, "cell long, fi long, fj long, valid boolean, land boolean")
    plan = {r.cell: r.donor for r in masks.coastal_plan(df, 4).collect()}
    assert plan[4] == 7 and plan[0] == 1 and plan[5] == 1


def test_bilinear_wraps_and_falls_back_to_the_centre(spark):
    df = frame(spark, [(0, j, 1, float(j)) for j in range(4)], "ci long, cj long, ord long, v double")
    got = {(r.fi, r.fj): r.v for r in regrid.bilinear_broadcast(df, "v", 1, 4, 2).collect()}
    assert got[0, 0] == pytest.approx(0.75) and got[1, 1] == pytest.approx(0.25) and got[0, 7] == pytest.approx(2.25)
    edge = {(r.fi, r.fj): r.v for r in regrid.bilinear_broadcast(df, "v", 1, 4, 2, circular=False).collect()}
    assert edge[0, 0] == 0.0 and edge[0, 7] == 3.0


def test_regridding_conserves_and_propagates_gaps(spark):
    source, target = regrid.canonical_axes(6, 12), regrid.canonical_axes(4, 8)
    rows = [(i, j, 1, float(i * 12 + j)) for i in range(6) for j in range(12)]
    df = frame(spark, rows, "fi long, fj long, ord long, v double")
    out = regrid.conservative_regrid(df, source, target, "v").toPandas()
    def area(axis, index):
        low = np.radians(axis.low + index * axis.step)
        return np.sin(low + np.radians(axis.step)) - np.sin(low)
    got = (out["v"] * area(target[0], out["ti"])).sum() / 8
    want = sum(v * area(source[0], i) for i, j, _, v in rows) / 12
    assert got == pytest.approx(want)
    holes = df.withColumn("v", F.when((F.col("fi") != 0) | (F.col("fj") != 0), F.col("v")))
    assert regrid.conservative_regrid(holes, source, target, "v").where("v IS NULL").count() == 1


def test_gap_aware_mean_and_runs(spark):
    df = frame(spark, [(1, y, float(y)) for y in (2000, 2001, 2002, 2005, 2006)], "cell int, year int, v double")
    got = [r.smooth for r in windows.gap_aware_mean(df, ["cell"], "year", "v").orderBy("year").collect()]
    assert got == [2001.0, 2001.0, 2001.0, None, None]
    days = frame(spark, [(1, o, p) for o, p in ((1, 0.0), (2, 0.0), (4, 0.0), (5, 0.5), (6, 0.0), (7, 3.0))], "cell int, ord int, pr double")
    assert windows.longest_run(days, ["cell"], F.col("pr") < 1).first().longest == 3
    wet = frame(spark, [(1, 1, 5.0)], "cell int, ord int, pr double")
    assert windows.longest_run(wet, ["cell"], F.col("pr") < 1).first().longest == 0


def _series(spark, offset, years, start=0):
    rows = [(1, o, o % 365 + 1, 1, float(np.sin(o / 30.0) + 273.15 + offset)) for o in range(start, start + years * 365)]
    return frame(spark, rows, "cell long, ord long, doy long, month long, v double")


def test_scaling_removes_an_additive_bias(spark):
    r, h, s = _series(spark, 0, 2), _series(spark, 2, 2), _series(spark, 2, 2)
    out = adj.adjust(r, h, s, "v", "scaling", "additive", "dayofyear", 31)
    assert out.where("abs(adjusted - (v - 2)) > 1e-9").count() == 0


@pytest.mark.parametrize("method", ["qdm", "dqm"])
def test_quantile_methods_remove_an_additive_bias(spark, method):
    r, h, s = _series(spark, 0, 3), _series(spark, 2, 3), _series(spark, 3, 3, 1095)
    out = adj.adjust(r, h, s, "v", method, "additive", "dayofyear", 31)
    assert out.where("adjusted IS NULL").count() == 0
    assert abs(out.agg(F.avg(F.col("adjusted") - F.col("v")).alias("m")).first().m + 2) < 0.05


def test_fit_cache_is_reused_and_retrained(spark, tmp_path):
    r, h = _series(spark, 0, 2), _series(spark, 2, 2)
    calls = []
    def build():
        calls.append(1)
        return adj.train(r, h, "v", "qdm", "additive")
    a, hit_a = adj.cached_fit(spark, str(tmp_path / "fit"), "k1", build)
    b, hit_b = adj.cached_fit(spark, str(tmp_path / "fit"), "k1", build)
    assert (hit_a, hit_b, len(calls)) == (False, True, 1) and a.exceptAll(b).count() == 0
    assert adj.cached_fit(spark, str(tmp_path / "fit"), "k2", build)[1] is False and len(calls) == 2


def test_dry_day_adaptation_matches_the_reference_share():
    rng = np.random.default_rng(2)
    ref = np.sort(np.where(rng.random(400) < 0.3, 0.0, rng.gamma(2, 2, 400) + 0.1))
    hist = np.sort(np.where(rng.random(400) < 0.6, 0.0, rng.gamma(2, 2, 400) + 0.1))
    a, b = adj.adapt_dry_days(ref, hist, 0.1)
    assert abs((a <= 0.1).mean() - (b <= 0.1).mean()) < 0.01 and (np.diff(b) >= 0).all()


def test_sliding_windows_match_brute_force(spark):
    rng = np.random.default_rng(3)
    order = np.arange(800)
    value = rng.normal(size=800)
    day = order % 365 + 1
    got = dict(adj.group_samples(day, day, order, value, "dayofyear", 15))
    df = spark.createDataFrame(pd.DataFrame({"cell": 1, "ord": order, "doy": day, "v": value}))
    arrays = {r.doy: r["values"] for r in quantiles.circular_day_windows(df, ["cell"], "v", 15).collect()}
    for centre in (1, 10, 183, 200, 360, 365):
        want = sorted(v for o, v in zip(order, value) for k in range(-15, 16) if 0 <= o + k < 800 and (o + k) % 365 + 1 == centre)
        np.testing.assert_allclose(got[centre], want)
        np.testing.assert_allclose(arrays[centre], want)


def test_linked_checks_find_an_inconsistent_component(spark):
    df = frame(spark, [(280.0, 10.0, 0.25)], "tas double, tasrange double, tasskew double")
    good = ph.derive_components(df)
    assert qc.linked_consistency(good).first().valid
    assert not qc.linked_consistency(good.withColumn("tasmax", F.col("tasmax") + 1)).first().valid


def test_time_checks(spark):
    df = frame(spark, [(1, o) for o in range(365)] + [(2, o) for o in range(364) if o != 5], "cell int, ord int")
    got = {r.cell: r for r in qc.time_checks(df, ["cell"], 1).collect()}
    assert got[1].daily_without_gaps and got[1].training_period_sufficient
    assert not got[2].daily_without_gaps and not got[2].training_period_sufficient


def test_support_masking_refuses_infinity(spark):
    mask = frame(spark, [(1, True)], "cell int, support boolean")
    df = frame(spark, [(1, float("inf"))], "cell int, v double")
    with pytest.raises(Exception, match="infinite"):
        masks.apply_support(df, mask, "v").collect()


def test_coarse_mean_uses_only_valid_weights(spark):
    df = frame(spark, [(0, 1, 0.0, 1.0), (0, 1, 60.0, None), (0, 1, 60.0, 4.0), (0, 2, 0.0, None)],
               "coarse int, ord int, lat double, v double")
    got = {r.ord: r.v for r in aggregate.coarse_mean(df, "v").collect()}
    assert got[1] == pytest.approx(2.0) and got[2] is None


def test_stores(spark, tmp_path):
    assert stores.parse_chunks("time=-1,lat=2") == {"time": -1, "lat": 2}
    for bad in ("lat=0", "lat=-2", "=3", "lat"):
        with pytest.raises(ValueError):
            stores.parse_chunks(bad)
    df = frame(spark, [(1, 1, 0.5), (2, 1, 1.5)], "cell int, ord int, v double")
    path = str(tmp_path / "store")
    stores.publish(df, path)
    with pytest.raises(FileExistsError):
        stores.publish(df, path)
    assert stores.append_segment(df.withColumn("ord", F.lit(2)), path, ["cell", "ord"]) == 2
    assert stores.append_segment(df.withColumn("ord", F.lit(2)), path, ["cell", "ord"]) == 0
    tiles = str(tmp_path / "tiles")
    stores.write_region(df, tiles, ["cell"])
    stores.write_region(df.where("cell = 2").withColumn("v", F.lit(9.0)), tiles, ["cell"])
    assert sorted(r.v for r in spark.read.parquet(tiles).collect()) == [0.5, 9.0]
    managed = str(tmp_path / "managed")
    assert stores.prepare_store(spark, managed, {"grid": 1, "revision": 1}, "v double") is False
    df.write.parquet(f"{managed}/data")
    assert stores.prepare_store(spark, managed, {"grid": 1, "revision": 2}, "v double") is True
    assert not stores.exists(spark, f"{managed}/data")
    with pytest.raises(ValueError):
        stores.prepare_store(spark, managed, {"grid": 2, "revision": 2}, "v double")


def test_discovery(spark, tmp_path):
    for part in ("m/historical/hist/tas", "m/ssp245/projection/tas"):
        (tmp_path / part).mkdir(parents=True)
    found = stores.discover(spark, str(tmp_path), ["tas"], {"historical": "hist"})
    assert [f["scenario"] for f in found] == ["historical", "ssp245"]
    with pytest.raises(ValueError, match="lacks"):
        stores.discover(spark, str(tmp_path), ["tas", "pr"], {"historical": "hist"})


def test_increments_are_appended_once(spark, tmp_path):
    incoming, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "cell int, ord int, v double"
    frame(spark, [(1, 1, 0.5), (1, 2, 0.6)], schema).write.parquet(incoming)
    append_increments(spark, incoming, schema, store, str(tmp_path / "c1")).awaitTermination()
    frame(spark, [(1, 2, 0.6), (1, 3, 0.7)], schema).write.mode("append").parquet(incoming)
    append_increments(spark, incoming, schema, store, str(tmp_path / "c2")).awaitTermination()
    assert sorted(r.ord for r in spark.read.parquet(store).collect()) == [1, 2, 3]


def test_presets_are_complete():
    assert set(VARIABLES) == {"hurs", "pr", "prsnratio", "ps", "rlds", "rsds", "sfcWind", "tas", "tasrange", "tasskew"}


# Mended faults: hostile values in quantiles, units, publishing, labels with many digits.

@pytest.mark.parametrize("bins", [1024, 8])
def test_quantiles_of_hostile_values_end_and_keep_rank(spark, monkeypatch, bins):
    from zephyrgrid.operators import quantiles

    monkeypatch.setattr(quantiles, "BINS", bins)
    inf = float("inf")
    for values in ([-inf, *range(3000)], [*range(3000), inf], [-inf, inf, *range(50)], [-1.7e308, 1.7e308, *range(3000)],
                   [float("nan"), *range(100)], [5e-324, 0.0, -5e-324, 1.0] + [i * 5e-324 for i in range(2, 40)], [-inf] * 50 + [inf] * 50):
        frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        kept = np.sort([v for v in map(float, values) if not np.isnan(v)])
        ranks = [0.0, 0.5, 1.0] if len(kept) % 2 else [0.0, 1.0]
        got = {r["p"]: r["quantile"] for r in quantiles.exact_quantiles(frame, "v", ranks).collect()}
        assert got == {p: kept[int((len(kept) - 1) * p)] for p in ranks}


@pytest.mark.parametrize("changed", [{"SMALL": 0, "MARGIN": 0.3}, {"SMALL": 0, "MARGIN": -0.2, "BINS": 8}, {"BINS": 8, "BROADCAST_BRACKETS": 0}])
def test_quantiles_of_many_groups_with_wide_wrong_and_deep_brackets(spark, monkeypatch, changed):
    """A negative margin makes every bracket miss its rank; the counts must show it."""
    for name, to in changed.items():
        monkeypatch.setattr(quantiles, name, to)
    draw = np.random.default_rng(8)
    groups = {f"g{i}": np.round(draw.normal(i, 3, draw.integers(1, 400)), 1) for i in range(12)}
    groups["same"], groups["endless"] = np.full(300, 2.5), np.array([-np.inf, 1.0, 2.0, np.inf, np.inf])
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("g0", None), ("g1", float("nan")), (None, 1.0)]
    got = {(r["k"], r["p"]): (r["n"], r["quantile"]) for r in quantiles.exact_quantiles(
        spark.createDataFrame(rows, "k string, v double"), "v", [0.0, 0.05, 0.5, 0.99, 1.0], by="k").collect()}
    assert len(got) == 5 * len(groups)
    for (g, p), (n, found) in got.items():
        assert n == len(groups[g])
        if g != "endless":
            assert found == pytest.approx(np.quantile(groups[g], p), abs=1e-9)
    assert got["endless", 0.5][1] == 2.0 and got["endless", 1.0][1] == np.inf and got["endless", 0.0][1] == -np.inf



def test_settings_follow_the_unit_of_the_data():
    from zephyrgrid.functions.presets import VARIABLES

    rate, daily = VARIABLES["pr"].in_unit(), VARIABLES["pr"].in_unit("mm d-1")
    assert daily.adapt_threshold == pytest.approx(0.1) and rate.adapt_threshold == pytest.approx(0.1 / 86400)
    assert rate.adjust_bounds.lower_threshold == pytest.approx(0.1 / 86400) and rate.downscale_bounds.lower == 0.0
    assert VARIABLES["rsds"].in_unit().adjust_bounds == VARIABLES["rsds"].adjust_bounds
    assert VARIABLES["tas"].in_unit("degC").downscale_bounds.lower == pytest.approx(150 - 273.15)
    with pytest.raises(ValueError):
        VARIABLES["pr"].in_unit("K")


def test_rain_per_second_survives_adjustment(spark):
    from zephyrgrid.operators.adjustment import adjust_variable

    rows = [(1, i, i % 365 + 1, (i % 365) // 31 + 1, 6e-5 * ((i * 37) % 100) / 100) for i in range(1095)]
    series = spark.createDataFrame(rows, "cell bigint, ord bigint, doy bigint, month bigint, pr double")
    out = adjust_variable(series, series, series, "pr", "pr")
    assert out.where("adjusted > 0").count() > 900 and out.where("adjusted > 1e-4").count() == 0


def test_publish_survives_a_crash_between_its_steps(spark, tmp_path, monkeypatch):
    from zephyrgrid.sources import stores

    path = str(tmp_path / "store")
    old, new = spark.range(3), spark.range(5)
    stores.publish(old, path)
    os.rename(path, f"{path}.replaced")  # as if the job had died after setting the old store aside
    assert stores.recover(spark, path) and not stores.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    stores.publish(new, path, overwrite=True)
    assert spark.read.parquet(path).count() == 5 and not os.path.exists(f"{path}.replaced")
    with pytest.raises(FileExistsError):
        stores.publish(old, path)


def test_batches_skip_what_is_published_and_refuse_what_differs(spark, tmp_path):
    from zephyrgrid.plans import pipeline

    frame = spark.createDataFrame([(c, o, 270.0 + c) for c in range(4) for o in range(400)], "cell bigint, ord bigint, v double")
    path = str(tmp_path / "tas")
    assert pipeline.publish_batch({path: (frame, "v", "tas")})[path]["skipped"] is False
    assert pipeline.publish_batch({path: (frame, "v", "tas")})[path]["skipped"] is True
    with pytest.raises(OSError):
        pipeline.publish_batch({path: (frame.where("cell < 3"), "v", "tas")})


def test_nan_in_a_store_is_missing(spark, tmp_path):
    from zephyrgrid.sources import stores

    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "k bigint, v double").write.parquet(str(tmp_path / "n"))
    assert {r["k"]: r["v"] for r in stores.open_cube(spark, str(tmp_path / "n")).collect()} == {1: None, 2: 3.0}


def test_edge_audit_reads_codes_of_any_length(spark):
    from zephyrgrid.operators import qc

    rows = [("same-10", 2.0, 1.0), ("same-7", 3.0, 0.0), ("7-10", 9.0, 1.0)]
    frame = spark.createDataFrame([(g, a, b, abs(a - b)) for g, a, b in rows], "pair string, first double, second double, difference double")
    got = {r["pair"]: r["control_ratio"] for r in qc.edge_audit(frame, "pair").collect()}
    assert got == {"same-10": None, "same-7": None, "7-10": 4.0}


def test_every_row_of_the_table_has_one_role(spark):
    from zephyrgrid.sources import cube

    directory = "/root/testdata/sf0.001"
    whole = cube.table(spark, directory, "lineitem").where("NOT (month(l_shipdate) = 2 AND day(l_shipdate) = 29)").count()
    assert cube.line_counts(spark, directory).agg(F.sum("lines")).first()[0] == whole
    together = cube.roles(spark, directory, "tas")
    for role in ("ref", "hist", "sim"):
        assert cube.role_series(spark, directory, role, "tas").exceptAll(together.where(F.col("role") == role).drop("role")).count() == 0


def test_training_series_read_the_table_once(spark):
    from zephyrgrid.plans.adjust_queries import series

    for frame in series(spark, "/root/testdata/sf0.001", "tas"):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "Scan ExistingRDD" in plan


def test_a_single_wrong_value_in_a_published_store_is_found(spark, tmp_path):
    """Counts and keys agree; only one code differs."""
    from zephyrgrid.plans import pipeline

    frame = spark.range(4).select(F.col("id").alias("cell")).crossJoin(spark.range(365).select(F.col("id").alias("ord"))).withColumn(
        "v", 280.0 + F.col("cell") + F.col("ord") / 100)
    path = str(tmp_path / "store")
    report = pipeline.publish(frame, "v", "tas", path)
    assert report["maximum_error"] <= 0.0025 + 1e-9
    pipeline.verify_published(frame, "v", "tas", path)
    with pytest.raises(OSError, match="does not hold"):
        pipeline.verify_published(frame.withColumn("v", F.col("v") + F.when(F.expr("cell = 2 AND ord = 77"), 0.006).otherwise(0.0)), "v", "tas", path)


def _passed_once(spark, frame):
    """The frame, and a counter of the rows that were taken from it."""
    taken = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            taken.add(len(part))
            yield part

    return frame.mapInPandas(counted, frame.schema), taken


def test_quantiles_of_counts_equal_those_of_rows(spark):
    rng = np.random.default_rng(7)
    values = [float(v) for v in np.r_[np.round(rng.normal(0, 900, 4000)), rng.normal(0, 1, 3000), [np.inf, -np.inf, 3.0]]]
    rows = spark.createDataFrame([("ab"[i % 2], v) for i, v in enumerate(values)] + [("a", None), ("b", float("nan")), ("c", None)], "g string, v double")
    counts = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    points = [0.0, 0.05, 0.5, 0.95, 1.0]
    want, got = ({(r["g"], r["p"]): (r["n"], r["quantile"]) for r in found.collect()}
                 for found in (quantiles.exact_quantiles(rows, "v", points, by="g"), quantiles.counted_quantiles(counts, "v", "n", points, "g")))
    assert len(want) == 10 and got == want


def test_edge_audit_takes_its_differences_once(spark):
    from zephyrgrid.operators import qc

    rows = [(p, None if i % 7 == 0 else float(i % 90), float(i % 11)) for p in ("same-1", "same-2", "1-2") for i in range(300)]
    frame = spark.createDataFrame(rows, "pair string, first double, second double").withColumn("difference", F.abs(F.col("first") - F.col("second")))
    once, taken = _passed_once(spark, frame)
    got = {r["pair"]: r for r in qc.edge_audit(once, "pair").collect()}
    assert taken.value == len(rows)
    steps = [abs(a - b) for p, a, b in rows if p == "1-2" and a is not None]
    assert (got["1-2"]["paired"], got["1-2"]["missing"]) == (len(steps), 300 - len(steps))
    assert got["1-2"]["p95"] == pytest.approx(np.quantile(steps, 0.95)) and got["1-2"]["control_ratio"] == 1.0


def test_edge_comparison_takes_its_joins_once(spark):
    from zephyrgrid.operators import aggregate

    rows = [(None if i % 5 == 0 else float(i % 37), float(i % 23), float(i % 8)) for i in range(400)]
    once, taken = _passed_once(spark, spark.createDataFrame(rows, "a double, b double, n double"))
    got = aggregate.edge_comparison(once, "a", "b", "n").first()
    assert taken.value == len(rows)
    now, then = [abs(a - n) for a, _, n in rows if a is not None], [abs(b - n) for _, b, n in rows]
    better = sum(abs(b - n) < abs(a - n) for a, b, n in rows if a is not None)
    assert (got["pairs"], got["improved"]) == (len(now), pytest.approx(better / len(now)))
    assert got["p95_now"] == pytest.approx(np.quantile(now, 0.95)) and got["p95_then"] == pytest.approx(np.quantile(then, 0.95))
    nothing = aggregate.edge_comparison(once.where("false"), "a", "b", "n").collect()
    assert [tuple(r) for r in nothing] == [(0, None, None, None, None, None)]
