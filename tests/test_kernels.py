"""Golden vectors and brute-force checks of the numeric kernels."""

import numpy as np
import pandas as pd

from zephyrgrid.functions.presets import Bounds
from zephyrgrid.operators import adjustment, downscale, fireweather, humidity


def test_humidity_window_golden_vector():
    observed = np.array([5, 15, 25, 40, 55, 70, 80, 90, 95, 99.0])
    historical = np.array([8, 18, 30, 48, 65, 82, 95, 101, 104, 110.0])
    simulation = np.array([6, 20, 35, 50, 68, 85, 98, 103, 108, 115, 72, 100.5])
    # The published result for this sample.
    expected = [3.75, 16.266575854700857, 29.677192841880345, 42.63793227307152, 58.05585632370443,
                72.66235205777792, 87.96663231062661, 93.42852212792297, 98.6217086618368,
                99.0000393032093, 61.489093827186174, 91.26262116002363]
    actual = humidity.adjust_windows([observed], [historical], [simulation], 5, 0)[0]
    np.testing.assert_allclose(actual, expected, rtol=0, atol=1e-11)


def test_weighted_sum_core_golden_vector():
    observations = np.array([[1.0, 5.0], [2.0, 4.0], [3.0, 8.0], [4.0, 7.0], [5.0, 9.0], [6.0, 6.0]])
    coarse = np.array([2.0, 3.0, 4.0, 5.0, 6.0])
    fine = np.array([[1.5, 2.5], [2.5, 3.5], [3.5, 4.5], [4.5, 5.5], [5.5, 6.5]])
    # The published result for this sample.
    expected = [[0.00155682408, 2.78048780], [1.23028218, 3.97549408], [2.37329178, 5.25830433],
                [3.55867130, 6.86961402], [4.95583388, 7.65853659]]
    actual = downscale.preserve_weighted_sum(
        observations, coarse, fine, np.array([0.8, 1.0]), downscale.random_rotations(2, 2, 3), 3)
    np.testing.assert_allclose(actual, expected, rtol=0, atol=1e-8)


def test_rotations_are_orthogonal_and_repeatable():
    for q in downscale.random_rotations(4, 3, 0):
        np.testing.assert_allclose(q @ q.T, np.eye(4), atol=1e-12)
    direction = np.array([1.0, 2.0, 3.0]) / np.sqrt(14.0)
    first = downscale.first_rotation(direction)
    np.testing.assert_allclose(direction @ first, [1.0, 0.0, 0.0], atol=1e-12)


def test_gap_filling_keeps_known_values_and_is_repeatable():
    values = np.array([np.nan, 1.0, 3.0, np.nan, 2.0, np.nan])
    matrix = np.column_stack([values, np.arange(6.0), np.full(6, np.nan), np.where(np.arange(6) == 2, 4.0, np.nan)])
    fallback = np.array([np.nan, np.nan, 5.0, np.nan])
    a, b = (downscale.fill_gaps(matrix, fallback, 7) for _ in range(2))
    np.testing.assert_array_equal(a, b)
    np.testing.assert_array_equal(a[[1, 2, 4], 0], [1.0, 3.0, 2.0])
    np.testing.assert_array_equal(a[:, 1:], np.column_stack([np.arange(6.0), np.full(6, 5.0), np.full(6, 4.0)]))
    assert np.isfinite(a).all() and a.min() >= 0.0 and a[:, 0].max() <= 3.0
    # Ranks 0, 2, 1 on days 1, 2, 4: lines give places -2, 1.5 and 0.5 to days 0, 3 and 5.
    assert a[0, 0] <= a[5, 0] <= a[3, 0]
    np.testing.assert_array_equal(a[:, 0], downscale.fill_gaps(matrix[:, :1], fallback[:1], 7)[:, 0])
    with np.testing.assert_raises(ValueError):
        downscale.fill_gaps(np.full((3, 1), np.nan), np.array([np.nan]), 0)


def test_windows_side_by_side_equal_single_ones():
    draw = np.random.RandomState(2)
    sides = [[np.clip(draw.normal(60, spread, draw.randint(1, 70)), -5, 105) for _ in range(25)] for spread in (20, 30, 40)]
    together = humidity.adjust_windows(*sides, 50, 3)
    for row, obs, past, future in zip(together, *sides):
        alone = humidity.adjust_windows([obs], [past], [future], 50, 3)[0]
        np.testing.assert_array_equal(row[:future.size], alone)
        assert np.isnan(row[future.size:]).all() and (alone >= 0).all() and (alone <= 100).all()


def test_censored_values_spread_between_bound_and_threshold():
    bounds = Bounds(0.0, 0.1)
    out = downscale.spread_censored(np.array([0.0, 0.05, 0.0, 2.0]), bounds, 0)
    assert (out[:3] >= 0).all() and (out[:3] <= 0.1).all() and out[3] == 2.0
    assert out[1] == out[:3].max()
    np.testing.assert_array_equal(downscale.snap(out, bounds), [0.0, 0.0, 0.0, 2.0])


def test_published_fire_weather_example():
    """First days of the sample series of Van Wagner and Pickett (1985)."""
    t = np.array([[17.0], [20.0], [8.5], [6.5], [13.0]])
    rh = np.array([[42.0], [21.0], [40.0], [25.0], [34.0]])
    wind = np.array([[25.0], [25.0], [17.0], [6.0], [24.0]])
    rain = np.array([[0.0], [2.4], [0.0], [0.0], [0.0]])
    month = np.full((5, 1), 3)
    codes = fireweather.moisture_codes(t, rain, wind, rh, month, np.array([50.0]))
    np.testing.assert_allclose(codes[0, :, 0], [87.7, 86.2, 87.0, 88.8, 89.1], atol=0.15)
    np.testing.assert_allclose(codes[1, :, 0], [8.5, 10.4, 11.8, 13.2, 15.4], atol=0.15)
    np.testing.assert_allclose(codes[2, :, 0], [19.0, 23.6, 26.1, 28.2, 31.5], atol=0.15)


def test_season_starts_after_three_warm_days_and_stops_after_three_cold_ones():
    t = np.array([[13.0]] * 5 + [[4.0]] * 5 + [[13.0]] * 4)
    assert fireweather.season_days(t)[:, 0].tolist() == [False] * 3 + [True] * 5 + [False] * 5 + [True]


def test_overwintering_feeds_the_spring_code():
    t = np.array([[15.0]] * 40 + [[0.0]] * 40 + [[15.0]] * 20)
    rain, wind, rh = np.zeros_like(t), np.full_like(t, 10.0), np.full_like(t, 40.0)
    month = np.zeros(t.shape, dtype=int) + 6
    codes = fireweather.moisture_codes(t, rain, wind, rh, month, np.array([50.0]), fireweather.season_days(t))
    dc = codes[2, :, 0]
    off = np.flatnonzero(np.isnan(dc[43:]))[-1] + 43
    autumn = dc[np.flatnonzero(np.isfinite(dc[:60]))[-1]]
    spring = fireweather.overwintered_dc(np.array(autumn), 0.0)
    assert np.isclose(dc[off + 1], fireweather.next_dc(15.0, 0.0, 6.4, spring))


def test_never_active_cells_fall_back_to_always_on():
    rows = pd.DataFrame({
        "cell": np.repeat([1, 2], 30), "ord": np.tile(np.arange(30), 2), "month": 6, "lat": 50.0,
        "t": np.repeat([3.0, 20.0], 30), "rain": 0.0, "wind": 10.0, "rh": 40.0})
    out = fireweather.tile_codes(rows, seasonal=True)
    assert out.groupby("cell")["always_on"].first().tolist() == [True, False]
    assert out[out["cell"] == 1]["ffmc"].notna().all()


def _cell_series(years=3):
    draw = np.random.RandomState(5)
    rows = []
    for number, role in enumerate(("ref", "hist", "sim")):
        order = np.sort(draw.choice(years * 365, years * 200, replace=False)) + number * years * 365
        value = np.clip(np.round(draw.normal(50, 40, order.size)), 0, 100)
        rows.append(pd.DataFrame({"cell": 1, "role": role, "ord": order, "g": order % 365 + 1, "doy": order % 365 + 1, "month": 1 + np.minimum(order % 365 // 31, 11), "v": value}))
    return pd.concat(rows, ignore_index=True)


def test_a_cell_equals_its_windows_and_draws_are_made_once():
    rows = _cell_series()
    humidity.tail_draws.cache_clear()
    out = humidity.adjust_cell(rows, 15, 50, 0)
    made = humidity.tail_draws.cache_info().misses
    again = humidity.adjust_cell(rows.assign(cell=2), 15, 50, 0)
    assert humidity.tail_draws.cache_info().misses == made  # another cell with the same counts draws nothing
    np.testing.assert_array_equal(out["adjusted"], again["adjusted"])
    by_role = {role: part.reset_index(drop=True) for role, part in rows.groupby("role")}
    for centre in (1, 7, 180, 365):
        near = {role: part[np.minimum((part["g"] - centre) % 365, (centre - part["g"]) % 365) <= 15] for role, part in by_role.items()}
        moved = humidity.adjust_windows(*[[near[role]["v"].to_numpy()] for role in ("ref", "hist", "sim")], 50, 0)[0]
        own = (near["sim"]["g"] == centre).to_numpy()
        np.testing.assert_array_equal(out["adjusted"].to_numpy()[near["sim"].index[own]], moved[own])


def test_fit_of_all_windows_equals_single_fits(monkeypatch):
    rows = _cell_series()
    rows["v"] = np.maximum(rows["v"] - 40, 0) / 10
    nodes, calls, plain = np.array(adjustment.quantile_nodes(20)), [], adjustment.adapt_dry_windows
    monkeypatch.setattr(adjustment, "adapt_dry_windows", lambda *a: calls.append(1) or plain(*a))
    fit = adjustment.fit_cell(rows[rows["role"] != "sim"], "qdm", "multiplicative", "dayofyear", 15, nodes, 0.1).set_index("g")
    assert len(calls) <= 5  # 365 windows, 73 at a time
    samples = {role: dict(adjustment.group_samples(*[p[c].to_numpy() for c in ("doy", "month", "ord")], p["v"].to_numpy(), "dayofyear", 15))
               for role, p in rows[rows["role"] != "sim"].groupby("role")}
    assert sorted(samples["ref"].keys() & samples["hist"].keys()) == fit.index.tolist()
    for g in (1, 30, 200, 364):
        ref, hist = adjustment.adapt_dry_days(samples["ref"][g], samples["hist"][g], 0.1)
        rq, hq = (humidity.linear_quantiles(s, nodes) for s in (ref, hist))
        with np.errstate(divide="ignore", invalid="ignore"):
            np.testing.assert_array_equal(fit.loc[g, "af"], np.where(hq == 0, np.nan, rq / hq))
        assert fit.loc[g, "scaling"] == ref.mean() / hist.mean()
