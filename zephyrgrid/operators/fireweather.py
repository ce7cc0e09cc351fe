"""Daily fire weather: moisture codes with memory, and the indices built on them.

The three codes depend on yesterday, so a grouped-map call walks the days of a
small tile of cells with all cells of the tile as one vector.  Everything else
(units, spread, build-up, final index, masks, checks) is column expressions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fire, units
from ..session import place_by

# Start codes, season limits (three days, degrees Celsius), overwintering.
START_FFMC, START_DMC, START_DC = 85.0, 6.0, 15.0
SEASON_DAYS, SEASON_START_C, SEASON_END_C = 3, 12.0, 5.0
CARRY_OVER, WETTING = 0.75, 0.75

# Effective day length of the duff code by month, for the latitude
# bands below -30, -30..-15, -15..15, 15..30 and above 30 degrees.
DAY_LENGTH = np.array([
    [11.5, 10.5, 9.2, 7.9, 6.8, 6.2, 6.5, 7.4, 8.7, 10.0, 11.2, 11.8],
    [10.1, 9.6, 9.1, 8.5, 8.1, 7.8, 7.9, 8.3, 8.9, 9.4, 9.9, 10.2],
    [9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0],
    [7.9, 8.4, 8.9, 9.5, 9.9, 10.2, 10.1, 9.7, 9.1, 8.6, 8.1, 7.8],
    [6.5, 7.5, 9.0, 12.8, 13.9, 13.9, 12.4, 10.9, 9.4, 8.0, 7.0, 6.0],
])
DAY_LENGTH_EDGES = np.array([-30.0, -15.0, 15.0, 30.0])
# Drying factor of the drought code, for below -15, -15..15 and above 15 degrees.
DRYING = np.array([
    [6.4, 5.0, 2.4, 0.4, -1.6, -1.6, -1.6, -1.6, -1.6, 0.9, 3.8, 5.8],
    [1.39, 1.39, 1.39, 1.39, 1.39, 1.39, 1.39, 1.39, 1.39, 1.39, 1.39, 1.39],
    [-1.6, -1.6, -1.6, 0.9, 3.8, 5.8, 6.4, 5.0, 2.4, 0.4, -1.6, -1.6],
])
DRYING_EDGES = np.array([-15.0, 15.0])


def ffmc_weather(t, rain, wind, rh):
    """What the fine fuel moisture code takes from the weather alone, for any number of days at once."""
    rf = np.maximum(rain - 0.5, 1e-300)
    humid = np.exp((rh - 100.0) / 10.0)
    warm = 0.18 * (21.1 - t) * (1.0 - np.exp(-0.115 * rh))
    def rate(share):
        return (0.424 * (1.0 - share**1.7) + 0.0694 * np.sqrt(wind) * (1.0 - share**8)) * 0.581 * np.exp(0.0365 * t)

    return (rain > 0.5, 42.5 * rf, 1.0 - np.exp(-6.93 / rf), np.sqrt(rf), 0.942 * rh**0.679 + 11.0 * humid + warm,
            0.618 * rh**0.753 + 10.0 * humid + warm, 10.0 ** -rate(rh / 100.0), 10.0 ** -rate((100.0 - rh) / 100.0), 0.0 * (t + rain + wind + rh))


def ffmc_after(weather, before):
    """Fine fuel moisture code of one day from its `ffmc_weather` and yesterday's code."""
    rained, soak, share, root, dry_end, wet_end, dry_rate, wet_rate, missing = weather
    m = 147.2 * (101.0 - before) / (59.5 + before)
    wet = m + soak * np.exp(-100.0 / (251.0 - m)) * share
    wet = wet + np.where(m > 150.0, 0.0015 * (m - 150.0) ** 2 * root, 0.0)
    m = np.where(rained, np.minimum(wet, 250.0), m)
    drying = dry_end + (m - dry_end) * dry_rate
    wetting = wet_end - (wet_end - m) * wet_rate
    after = np.where(m > dry_end, drying, np.where((m < dry_end) & (m < wet_end), wetting, m))
    return np.minimum(np.maximum(59.5 * (250.0 - after) / (147.2 + after), 0.0), 101.0) + missing


def dmc_weather(t, rain, rh, length):
    """What the duff moisture code takes from the weather alone."""
    drying = np.where(t < -1.1, 0.0, 1.894 * (t + 1.1) * (100.0 - rh) * length * 1e-4)
    return rain > 1.5, 0.92 * rain - 1.27, drying, 0.0 * (t + rain + rh)


def dmc_after(weather, before):
    """Duff moisture code of one day."""
    rained, net, drying, missing = weather
    moisture = 20.0 + 280.0 / np.exp(0.023 * before)
    logged = np.log(np.maximum(before, 1e-300))
    slope = np.where(before <= 33.0, 100.0 / (0.5 + 0.3 * before),
                     np.where(before <= 65.0, 14.0 - 1.3 * logged, 6.2 * logged - 17.2))
    wetter = moisture + 1000.0 * net / (48.77 + slope * net)
    wet = np.maximum(43.43 * (5.6348 - np.log(np.maximum(wetter - 20.0, 1e-300))), 0.0)
    return np.maximum(np.where(rained, wet, before) + drying, 0.0) + missing


def dc_weather(t, rain, factor):
    """What the drought code takes from the weather alone."""
    drying = np.maximum((0.36 * (np.maximum(t, -2.8) + 2.8) + factor) / 2.0, 0.0)
    return rain > 2.8, 3.937 * np.maximum(0.83 * rain - 1.27, 0.0), drying, 0.0 * (t + rain)


def dc_after(weather, before):
    """Drought code of one day."""
    rained, net, drying, missing = weather
    wet = before - 400.0 * np.log(1.0 + net / (800.0 * np.exp(-before / 400.0)))
    return np.where(rained, np.maximum(wet, 0.0), before) + drying + missing


def next_ffmc(t, rain, wind, rh, before):
    """Fine fuel moisture code of one day (temperature C, rain mm, wind km/h, humidity %)."""
    return ffmc_after(ffmc_weather(t, rain, wind, rh), before)


def next_dmc(t, rain, rh, length, before):
    """Duff moisture code of one day."""
    return dmc_after(dmc_weather(t, rain, rh, length), before)


def next_dc(t, rain, factor, before):
    """Drought code of one day."""
    return dc_after(dc_weather(t, rain, factor), before)


def code_weather(t, rain, wind, rh, month, lat):
    """The weather terms of the three codes for all days (days x cells; ``month`` from 0)."""
    cells = np.arange(t.shape[1])
    length = DAY_LENGTH[np.searchsorted(DAY_LENGTH_EDGES, lat, side="right")][cells, month]
    factor = DRYING[np.searchsorted(DRYING_EDGES, lat, side="right")][cells, month]
    return ffmc_weather(t, rain, wind, rh), dmc_weather(t, rain, rh, length), dc_weather(t, rain, factor)


def codes_after(weather, day: int, before, cells: slice = slice(None)):
    """The three codes of one day for the chosen cells."""
    return tuple(step(tuple(w[day, cells] for w in terms), b) for step, terms, b in zip((ffmc_after, dmc_after, dc_after), weather, before))


def overwintered_dc(autumn, winter_rain):
    """Spring drought code from the last autumn's and the winter precipitation."""
    store = CARRY_OVER * 800.0 * np.exp(-autumn / 400.0) + WETTING * 3.94 * winter_rain
    return np.maximum(400.0 * np.log(800.0 / store), START_DC)


def season_days(t: np.ndarray) -> np.ndarray:
    """Active days (days x cells): starts after three warm days, stops after three cold ones."""
    active = np.zeros(t.shape, dtype=bool)
    for day in range(SEASON_DAYS, t.shape[0]):
        last = t[day - SEASON_DAYS:day]
        start = (last > SEASON_START_C).all(axis=0)
        stop = (last < SEASON_END_C).all(axis=0)
        active[day] = (active[day - 1] | start) & ~stop
    return active


def moisture_codes(t, rain, wind, rh, month, lat, active=None):
    """(3, days, cells) codes; without ``active`` every day counts and nothing overwinters."""
    shape = t.shape
    codes = np.full((3, *shape), np.nan)
    state = [np.full(shape[1], START_FFMC), np.full(shape[1], START_DMC), np.full(shape[1], START_DC)]
    running = np.ones(shape[1], dtype=bool) if active is None else np.zeros(shape[1], dtype=bool)
    autumn = np.full(shape[1], np.nan)
    winter = np.zeros(shape[1])
    with np.errstate(all="ignore"):
        weather = code_weather(t, rain, wind, rh, month, lat)
        for day in range(shape[0]):
            on = running if active is None else active[day]
            starting, stopping = on & ~running, running & ~on
            if starting.any():
                spring = np.where(np.isnan(autumn), START_DC, overwintered_dc(autumn, winter))
                for i, fresh in enumerate((START_FFMC, START_DMC, spring)):
                    state[i] = np.where(starting, fresh, state[i])
                autumn[starting] = np.nan
            if stopping.any():
                autumn = np.where(stopping, state[2], autumn)
                winter = np.where(stopping, rain[day], winter)
            idle = ~on & ~stopping
            winter = np.where(idle, winter + rain[day], winter)
            running = on
            if not on.any():
                continue
            fresh = codes_after(weather, day, state)
            for i in range(3):
                state[i] = np.where(on, fresh[i], state[i])
                codes[i, day] = np.where(on, state[i], np.nan)
    return codes


def tile_codes(rows: pd.DataFrame, seasonal: bool) -> pd.DataFrame:
    """Codes of all cells of one tile; cells never active are redone without a season."""
    rows = rows.sort_values(["cell", "ord"], kind="stable")
    cell = rows["cell"].to_numpy()
    names, column = np.unique(cell, return_inverse=True)
    first = np.searchsorted(cell, names)
    step = np.arange(cell.size) - first[column]
    shape = (int(step.max()) + 1, names.size)

    def grid(name: str, fill: float = np.nan, dtype=float) -> np.ndarray:
        out = np.full(shape, fill, dtype=dtype)
        out[step, column] = rows[name].to_numpy(dtype=dtype)
        return out

    weather = [grid(n) for n in ("t", "rain", "wind", "rh")]
    month = grid("month", 1, int) - 1
    lat = rows["lat"].to_numpy(dtype=float)[first]
    if not seasonal:
        codes = moisture_codes(*weather, month, lat)
        fallback = np.ones(names.size, dtype=bool)
    else:
        codes = moisture_codes(*weather, month, lat, season_days(weather[0]))
        fallback = ~np.isfinite(codes).any(axis=(0, 1))
        if fallback.any():
            codes[:, :, fallback] = moisture_codes(
                *[w[:, fallback] for w in weather], month[:, fallback], lat[fallback])
    picked = codes[:, step, column]
    return pd.DataFrame({
        "cell": cell, "ord": rows["ord"].to_numpy(), "wind": rows["wind"].to_numpy(),
        "ffmc": picked[0], "dmc": picked[1], "dc": picked[2], "always_on": fallback[column]})


def daily_fire_weather(df: DataFrame, precipitation_unit: str = "mm d-1", seasonal: bool = True, tile_cells: int = 16) -> DataFrame:
    """Six daily indices from (cell, ord, month, lat, tas K, hurs %, pr, wind m/s).

    Days of a cell are taken in order, so history goes in front by a union and
    is filtered off afterwards.  A tile holds ``tile_cells`` cells at most.
    """
    inputs = df.select(
        "cell", "ord", "month", "lat",
        F.expr(f"cell div {tile_cells}").alias("tile"),
        units.convert(F.col("tas"), "K", "degC").alias("t"),
        units.convert(F.col("pr"), precipitation_unit, "mm d-1").alias("rain"),
        units.convert(F.col("wind"), "m s-1", "km h-1").alias("wind"), F.col("hurs").alias("rh"))
    codes = place_by(inputs, "tile").groupBy("tile").applyInPandas(
        lambda rows: tile_codes(rows, seasonal),
        "cell bigint, ord bigint, wind double, ffmc double, dmc double, dc double, always_on boolean")
    clean = codes.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("ffmc", "dmc", "dc")})
    clean = clean.withColumn("isi", fire.initial_spread(F.col("ffmc"), F.col("wind"))).withColumn(
        "bui", fire.buildup(F.col("dmc"), F.col("dc")))
    return clean.withColumn("fwi", fire.fire_weather(F.col("isi"), F.col("bui"))).drop("wind")


def fire_report(df: DataFrame, support: DataFrame) -> DataFrame:
    """One row: supported cells without any value, the smallest value, infinite values."""
    names = ("ffmc", "dmc", "dc", "isi", "bui", "fwi")
    per_cell = df.groupBy("cell").agg(
        *[F.count(n).alias(f"{n}_n") for n in names],
        F.least(*[F.min(n) for n in names]).alias("low"),
        F.max(F.exists(F.array(*names), lambda v: F.abs(v) == F.lit(float("inf")))).alias("infinite"))
    joined = support.where("support").select("cell").join(per_cell, "cell", "left")
    empty = F.exists(F.array(*[F.coalesce(f"{n}_n", F.lit(0)) for n in names]), lambda n: n == 0)
    return joined.agg(
        F.count_if(empty).alias("cells_without_value"), F.min("low").alias("minimum"),
        F.coalesce(F.bool_or("infinite"), F.lit(False)).alias("has_infinite"),
    ).withColumn("valid", (F.col("cells_without_value") == 0) & (F.col("minimum") >= -1e-9) & ~F.col("has_infinite"))
