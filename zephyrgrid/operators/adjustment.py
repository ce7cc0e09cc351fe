"""Bias adjustment on long tables: scaling, quantile delta mapping, detrended mapping.

Series are (cell, ord, doy, month, value).  Training places both series by cell,
whose rows the calendar bounds, and reduces each window to a quantile array.
Applying is an equi-join on (cell, group), window ranks and an array lookup, all
column expressions.  Nothing draws random numbers: where the published method
jitters values, evenly spaced steps stand for the expected order.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import physics as ph
from ..functions.presets import VariableSettings, settings
from ..session import place_by
from .humidity import CENTRES_AT_ONCE, Samples

KINDS = ("additive", "multiplicative")


def quantile_nodes(n: int) -> list[float]:
    """Mid-points of n equal probability classes."""
    if n < 2:
        raise ValueError("quantiles must be at least 2")
    return [(i + 0.5) / n for i in range(n)]


def _combine(value: Column, factor: Column, kind: str) -> Column:
    return value + factor if kind == "additive" else value * factor


def _correction(target: Column, source: Column, kind: str) -> Column:
    return target - source if kind == "additive" else F.try_divide(target, source)


def _correct(target: np.ndarray, source: np.ndarray, kind: str) -> np.ndarray:
    if kind == "additive":
        return target - source
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(source == 0, np.nan, target / source)


def group_windows(
    day: np.ndarray, month: np.ndarray, order: np.ndarray, value: np.ndarray, group: str, half_width: int,
    period: int = 365,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(groups, samples, sizes) of one series, many groups at a time; a sample is a row of sorted valid values, padded with NaN.

    ``dayofyear`` groups slide over the year: a day counts for a centre within
    ``half_width`` days when that centre lies inside the series, as in a centred
    rolling window.
    """
    value = np.where(np.isfinite(value), value, np.nan)
    if group == "month":
        numbers = np.unique(month)
        samples = Samples.of([value[month == number] for number in numbers])
        yield numbers, samples.ordered, samples.sizes
        return
    by_day = np.argsort(day, kind="stable")
    # The sorted days once before and once after the year, so a window is one slice.
    days = day[by_day]
    line = np.concatenate([days - period, days, days + period])
    v, o = np.tile(value[by_day], 3), np.tile(order[by_day], 3)
    centres = np.unique(day)
    for start in range(0, centres.size, CENTRES_AT_ONCE):
        part = centres[start:start + CENTRES_AT_ONCE]
        low = np.searchsorted(line, part - half_width)[:, None]
        inside = low + np.arange((np.searchsorted(line, part + half_width, side="right") - low[:, 0]).max())
        near = inside < np.searchsorted(line, part + half_width, side="right")[:, None]
        inside = np.where(near, inside, 0)
        at = o[inside] - (line[inside] - part[:, None])
        samples = Samples(np.where(near & (at >= order.min()) & (at <= order.max()), v[inside], np.nan))
        yield part, samples.ordered, samples.sizes


def group_samples(
    day: np.ndarray, month: np.ndarray, order: np.ndarray, value: np.ndarray, group: str, half_width: int,
    period: int = 365,
) -> Iterator[tuple[int, np.ndarray]]:
    """(group, sorted valid values) of one series, see `group_windows`."""
    for groups, samples, sizes in group_windows(day, month, order, value, group, half_width, period):
        for number, sample, size in zip(groups, samples, sizes):
            yield int(number), sample[:size]


def _quantiles(samples: np.ndarray, sizes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Linear quantiles of sorted rows with ``sizes`` values; ``p`` has a row for each or one for all."""
    last = (sizes - 1)[:, None]
    place = p * last
    low = np.floor(place).astype(int)
    left, right = (np.take_along_axis(samples, np.minimum(low + k, last), axis=1) for k in (0, 1))
    return (right - left) * (place - low) + left


def spread_below(samples: np.ndarray, threshold: float) -> np.ndarray:
    """Replace the values under the threshold of sorted rows by even steps between 0 and it."""
    low = (samples < threshold).sum(axis=1)[:, None]
    place = np.arange(samples.shape[1])
    return np.where(place < low, (place + 0.5) * threshold / np.maximum(low, 1), samples)


def adapt_dry_windows(
    reference: np.ndarray, ref_sizes: np.ndarray, historical: np.ndarray, hist_sizes: np.ndarray, threshold: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Give each sorted historical sample the dry-day frequency of its reference; rows are padded with NaN.

    When the historical sample has the larger share of values at or under the
    threshold, those ranked between both shares move evenly into (threshold,
    reference quantile at the historical share).
    """
    reference, historical = spread_below(reference, threshold), spread_below(historical, threshold)
    wet_ref, wet_hist = ((s <= threshold).sum(axis=1) / n for s, n in ((reference, ref_sizes), (historical, hist_sizes)))
    start, stop = (f(share * (hist_sizes - 1)).astype(int)[:, None] for f, share in ((np.ceil, wet_ref), (np.floor, wet_hist)))
    top = _quantiles(reference, ref_sizes, wet_hist[:, None])
    place, count = np.arange(historical.shape[1]), np.maximum(stop - start + 1, 1)
    moving = (wet_hist > wet_ref)[:, None] & (place >= start) & (place <= stop)
    moved = threshold + (top - threshold) * (place - start + 0.5) / count
    return reference, np.sort(np.where(moving, moved, historical), axis=1)


def adapt_dry_days(reference: np.ndarray, historical: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """`adapt_dry_windows` for one pair of samples."""
    ref, hist = adapt_dry_windows(
        reference[None, :], np.array([reference.size]), historical[None, :], np.array([historical.size]), threshold)
    return ref[0], hist[0]


def fit_windows(
    ref: np.ndarray, ref_sizes: np.ndarray, hist: np.ndarray, hist_sizes: np.ndarray, method: str, kind: str,
    nodes: np.ndarray, adapt_threshold: float | None,
) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """(scaling, af, hist_q) of many pairs of sorted samples at once."""
    if adapt_threshold is not None:
        ref, hist = adapt_dry_windows(ref, ref_sizes, hist, hist_sizes, adapt_threshold)
    means = [np.array([row[:n].mean() for row, n in zip(s, sizes)]) for s, sizes in ((ref, ref_sizes), (hist, hist_sizes))]
    scaling = _correct(*means, kind)
    if method == "scaling":
        return scaling, None, None
    rq, hq = _quantiles(ref, ref_sizes, nodes), _quantiles(hist, hist_sizes, nodes)
    if method == "dqm":
        rq, hq = (_correct(q, mean[:, None], kind) for q, mean in zip((rq, hq), means))
    # Whole multiples of 1e-9, so that equal quantiles compare equal.
    return scaling, _correct(rq, hq, kind), np.rint(hq * 1e9) / 1e9


def fit_cell(
    rows: pd.DataFrame, method: str, kind: str, group: str, half_width: int, nodes: np.ndarray,
    adapt_threshold: float | None,
) -> pd.DataFrame:
    """Fit rows of one cell; the calendar bounds its reference and historical days."""
    series = {}
    for role in ("ref", "hist"):
        part = rows[rows["role"] == role]
        series[role] = [*[part[c].to_numpy() for c in ("doy", "month", "ord")], part["v"].to_numpy(dtype=float)]
    # Groups that only one series has are no groups of the fit, but their days count for their neighbours.
    shared = np.intersect1d(*[s[0 if group == "dayofyear" else 1] for s in series.values()])
    fits = []
    if shared.size:
        sides = []
        for s in series.values():
            chosen = [tuple(x[keep] for x in found) for found in group_windows(*s, group, half_width) for keep in [np.isin(found[0], shared)]]
            width = max(samples.shape[1] for _, samples, _ in chosen)
            sides.append((np.concatenate([np.pad(samples, ((0, 0), (0, width - samples.shape[1])), constant_values=np.nan) for _, samples, _ in chosen]),
                          np.concatenate([sizes for _, _, sizes in chosen])))
        (ref, ref_sizes), (hist, hist_sizes) = sides
        held = np.flatnonzero((ref_sizes > 0) & (hist_sizes > 0))
        for start in range(0, held.size, CENTRES_AT_ONCE):
            at = held[start:start + CENTRES_AT_ONCE]
            scaling, af, hist_q = fit_windows(ref[at], ref_sizes[at], hist[at], hist_sizes[at], method, kind, nodes, adapt_threshold)
            none = [None] * at.size
            fits.append(pd.DataFrame({"cell": int(rows["cell"].iloc[0]), "g": shared[at], "scaling": scaling,
                                      "af": none if af is None else list(af), "hist_q": none if hist_q is None else list(hist_q)}))
    return pd.concat(fits) if fits else pd.DataFrame([], columns=["cell", "g", "scaling", "af", "hist_q"])


def _tagged(df: DataFrame, role: str, value: str) -> DataFrame:
    return df.select("cell", F.lit(role).alias("role"), "doy", "month", "ord", F.col(value).cast("double").alias("v"))


def train(
    reference: DataFrame, historical: DataFrame, value: str, method: str, kind: str,
    group: str = "dayofyear", window: int = 31, quantiles: int = 50, adapt_threshold: float | None = None,
) -> DataFrame:
    """The fit table: (cell, g, scaling) and, for the mapping methods, (af, hist_q).

    Both series are placed by cell once; the sliding windows of a cell are
    sorted and reduced to quantiles where they are, so no row is copied to its
    31 centres.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    if method not in ("qdm", "dqm", "scaling"):
        raise ValueError(f"unknown method {method!r}")
    if group not in ("dayofyear", "month"):
        raise ValueError(f"unknown group {group!r}")
    if window < 1 or window % 2 == 0:
        raise ValueError("window must be a positive odd integer")
    nodes = np.array(quantile_nodes(quantiles))
    half_width = window // 2
    both = _tagged(reference, "ref", value).unionByName(_tagged(historical, "hist", value))
    fit = place_by(both, "cell").groupBy("cell").applyInPandas(
        lambda rows: fit_cell(rows, method, kind, group, half_width, nodes, adapt_threshold),
        "cell bigint, g bigint, scaling double, af array<double>, hist_q array<double>")
    known = fit.withColumn("scaling", F.when(~F.isnan("scaling"), F.col("scaling")))
    return known.select("cell", "g", "scaling") if method == "scaling" else known


def _group_column(group: str) -> Column:
    return F.col("doy") if group == "dayofyear" else F.col("month")


def apply_scaling(simulation: DataFrame, fit: DataFrame, value: str, kind: str, group: str = "dayofyear") -> DataFrame:
    sim = simulation.withColumn("g", _group_column(group))
    joined = sim.join(fit.select("cell", "g", "scaling"), ["cell", "g"], "left")
    return joined.withColumn("adjusted", _combine(F.col(value), F.col("scaling"), kind)).drop("g", "scaling")


def relative_rank(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Add ``tau``: mean rank among the group, stretched so the smallest value has 0.

    NULL for missing values and for groups whose values are all the same.
    """
    present = F.col(value).isNotNull()
    by_value = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    ties = Window.partitionBy(*keys, value)
    everything = Window.partitionBy(*keys)
    ranked = df.withColumn("rank", F.when(
        present, F.rank().over(by_value) + (F.count(F.lit(1)).over(ties) - 1) / F.lit(2.0)))
    low, high = F.min("rank").over(everything), F.max("rank").over(everything)
    n = F.count(value).over(everything)
    ranked = ranked.withColumns({"tau_num": high * (F.col("rank") - low), "tau_den": (high - low) * n})
    return ranked.drop("rank")


def apply_qdm(
    simulation: DataFrame, fit: DataFrame, value: str, kind: str, group: str = "dayofyear",
    quantiles: int = 50, interpolation: str = "nearest",
) -> DataFrame:
    """Quantile delta mapping: the factor of the simulated value's own rank in its group."""
    sim = relative_rank(simulation.withColumn("g", _group_column(group)), value, ["cell", "g"])
    joined = sim.join(fit.select("cell", "g", "af"), ["cell", "g"], "left")
    place = F.try_divide(F.lit(float(quantiles)) * F.col("tau_num"), F.col("tau_den")) - 0.5
    factor = _array_at(F.col("af"), place, quantiles, interpolation)
    return joined.withColumn("adjusted", _combine(F.col(value), factor, kind)).drop("g", "af", "tau_num", "tau_den")


def _array_at(values: Column, place: Column, size: int, interpolation: str) -> Column:
    """Array entry at a fractional place, ends held constant."""
    held = F.when(place.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(float(size - 1)), place)))
    if interpolation == "nearest":
        return F.element_at(values, (F.rint(held) + 1).cast("int"))
    if interpolation != "linear":
        raise ValueError(f"unknown interpolation {interpolation!r}")
    low = F.floor(held)
    a = F.element_at(values, (low + 1).cast("int"))
    b = F.element_at(values, (F.ceil(held) + 1).cast("int"))
    return a + (held - low) * (b - a)


def middles(nodes: Column) -> Column:
    """Twice the mid-points between neighbouring nodes."""
    rest = F.size(nodes) - 1
    return F.zip_with(F.slice(nodes, 1, rest), F.slice(nodes, 2, rest), lambda a, b: a + b)


def nearest_factor(middle: Column, factors: Column, value: Column) -> Column:
    """Factor of the node nearest to ``value``: one place further per mid-point below it."""
    below = F.size(F.filter(middle, lambda m: m < value * F.lit(2.0)))
    return F.when(value.isNotNull() & middle.isNotNull(), F.element_at(factors, below + 1))


def group_trend(df: DataFrame, value: str, keys: list[str], half_width: int) -> DataFrame:
    """Add ``trend``: per group, a straight line in time through the windowed means.

    ``keys`` start with the cell, so all windows share one placement by cell.
    """
    near = Window.partitionBy(keys[0]).orderBy("ord").rangeBetween(-half_width, half_width)
    group = Window.partitionBy(*keys)
    smooth = df.withColumn("smooth", F.avg(value).over(near))
    line = smooth.withColumns({
        "slope": F.regr_slope("smooth", F.col("ord").cast("double")).over(group),
        "level": F.avg("smooth").over(group),
        "center": F.avg(F.when(F.col("smooth").isNotNull(), F.col("ord"))).over(group)})
    trend = F.col("level") + F.coalesce("slope", F.lit(0.0)) * (F.col("ord") - F.col("center"))
    return line.withColumn("trend", trend).drop("smooth", "slope", "level", "center")


def apply_dqm(
    simulation: DataFrame, fit: DataFrame, value: str, kind: str, group: str = "dayofyear", window: int = 31,
) -> DataFrame:
    """Detrended mapping: scale the mean, take out the trend, map the rest, put the trend back."""
    fit = fit.withColumn("middle", middles(F.col("hist_q"))).drop("hist_q")
    sim = simulation.withColumn("g", _group_column(group)).join(fit, ["cell", "g"], "left")
    sim = sim.withColumn("scaled", _combine(F.col(value), F.col("scaling"), kind))
    sim = group_trend(sim, "scaled", ["cell", "g"], window // 2)
    rest = _correction(F.col("scaled"), F.col("trend"), kind)
    sim = sim.withColumn("rest", rest)
    factor = nearest_factor(F.col("middle"), F.col("af"), F.col("rest"))
    mapped = _combine(F.col("rest"), factor, kind)
    return sim.withColumn("adjusted", _combine(mapped, F.col("trend"), kind)).drop(
        "g", "scaling", "af", "middle", "scaled", "trend", "rest")


def fit_key(configuration: dict) -> str:
    """Fingerprint of everything a fit depends on (settings and snapshot names, not values)."""
    return hashlib.sha256(json.dumps(configuration, sort_keys=True).encode()).hexdigest()


def cached_fit(spark: SparkSession, path: str, key: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """Read the stored fit when its fingerprint matches; else train, replace and read it back."""
    try:
        stored = spark.read.parquet(f"{path}/manifest").select("fit_key").take(1)
        if stored and stored[0]["fit_key"] == key:
            return spark.read.parquet(f"{path}/fit-{key}"), True
    except Exception as error:  # a missing manifest is a cache miss; anything else is not
        if "PATH_NOT_FOUND" not in str(error):
            raise
    # The data is complete before the manifest names it, so a lost job leaves no valid key.
    build().write.mode("overwrite").parquet(f"{path}/fit-{key}")
    spark.createDataFrame([(key,)], "fit_key string").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/fit-{key}"), False


def adjust(
    reference: DataFrame, historical: DataFrame, simulation: DataFrame, value: str,
    method: str = "qdm", kind: str = "additive", group: str | None = None, window: int = 31,
    quantiles: int = 50, interpolation: str = "nearest", adapt_threshold: float | None = None,
    cache: tuple[str, str] | None = None,
) -> DataFrame:
    """Train and apply; the result is the simulation with an ``adjusted`` column."""
    group = group or ("dayofyear" if method == "dqm" else "month")
    width = window if group == "dayofyear" else 1

    def build() -> DataFrame:
        return train(reference, historical, value, method, kind, group, width, quantiles, adapt_threshold)

    fit = cached_fit(simulation.sparkSession, cache[0], cache[1], build)[0] if cache else build()
    if method == "scaling":
        return apply_scaling(simulation, fit, value, kind, group)
    if method == "dqm":
        return apply_dqm(simulation, fit, value, kind, group, width)
    return apply_qdm(simulation, fit, value, kind, group, quantiles, interpolation)


def adjust_variable(
    reference: DataFrame, historical: DataFrame, simulation: DataFrame, value: str, variable: str,
    quantiles: int = 50, seed: int = 0, cache: tuple[str, str] | None = None, unit: str | None = None,
) -> DataFrame:
    """Adjust one variable with its own method, transform, bounds and dry-day rule.

    ``unit`` is the unit of all three inputs, by default the one the variable is
    stored in; bounds and thresholds are converted to it.  ``rsds`` additionally
    needs the ``lat`` column in every input.
    """
    preset: VariableSettings = settings(variable).in_unit(unit)
    if preset.method == "bounded_qdm":
        from .humidity import adjust_humidity

        return adjust_humidity(reference, historical, simulation, value, preset.window, quantiles, seed)
    bounds = preset.adjust_bounds

    def forward(df: DataFrame) -> DataFrame:
        v = F.col(value)
        if preset.transform == "clearness_index":
            df = ph.with_top_radiation(df)
            v = ph.clearness_index(v, F.col("toa"))
        df = df.withColumn("boundary_source", v)
        if preset.transform:
            v = ph.to_logit(F.col("boundary_source"), bounds)
        return df.withColumn("work", v)

    result = adjust(
        forward(reference), forward(historical), forward(simulation), "work", preset.method, preset.kind,
        "dayofyear", preset.window, quantiles, adapt_threshold=preset.adapt_threshold, cache=cache)
    v = F.col("adjusted")
    if preset.transform:
        v = ph.from_logit(v, bounds)
    v = ph.threshold_to_bound(v, bounds)
    if preset.transform:
        v = ph.restore_boundary(v, F.col("boundary_source"), bounds)
    if preset.transform == "clearness_index":
        v = v * F.col("toa")
    return result.withColumn("adjusted", v).drop("work", "boundary_source", "toa")
