"""Scaled 16-bit storage: packing, checks, repacking, merging and appending segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scalar_row

FILL = -32768
CODE_LIMIT = 32767


# Fixed values: (lowest, highest, step) of each published variable; the offset is the middle.
RANGES = {
    "hurs": (0, 100, 0.002), "pr": (0, 0.04, 1e-6), "prsn": (0, 0.04, 1e-6), "prsnratio": (0, 1, 2e-5),
    "ps": (0, 120000, 2.0), "rlds": (0, 1000, 0.02), "rsds": (0, 1500, 0.025), "sfcWind": (0, 100, 0.002),
    "tas": (130, 377, 0.005), "tasmin": (130, 377, 0.005), "tasmax": (130, 377, 0.005), "tasrange": (0, 100, 0.002),
    "tasskew": (0, 1, 2e-5), "huss": (0, 0.1, 2e-6), "ffmc": (0, 101, 0.002), "fwi": (0, 2000, 0.04),
    "fwixx": (0, 2000, 0.04), "fwisa": (0, 2000, 0.04), "q95": (0, 2000, 0.04), "midrange": (0, 2000, 0.04),
}
# Fixed values: (step, offset) where the range follows from the 16-bit codes instead.
STEPS = {
    "dmc": (4.0, 131068.0), "dc": (8.0, 262136.0), "isi": (0.5, 16383.5), "bui": (2.0, 65534.0),
    "fwixd": (1.0, 0.0), "fwils": (1.0, 0.0), "tg_mean": (0.01, 0.0), "prcptot": (1.0, 32767.0),
    "rx1day": (0.1, 3276.7), "cdd": (1.0, 0.0), "cdd65": (0.3, 9830.1), "hdd65": (0.3, 9830.1),
}


def specification(variable: str) -> tuple[float, float]:
    """(scale, offset) of a published variable."""
    if variable in STEPS:
        return STEPS[variable]
    if variable not in RANGES:
        raise ValueError(f"no packing for {variable!r}")
    low, high, step = RANGES[variable]
    return step, (low + high) / 2.0


def pack_columns(df: DataFrame, *names: str) -> DataFrame:
    """Replace each named variable by its 16-bit code."""
    return df.withColumns({n: pack(F.col(n).cast("double"), *specification(n), n) for n in names})


def pack(value: Column, scale: float, offset: float, label: str = "value") -> Column:
    """SMALLINT code; missing is -32768; infinite or out-of-range values stop the job."""
    code = F.rint((value - F.lit(offset)) / F.lit(scale))
    problem = F.when(F.abs(value) == F.lit(float("inf")), F.lit(f"{label} is infinite")).otherwise(
        F.concat(F.lit(f"{label} does not fit the packing range: "), value.cast("string")))
    # Most values pass the first test, and it is all they meet; NaN and NULL fail it.
    return F.when(F.abs(code) <= CODE_LIMIT, code.cast("smallint")).when(
        value.isNull() | F.isnan(value), F.lit(FILL).cast("smallint")).otherwise(F.raise_error(problem).cast("smallint"))


def unpack(code: Column, scale: float, offset: float) -> Column:
    return F.when(code != FILL, code.cast("double") * F.lit(scale) + F.lit(offset))


def repack(code: Column, old: tuple[float, float], new: tuple[float, float]) -> Column:
    return pack(unpack(code, *old), *new, label="repacked value")


def packing_report(df: DataFrame, value: str, scale: float, offset: float) -> DataFrame:
    """One pass: extrema, missing and infinite values, worst round-trip error, saturation.

    Half a step beyond the last code still rounds onto it.
    """
    v = F.col(value)
    finite = v.isNotNull() & (F.abs(v) < F.lit(float("inf")))
    code = F.rint((v - F.lit(offset)) / F.lit(scale))
    low, high = offset - CODE_LIMIT * scale, offset + CODE_LIMIT * scale
    error = F.abs(code * F.lit(scale) + F.lit(offset) - v)
    return df.agg(
        F.count_if(finite).alias("valid"), F.count_if(~finite | v.isNull()).alias("missing"),
        F.min(F.when(finite, v)).alias("minimum"), F.max(F.when(finite, v)).alias("maximum"),
        F.max(F.when(finite, error)).alias("maximum_error"),
        F.count_if(finite & ((v < low - scale / 2) | (v > high + scale / 2))).alias("saturated"),
        F.count_if(F.abs(v) == F.lit(float("inf"))).alias("infinite"),
    ).withColumn("valid_packing", (F.col("saturated") == 0) & (F.col("infinite") == 0))


def merge_segments(segments: list[DataFrame], packings: list[tuple[float, float]], keys: list[str]) -> DataFrame:
    """Stack consecutive packed segments; packing must match and days must join without a gap."""
    if len(set(packings)) != 1:
        raise ValueError("segments use different packing")
    tagged = [s.withColumn("segment", F.lit(i)) for i, s in enumerate(segments)]
    merged = reduce(DataFrame.unionByName, tagged)
    bad = scalar_row(segment_boundaries(merged, keys).agg(F.count_if(~F.col("daily")).alias("n")))["n"]
    if bad:
        raise ValueError(f"{bad} segment boundaries are not one day apart")
    return merged


def segment_boundaries(merged: DataFrame, keys: list[str]) -> DataFrame:
    """For each series and segment but the first: does it start the day after the previous ends?"""
    spans = merged.groupBy(*keys, "segment").agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    order = Window.partitionBy(*keys).orderBy("segment")
    return spans.withColumn("previous", F.lag("last").over(order)).where("previous IS NOT NULL").withColumn(
        "daily", F.col("first") - F.col("previous") == 1)


def append_new_rows(existing: DataFrame, segment: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a segment that the store does not hold yet; running it twice adds nothing."""
    return segment.join(existing.select(*keys), keys, "left_anti")
