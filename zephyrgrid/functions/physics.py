"""Scalar physics, bounds and geometry as built-in column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .presets import Bounds

EARTH_RADIUS_KM = 6371.0088
SOLAR_CONSTANT = 1361.0


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Clip that keeps NULL (``least``/``greatest`` skip NULL, so they are guarded)."""
    result = value
    if low is not None:
        result = F.when(result < F.lit(low), F.lit(low)).otherwise(result)
    if high is not None:
        result = F.when(result > F.lit(high), F.lit(high)).otherwise(result)
    return result


def threshold_to_bound(value: Column, bounds: Bounds) -> Column:
    """Values past a threshold become the bound; NULL becomes the bound too."""
    result = value
    if bounds.lower is not None:
        limit = bounds.lower if bounds.lower_threshold is None else bounds.lower_threshold
        result = F.when(result >= F.lit(limit), result).otherwise(F.lit(bounds.lower))
        result = clip(result, bounds.lower, None)
    if bounds.upper is not None:
        limit = bounds.upper if bounds.upper_threshold is None else bounds.upper_threshold
        result = F.when(result <= F.lit(limit), result).otherwise(F.lit(bounds.upper))
        result = clip(result, None, bounds.upper)
    return result


def restore_boundary(result: Column, source: Column, bounds: Bounds) -> Column:
    """Put the bound wherever the source was at or past its threshold (or missing)."""
    if bounds.lower is not None:
        limit = bounds.lower if bounds.lower_threshold is None else bounds.lower_threshold
        result = F.when(source > F.lit(limit), result).otherwise(F.lit(bounds.lower))
    if bounds.upper is not None:
        limit = bounds.upper if bounds.upper_threshold is None else bounds.upper_threshold
        result = F.when(source < F.lit(limit), result).otherwise(F.lit(bounds.upper))
    return result


def to_logit(value: Column, bounds: Bounds) -> Column:
    inside = clip(value, bounds.lower_threshold, bounds.upper_threshold)
    return F.ln((inside - F.lit(bounds.lower)) / (F.lit(bounds.upper) - inside))


def from_logit(value: Column, bounds: Bounds) -> Column:
    span = bounds.upper - bounds.lower
    return F.lit(bounds.lower) + F.lit(span) / (F.lit(1.0) + F.exp(-value))


def with_top_radiation(df: DataFrame, name: str = "toa", lat: str = "lat", doy: str = "doy") -> DataFrame:
    """Add the daily mean top-of-atmosphere radiation, W m-2 (Spencer 1971 series).

    Built in named steps: each step is read several times by the next, and
    Catalyst keeps such steps apart instead of copying the formula.
    """
    angle = F.col("_angle")
    df = df.withColumn("_angle", F.lit(2.0 * math.pi) * (F.col(doy) - F.lit(1)) / F.lit(365.0))
    df = df.withColumns({
        "_phi": F.radians(F.col(lat)),
        "_dec": (
            F.lit(0.006918) - F.lit(0.399912) * F.cos(angle) + F.lit(0.070257) * F.sin(angle)
            - F.lit(0.006758) * F.cos(angle * 2) + F.lit(0.000907) * F.sin(angle * 2)
            - F.lit(0.002697) * F.cos(angle * 3) + F.lit(0.00148) * F.sin(angle * 3)),
        "_dist": (
            F.lit(1.00011) + F.lit(0.034221) * F.cos(angle) + F.lit(0.00128) * F.sin(angle)
            + F.lit(0.000719) * F.cos(angle * 2) + F.lit(0.000077) * F.sin(angle * 2)),
    })
    phi, dec = F.col("_phi"), F.col("_dec")
    df = df.withColumn("_hour", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -F.tan(phi) * F.tan(dec)))))
    hour = F.col("_hour")
    geometry = hour * F.sin(phi) * F.sin(dec) + F.cos(phi) * F.cos(dec) * F.sin(hour)
    return df.withColumn(name, F.lit(SOLAR_CONSTANT / math.pi) * F.col("_dist") * geometry).drop(
        "_angle", "_phi", "_dec", "_dist", "_hour")


def clearness_index(rsds: Column, toa: Column) -> Column:
    """Share of the top-of-atmosphere radiation; 0 where the sun does not rise."""
    return F.when(toa <= 0, F.when(rsds.isNotNull(), F.lit(0.0))).otherwise(rsds / toa)


def magnus_relative_humidity(temperature_c: Column, dewpoint_c: Column) -> Column:
    """Magnus relative humidity in percent, limited to 0..100."""
    def exponent(t: Column) -> Column:
        return F.lit(17.625) * t / (F.lit(243.04) + t)

    return clip(F.lit(100.0) * F.exp(exponent(dewpoint_c) - exponent(temperature_c)), 0.0, 100.0)


def saturation_vapour_pressure(tas: Column) -> Column:
    """Sonntag (1990) saturation vapour pressure over water, Pa."""
    return F.lit(100.0) * F.exp(
        F.lit(-6096.9385) / tas + F.lit(16.635794) - F.lit(2.711193e-2) * tas
        + F.lit(1.673952e-5) * tas * tas + F.lit(2.433502) * F.ln(tas)
    )


def specific_humidity(tas: Column, hurs: Column, ps: Column) -> Column:
    saturation = saturation_vapour_pressure(tas)
    mixing = hurs / F.lit(100.0) * (F.lit(0.62198) * saturation / (ps - saturation))
    return mixing / (F.lit(1.0) + mixing)


def derive_components(df: DataFrame) -> DataFrame:
    """Add tasmin, tasmax, prsn and huss where their inputs exist; keep given columns."""
    have = set(df.columns)
    derived: dict[str, Column] = {}
    if {"tas", "tasrange", "tasskew"} <= have:
        low = F.col("tas") - F.col("tasskew") * F.col("tasrange")
        derived["tasmin"] = low
        derived["tasmax"] = F.col("tas") + (F.lit(1.0) - F.col("tasskew")) * F.col("tasrange")
    if {"pr", "prsnratio"} <= have:
        derived["prsn"] = F.col("pr") * F.col("prsnratio")
    if {"tas", "hurs", "ps"} <= have:
        derived["huss"] = specific_humidity(F.col("tas"), F.col("hurs"), F.col("ps"))
    return df.withColumns({name: expr for name, expr in derived.items() if name not in have})


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), 2
    )
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def signed_longitude(lon: Column) -> Column:
    return F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def normalized_longitude(lon: Column) -> Column:
    return F.pmod(lon, F.lit(360.0))


def local_noon_utc_offset(lon: Column) -> Column:
    """Whole UTC hours from local midnight's date to local solar noon (half to even)."""
    return F.rint(F.lit(12.0) - signed_longitude(lon) / F.lit(15.0)).cast("bigint")


def nearest_hour_utc(local_noon: Column, lon: Column) -> Column:
    """UTC timestamp of local noon rounded to the nearest hour, ties to the even hour."""
    shift = F.rint(-signed_longitude(lon) * F.lit(240.0)).cast("bigint")
    seconds = F.unix_timestamp(local_noon) + shift
    return F.timestamp_seconds(F.rint(seconds / F.lit(3600.0)).cast("bigint") * F.lit(3600))


def latitude_weight(lat: Column) -> Column:
    return F.cos(F.radians(lat))


def boundary_signal_transfer(
    observed: Column, historical: Column, simulated: Column, low: float, high: float
) -> Column:
    """Carry the simulated change to the observation without leaving [low, high]."""
    lo, hi = F.lit(low), F.lit(high)
    toward_upper = hi - (hi - observed) * (hi - simulated) / F.nullif(hi - historical, F.lit(0.0))
    toward_lower = lo + (observed - lo) * (simulated - lo) / F.nullif(historical - lo, F.lit(0.0))
    additive = observed + simulated - historical
    result = (
        F.when(historical == observed, simulated)
        .when((historical < observed) & (simulated < historical), additive)
        .when(historical < observed, toward_upper)
        .when(simulated > historical, additive)
        .otherwise(toward_lower)
    )
    return clip(result, low, high)


def combined_source_class(codes: list[Column], land: Column) -> Column:
    """One class from several source codes; land without a full set of sources is class 4."""
    every = F.array(*codes)
    complete = F.forall(every, lambda c: c > 0)
    return (
        F.when(land & ~complete, 4)
        .when(~complete, 0)
        .when(F.exists(every, lambda c: c == 3), 3)
        .when(F.exists(every, lambda c: c == 2), 2)
        .otherwise(1)
    )
