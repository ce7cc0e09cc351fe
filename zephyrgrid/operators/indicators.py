"""Annual climate and fire-season indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import windows
from .masks import fill_inside

DEGREE_DAY_BASE_C = (65.0 - 32.0) * 5.0 / 9.0
WET_DAY_MM = 1.0


def season_thresholds(df: DataFrame, value: str, mask: DataFrame | None = None) -> DataFrame:
    """Local 95th percentile and mid-range of the reference days; 0 where supported but inactive."""
    limits = df.groupBy("cell").agg(
        F.percentile(F.col(value), 0.95).alias("q95"),
        ((F.min(value) + F.max(value)) / 2).alias("midrange"),
    )
    if mask is None:
        return limits
    joined = mask.select("cell", "support").join(limits, "cell", "left")
    return joined.withColumns(
        {n: fill_inside(F.col(n), F.col("support")) for n in ("q95", "midrange")}
    )


def annual_season_indicators(
    df: DataFrame, value: str, thresholds: DataFrame, keys: tuple[str, ...] = ("cell",)
) -> DataFrame:
    """Per cell and year: maximum, days above both thresholds, highest 90-day mean.

    Historical and future series stay apart by naming the series in ``keys``.
    One shuffle on the keys serves the window and the aggregate; thresholds hold
    one row per cell.
    """
    keys = list(keys)
    season = windows.rolling_season_mean(F.col(value), keys)
    daily = df.select(*keys, "year", "ord", value).withColumn("season", season)
    joined = daily.join(thresholds.select("cell", "q95", "midrange"), "cell", "left")
    v = F.col(value)
    any_valid = F.count(v) > 0
    annual = joined.groupBy(*keys, "year").agg(
        F.max(v).alias("fwixx"),
        F.when(any_valid, F.count_if(v > F.col("q95"))).alias("fwixd"),
        F.when(any_valid, F.count_if(v > F.col("midrange"))).alias("fwils"),
        F.when(any_valid, F.max("season")).alias("fwisa"),
    )
    return annual


def annual_climate_indices(df: DataFrame, tas: str = "tas", pr: str = "pr") -> DataFrame:
    """Mean temperature, wet-day total, wettest day, longest dry spell, degree days.

    ``tas`` in K and ``pr`` in mm/day; only cells with some valid value of both.
    """
    c = F.col(tas) - F.lit(273.15)
    p = F.col(pr)
    order = Window.partitionBy("cell", "year").orderBy("ord")
    dry = p < WET_DAY_MM
    daily = df.select("cell", "year", "ord", tas, pr)
    # A dry spell's days share (ord - number of dry days so far).
    spell = F.when(dry, F.col("ord") - F.sum(dry.cast("int")).over(order))
    daily = daily.withColumn("spell", spell)
    in_spell = Window.partitionBy("cell", "year", "spell")
    daily = daily.withColumn("run", F.when(F.col("spell").isNotNull(), F.count(F.lit(1)).over(in_spell)))
    annual = daily.groupBy("cell", "year").agg(
        F.avg(c).alias("tg_mean"),
        F.sum(F.when(p >= WET_DAY_MM, p).when(p.isNotNull(), F.lit(0.0))).alias("prcptot"),
        F.max(p).alias("rx1day"),
        F.coalesce(F.max("run"), F.lit(0)).alias("cdd"),
        F.sum(F.greatest(F.lit(0.0), c - F.lit(DEGREE_DAY_BASE_C))).alias("cdd65"),
        F.sum(F.greatest(F.lit(0.0), F.lit(DEGREE_DAY_BASE_C) - c)).alias("hdd65"),
        F.count(c).alias("nt"), F.count(p).alias("np"),
    )
    cell = Window.partitionBy("cell")
    has_both = (F.sum("nt").over(cell) > 0) & (F.sum("np").over(cell) > 0)
    return annual.withColumn("has_both", has_both).where("has_both").drop("has_both", "nt", "np")


def mean_annual_maximum(df: DataFrame, value: str, keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    yearly = df.groupBy(*keys, "year").agg(F.max(value).alias("peak"))
    return yearly.groupBy(*keys).agg(F.avg("peak").alias("mean_peak"), F.count("peak").alias("years"))


Years = tuple[int | None, int | None]


def period_change(df: DataFrame, value: str, reference: Years, future: Years) -> DataFrame:
    """Per-cell means of two periods, their difference, and lost or gained cells; None leaves an end open."""
    def mean(limits):
        low, high = limits
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("year") >= low)
        if high is not None:
            inside = inside & (F.col("year") <= high)
        return F.avg(F.when(inside, F.col(value)))

    means = df.groupBy("cell").agg(mean(reference).alias("before"), mean(future).alias("after"))
    return means.select(
        "cell", "before", "after", (F.col("after") - F.col("before")).alias("change"),
        (F.col("before").isNotNull() & F.col("after").isNull()).alias("lost"),
        (F.col("before").isNull() & F.col("after").isNotNull()).alias("gained"),
    )
