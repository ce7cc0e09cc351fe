"""Ordered per-cell operators: rolling means, runs, trends, differences, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_season_mean(
    value: Column, keys: list[str], before: int = 45, after: int = 44, order: str = "ord"
) -> Column:
    """Mean over rows [-before, +after] with missing as 0; NULL unless the window is full."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(-before, after)
    full = F.count(F.lit(1)).over(frame) == before + after + 1
    return F.when(full, F.sum(F.coalesce(value, F.lit(0.0))).over(frame) / (before + after + 1))


def gap_aware_mean(
    df: DataFrame, keys: list[str], year: str, value: str, width: int = 5, minimum: int = 3
) -> DataFrame:
    """Centred mean over years that restarts where the year axis has a gap."""
    order = Window.partitionBy(*keys).orderBy(year)
    starts = F.coalesce((F.col(year) - F.lag(year).over(order) > 1).cast("int"), F.lit(0))
    islands = df.withColumn("starts", starts).withColumn("island", F.sum("starts").over(order))
    half = width // 2
    frame = Window.partitionBy(*keys, "island").orderBy(year).rowsBetween(-half, half)
    mean = F.when(F.count(value).over(frame) >= minimum, F.avg(value).over(frame))
    return islands.withColumn("smooth", mean).drop("starts", "island")


def adjacent_change(df: DataFrame, key: str, value: str, order: str = "ord") -> DataFrame:
    """Difference to the previous row, only where that row is the previous day."""
    window = Window.partitionBy(key).orderBy(order)
    follows = F.col(order) - F.lag(order).over(window) == 1
    return df.withColumn("change", F.when(follows, F.col(value) - F.lag(value).over(window)))


def longest_run(df: DataFrame, keys: list[str], condition: Column, order: str = "ord") -> DataFrame:
    """Longest stretch of consecutive days that meet ``condition``, 0 when there is none.

    Days of one stretch share (day number - hits so far); one shuffle on the keys.
    """
    window = Window.partitionBy(*keys).orderBy(order)
    hit = F.coalesce(condition, F.lit(False)).cast("int")
    marked = df.select(*keys, order, hit.alias("hit"))
    run = F.when(F.col("hit") == 1, F.col(order) - F.sum("hit").over(window))
    lengths = marked.withColumn("run", run).groupBy(*keys, "run").agg(F.sum("hit").alias("length"))
    return lengths.groupBy(*keys).agg(F.max("length").alias("longest"))


def trend_per_decade(value: Column, year: Column) -> Column:
    pairs = F.count(F.when(value.isNotNull() & year.isNotNull(), 1))
    return F.when(pairs >= 2, F.regr_slope(value, year.cast("double")) * 10)


def year_axis(df: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Every year between a series' first and last, with NULL where it had none."""
    span = df.groupBy(*keys).agg(F.min(year).alias("a"), F.max(year).alias("b"))
    axis = span.select(*keys, F.explode(F.sequence("a", "b")).alias(year))
    return axis.join(df, [*keys, year], "left")


def first_day_of_year(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, "year").agg(
        F.min("ord").alias("first_ord"), F.min_by(F.struct("month", "day"), "ord").alias("first")
    ).select(*keys, "year", "first_ord", "first.month", "first.day")
