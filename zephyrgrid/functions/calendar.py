"""Calendar arithmetic on integer keys.

The production calendar has 365 days in every year.  Spark DATE is Gregorian,
so adjacency is never computed on DATE; every day carries ``doy`` (1..365) and
``ord``, the count of 365-day-calendar days since 1970-01-01.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Days before each month, and month lengths, of a 365-day year.
DAYS_BEFORE_MONTH = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)
YEAR_LENGTH = {"noleap": 365, "360_day": 360}


def _literal_array(values) -> Column:
    return F.array(*[F.lit(value) for value in values])


def noleap_doy(month: Column, day: Column) -> Column:
    before = F.element_at(_literal_array(DAYS_BEFORE_MONTH), month.cast("int"))
    return (before + day).cast("bigint")


def noleap_ord(year: Column, doy: Column) -> Column:
    return ((year - 1970) * 365 + doy - 1).cast("bigint")


def year_of_ord(ord_: Column) -> Column:
    return (F.floor(ord_ / F.lit(365)) + 1970).cast("bigint")


def doy_of_ord(ord_: Column) -> Column:
    return (F.pmod(ord_, F.lit(365)) + 1).cast("bigint")


def month_of_doy(doy: Column) -> Column:
    later = F.filter(_literal_array(DAYS_BEFORE_MONTH), lambda before: before < doy)
    return F.size(later).cast("bigint")


def is_leap_day(month: Column, day: Column) -> Column:
    return (month == 2) & (day == 29)


def drop_leap_days(df: DataFrame) -> DataFrame:
    return df.where(~is_leap_day(F.col("month"), F.col("day")))


def with_noleap_keys(df: DataFrame) -> DataFrame:
    """Add ``doy`` and ``ord`` from ``year, month, day``; leap days must be gone."""
    doy = noleap_doy(F.col("month"), F.col("day"))
    return df.withColumn("doy", doy).withColumn(
        "ord", noleap_ord(F.col("year"), F.col("doy"))
    )


def circular_distance(a: Column, b: Column, period: int | None) -> Column:
    gap = F.abs(a - b)
    return gap if period is None else F.least(gap, F.lit(period) - gap)


def move_leap_accumulation(df: DataFrame, value: str, key: str = "cell") -> DataFrame:
    """Add the 29 February amount to 28 February of the same cell, then drop the 29th.

    ``lead`` looks one row ahead, which is the next calendar day only when the
    series has it, so the next row's own month and day are checked too.
    """
    order = Window.partitionBy(key).orderBy("year", "month", "day")
    next_is_leap = (
        (F.lead("month").over(order) == 2)
        & (F.lead("day").over(order) == 29)
        & (F.col("month") == 2)
        & (F.col("day") == 28)
        & (F.lead("year").over(order) == F.col("year"))
    )
    moved = F.when(next_is_leap, F.col(value) + F.lead(value).over(order)).otherwise(
        F.col(value)
    )
    return drop_leap_days(df.withColumn(value, moved))


def day360_to_noleap(doy360: Column) -> Column:
    """Position of a 360-day-calendar day in a 365-day year (half to even)."""
    return F.rint(F.lit(365) * doy360 / F.lit(360)).cast("bigint")


def expand_360_day(
    df: DataFrame, value: str, key: str = "cell", preserve_total: bool = False
) -> DataFrame:
    """Re-date a 360-day series ``(key, year, doy360, value)`` onto 365-day years.

    The days without a source are filled with the mean of their neighbours;
    a source day that is itself missing stays missing.  With ``preserve_total``
    every year is rescaled to its source total (accumulated quantities).
    Shuffles once: everything after the first window reuses partitioning by key.
    """
    mapped = df.select(
        key, "year", day360_to_noleap(F.col("doy360")).alias("doy"), value,
        F.lit(True).alias("has_source"),
    )
    axis = df.select(key, "year").distinct().withColumn(
        "doy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(365).cast("bigint")))
    )
    dense = axis.join(mapped, [key, "year", "doy"], "left")
    order = Window.partitionBy(key).orderBy("year", "doy")
    neighbours = (F.lag(value).over(order) + F.lead(value).over(order)) / 2
    filled = dense.withColumn(
        "filled", F.when(F.col("has_source"), F.col(value)).otherwise(neighbours)
    )
    if not preserve_total:
        return filled.select(key, "year", "doy", F.col("filled").alias(value))
    annual = Window.partitionBy(key, "year")
    # skipna=False: one missing day makes the annual total, and so the year, missing.
    source_total = F.when(
        F.count(F.when(F.col("has_source") & F.col(value).isNull(), 1)).over(annual) == 0,
        F.sum(F.when(F.col("has_source"), F.col(value))).over(annual),
    )
    target_total = F.when(
        F.count(F.when(F.col("filled").isNull(), 1)).over(annual) == 0,
        F.sum("filled").over(annual),
    )
    ratio = F.when(target_total == 0, F.lit(1.0)).otherwise(source_total / target_total)
    return filled.select(key, "year", "doy", (F.col("filled") * ratio).alias(value))
