"""Masks, support footprints, value controls and coordinate selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics as ph
from ..functions import units
from ..functions.presets import (
    PRECIPITATION_CEILING_MM_DAY,
    STATIC_FLOOR_K,
    TEMPERATURE_VALID_RANGE_K,
    WIND_CEILING_M_S,
)


def static_floor_cells(df: DataFrame, value: str, key: str = "cell") -> DataFrame:
    """Cells whose value equals the temperature floor on every day (a gap is not equal)."""
    held = F.coalesce(F.col(value) == F.lit(STATIC_FLOOR_K), F.lit(False))
    return df.groupBy(key).agg(F.bool_and(held).alias("frozen"))


def mask_static_floor(df: DataFrame, value: str, key: str = "cell") -> DataFrame:
    held = F.coalesce(F.col(value) == F.lit(STATIC_FLOOR_K), F.lit(False))
    frozen = F.bool_and(held).over(Window.partitionBy(key))
    return df.withColumn(value, F.when(~frozen, F.col(value)))


def value_controls(
    df: DataFrame,
    key: str = "cell",
    precipitation: str = "pr",
    precipitation_unit: str = "kg m-2 s-1",
    wind: str = "wind",
) -> DataFrame:
    """Apply the finished-field controls to whichever variables ``df`` holds."""
    have = set(df.columns)
    ceiling = PRECIPITATION_CEILING_MM_DAY
    if precipitation_unit not in ("mm d-1", "mm/day"):
        ceiling = units.quantity(f"{ceiling} mm d-1", precipitation_unit)
    limits = {
        precipitation: (0.0, ceiling), wind: (0.0, WIND_CEILING_M_S), "hurs": (0.0, 100.0),
        "tasrange": (0.0, None), "tasskew": (0.0, 1.0), "prsnratio": (0.0, 1.0),
    }
    changes = {
        name: ph.clip(F.col(name), low, high)
        for name, (low, high) in limits.items() if name in have
    }
    low, high = TEMPERATURE_VALID_RANGE_K
    for name in ("tas", "tasmin", "tasmax"):
        if name in have:
            changes[name] = F.when(F.col(name).between(low, high), F.col(name))
    df = df.withColumns(changes)
    return mask_static_floor(df, "tas", key) if "tas" in have else df


def standardize_longitude(df: DataFrame, lon: str, row: str) -> DataFrame:
    """Longitudes on 0..360 and -180..180, and their position along the axis of a row."""
    turned = df.withColumn("lon360", ph.normalized_longitude(F.col(lon))).withColumn(
        "signed", ph.signed_longitude(F.col(lon))
    )
    order = Window.partitionBy(row).orderBy("lon360")
    return turned.withColumn("position", F.row_number().over(order) - 1)


def period_region(
    df: DataFrame,
    first_year: int | None = None,
    last_year: int | None = None,
    rows: tuple[int, int] | None = None,
    columns: tuple[int, int] | None = None,
) -> DataFrame:
    """Inclusive years and half-open index ranges, as plain predicates for the scan."""
    if first_year is not None:
        df = df.where(F.col("year") >= first_year)
    if last_year is not None:
        df = df.where(F.col("year") <= last_year)
    for name, limits in (("fi", rows), ("fj", columns)):
        if limits is not None:
            df = df.where((F.col(name) >= limits[0]) & (F.col(name) < limits[1]))
    return df


def complete_support(df: DataFrame, days: int, *values: str, key: str = "cell") -> DataFrame:
    """Per cell: is every listed variable present on each of the ``days`` days, and how many days does the worst one lack?"""
    present = [F.count(F.col(v)) for v in values]
    complete = reduce(lambda a, b: a & b, [n == F.lit(days) for n in present])
    lacking = F.lit(days) - (F.least(*present) if len(present) > 1 else present[0])
    return df.groupBy(key).agg(complete.alias("support"), lacking.alias("missing_days"))


def combined_support(
    fine: DataFrame, coarse: DataFrame, parent: Column | str = "coarse"
) -> DataFrame:
    """Fine support AND the support of the parent coarse cell."""
    parents = coarse.select(F.col("coarse"), F.col("support").alias("parent_support"))
    joined = fine.join(parents, "coarse", "left")
    return joined.withColumn(
        "support", F.col("support") & F.coalesce("parent_support", F.lit(False))
    ).drop("parent_support")


def apply_support(df: DataFrame, mask: DataFrame, *values: str, key: str = "cell") -> DataFrame:
    """Keep values inside the mask only; infinite values stop the job."""
    joined = df.join(mask.select(key, "support"), key, "left")
    def keep(name: str) -> Column:
        value = F.col(name)
        infinite = F.abs(value) == F.lit(float("inf"))
        checked = F.when(
            infinite, F.raise_error(F.lit(f"{name} contains infinite values")).cast("double")
        ).otherwise(value)
        return F.when(F.col("support"), checked)
    return joined.withColumns({name: keep(name) for name in values})


def fill_inside(value: Column, inside: Column, fill: float = 0.0) -> Column:
    """Missing inside the mask becomes ``fill``; outside stays missing."""
    return F.when(inside & value.isNull(), F.lit(fill)).otherwise(value)


def coverage_counts(df: DataFrame, value: str, support: str, land: str) -> DataFrame:
    valid = F.col(value).isNotNull()
    return df.agg(
        F.count_if(F.col(support) & ~valid).alias("supported_missing"),
        F.count_if(~F.col(support) & valid).alias("valid_outside"),
        F.count_if(F.col(land) & ~F.col(support)).alias("land_missing"),
        F.count_if(F.col(support)).alias("supported"),
    )


def coastal_plan(cells: DataFrame, side: int, valid: str = "valid", land: str = "land") -> DataFrame:
    """One-cell gaps touching valid cells on mapped land, and the donor of each.

    Neighbours come from an equi-join on exploded offsets (longitude wraps,
    latitude does not); the donor is the first valid neighbour in a fixed order.
    """
    # Donor order as (row step, column step), cardinal before diagonal.
    order = ((-1, 0), (1, 0), (0, -1), (0, 1), (-1, -1), (-1, 1), (1, -1), (1, 1))
    steps = F.array(*[
        F.struct(F.lit(r).alias("rank"), F.lit(di).alias("di"), F.lit(dj).alias("dj"))
        for r, (di, dj) in enumerate(order)
    ])
    gaps = cells.where(~F.col(valid) & F.col(land)).select("cell", "fi", "fj", F.explode(steps).alias("s"))
    wanted = gaps.select(
        "cell", "s.rank",
        (F.col("fi") + F.col("s.di")).alias("ni"),
        F.pmod(F.col("fj") + F.col("s.dj"), F.lit(side)).alias("nj"),
    )
    donors = cells.where(F.col(valid)).select(
        F.col("cell").alias("donor"), F.col("fi").alias("ni"), F.col("fj").alias("nj")
    )
    return wanted.join(donors, ["ni", "nj"]).groupBy("cell").agg(
        F.min_by("donor", "rank").alias("donor")
    )


def fill_from_donor(df: DataFrame, plan: DataFrame, *values: str) -> DataFrame:
    """Append the donor's whole series for every planned cell."""
    carried = df.join(plan.select(F.col("cell").alias("target"), F.col("donor").alias("cell")), "cell")
    keep = [c for c in df.columns if c != "cell"]
    copied = carried.select(F.col("target").alias("cell"), *keep)
    native = df.join(plan.select("cell"), "cell", "left_anti")
    return native.withColumn("filled", F.lit(False)).unionByName(copied.withColumn("filled", F.lit(True)))


def compose_reference(df: DataFrame, native: str, donor: str, external: str, land: str) -> DataFrame:
    """Native value (source 1), else coastal donor (2), else external on land (3), else none (0)."""
    on_land = F.when(F.col(land), F.col(external))
    code = (
        F.when(F.col(native).isNotNull(), 1)
        .when(F.col(donor).isNotNull(), 2)
        .when(on_land.isNotNull(), 3)
        .otherwise(0)
    )
    return df.withColumn("value", F.coalesce(F.col(native), F.col(donor), on_land)).withColumn(
        "source", code
    )
