"""The stages from raw model output to published products, as DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import physics as ph
from ..functions import units
from ..functions.presets import settings
from ..operators import adjustment, aggregate, downscale, fireweather, indicators, masks, packing, qc, regrid
from ..session import cut_lineage, scalar_row
from ..sources import stores

Grid = tuple[regrid.Axis, regrid.Axis]


def preprocess(
    raw: DataFrame, variable: str, unit: str, calendar: str, source: Grid, target: Grid, value: str = "value"
) -> DataFrame:
    """Standardise one raw variable: unit, limits, grid, 365-day calendar, limits again, float32.

    ``raw`` has (fi, fj, year, month, day, value) on ``source``; the result has
    (cell, fi, fj, year, month, doy, ord, value) on ``target``.
    """
    rules = settings(variable)
    # Collections declare precipitation inconsistently; it is stored per second from here on.
    v = ph.clip(units.convert(F.col(value).cast("double"), unit, rules.unit), *rules.clip)
    v = F.when(~F.isnan(v), v)
    keys = ("year", "month", "day")
    rows = raw.select("fi", "fj", *keys, v.alias("v"))
    method: Callable = regrid.conservative_regrid if rules.regrid == "conservative" else regrid.linear_regrid
    placed = method(rows, source, target, "v", keys).select(
        (F.col("ti") * target[1].size + F.col("tj")).alias("cell"), *keys, "v")
    if calendar == "360_day":
        numbered = placed.select("cell", "year", ((F.col("month") - 1) * 30 + F.col("day")).alias("doy360"), "v")
        dated = cal.expand_360_day(numbered, "v", preserve_total=variable == "pr")
        dated = dated.withColumn("ord", cal.noleap_ord(F.col("year"), F.col("doy")))
    else:
        if calendar != "noleap":
            placed = cal.move_leap_accumulation(placed, "v") if variable == "pr" else cal.drop_leap_days(placed)
        dated = cal.with_noleap_keys(placed)
    columns = target[1].size
    return dated.select(
        "cell", F.expr(f"cell div {columns}").alias("fi"), F.expr(f"cell % {columns}").alias("fj"),
        "year", cal.month_of_doy(F.col("doy")).alias("month"), "doy", "ord",
        ph.clip(F.col("v"), *rules.clip).cast("float").alias(value))


def preprocessing_report(df: DataFrame, target: Grid, value: str = "value") -> DataFrame:
    """One row: whole grid present, every day of every year present once, single precision."""
    cells = target[0].size * target[1].size
    per_cell = df.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ord").alias("u"), F.min("ord").alias("a"), F.max("ord").alias("b"))
    single = dict(df.dtypes)[value] == "float"
    return per_cell.agg(
        (F.count(F.lit(1)) == cells).alias("whole_grid"),
        F.bool_and((F.col("n") == F.col("u")) & (F.col("n") == F.col("b") - F.col("a") + 1)).alias("daily_without_gaps"),
        F.lit(single).alias("single_precision"),
    ).withColumn("valid", F.col("whole_grid") & F.col("daily_without_gaps") & F.col("single_precision"))


def adjust_and_downscale(
    fine_reference: DataFrame, historical: DataFrame, simulation: DataFrame, value: str, variable: str,
    fine: Grid, rows: int, columns: int, factor: int, seed: int = 0, iterations: int = 20,
    cache: tuple[str, str] | None = None, unit: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Adjust the coarse simulation and spread it over the fine grid; returns (adjusted, fine).

    ``unit`` is the unit of every series, by default the one the variable is stored in.

    ``fine_reference`` has (fi, fj, ord, doy, month, value); the model series have
    (ci, cj, ord, doy, month, value).
    """
    rules = settings(variable).in_unit(unit)
    lat = F.lit(fine[0].first) + F.lit(fine[0].step) * F.col("fi")
    coarse = (F.expr(f"fi div {factor}") * columns + F.expr(f"fj div {factor}")).cast("bigint")
    reference = fine_reference.withColumn("lat", lat).withColumn("coarse", coarse)
    keys = ("ord", "doy", "month")
    coarse_reference = aggregate.coarse_mean(reference, value, keys).withColumnRenamed("coarse", "cell")
    coarse_lat = F.lit(fine[0].first + fine[0].step * (factor - 1) / 2) + F.lit(fine[0].step * factor) * F.expr(f"cell div {columns}")

    def by_cell(df: DataFrame) -> DataFrame:
        return df.select((F.col("ci") * columns + F.col("cj")).cast("bigint").alias("cell"), *keys, value).withColumn("lat", coarse_lat)

    sim = by_cell(simulation)
    adjusted = adjustment.adjust_variable(
        coarse_reference.withColumn("lat", coarse_lat), by_cell(historical), sim, value, variable, seed=seed, cache=cache, unit=unit)
    if "month" not in adjusted.columns:
        adjusted = adjusted.join(sim.select("cell", *keys), ["cell", "ord"])
    adjusted = adjusted.select("cell", *keys, F.col("adjusted").alias(value))
    if variable in ("pr", "sfcWind"):
        adjusted = masks.value_controls(
            adjusted, precipitation=value if variable == "pr" else "-", precipitation_unit=rules.unit if variable == "pr" else "kg m-2 s-1",
            wind=value if variable == "sfcWind" else "-")
    placed = adjusted.select(
        F.expr(f"cell div {columns}").alias("ci"), F.expr(f"cell % {columns}").alias("cj"), "ord", "month", value)
    spread = downscale.downscale(
        fine_reference.select("fi", "fj", "ord", "month", value), placed, value, fine[0], rows, columns, factor,
        rules.downscale_bounds, iterations=iterations, seed=seed, all_invalid_value=rules.all_invalid_value)
    width = columns * factor
    return adjusted, spread.select((F.col("fi") * width + F.col("fj")).alias("cell"), "fi", "fj", "ord", value)


def finish_and_check(
    spread: DataFrame, adjusted: DataFrame, support: DataFrame, value: str, variable: str, fine: Grid, factor: int,
    days: int, unit: str | None = None,
) -> tuple[DataFrame, dict]:
    """Value controls, support mask, and the coverage and conservation reports (two small rows)."""
    rules = settings(variable).in_unit(unit)
    renamed = spread.withColumnRenamed(value, variable if variable != "sfcWind" else "wind")
    name = variable if variable != "sfcWind" else "wind"
    controlled = masks.apply_support(masks.value_controls(renamed, precipitation_unit=rules.unit if variable == "pr" else "kg m-2 s-1"), support, name)
    finished = controlled.withColumnRenamed(name, value).drop("support")
    columns = fine[1].size // factor
    lat = F.lit(fine[0].first) + F.lit(fine[0].step) * F.col("fi")
    coarse = (F.expr(f"fi div {factor}") * columns + F.expr(f"fj div {factor}")).cast("bigint")
    back = finished.withColumn("lat", lat).withColumn("coarse", coarse)
    goal = adjusted.select(F.col("cell").alias("coarse"), "ord", value)
    covered = finished.join(support.where("support").select("cell"), "cell", "left_semi")
    return finished, {
        "conservation": scalar_row(aggregate.conservation(back, goal, value, rules.conservation_tolerance)).asDict(),
        "coverage": scalar_row(aggregate.coverage(covered, value, days)).asDict(),
    }


def fire_products(
    weather: DataFrame, support: DataFrame, first_output_year: int, reference_years: tuple[int, int],
    precipitation_unit: str = settings("pr").unit,
) -> tuple[DataFrame, DataFrame]:
    """Daily indices from ``first_output_year`` on (earlier days warm up), and annual indicators.

    Annual windows do not cross from the years before the output into it.
    """
    daily = fireweather.daily_fire_weather(weather, precipitation_unit)
    daily = masks.apply_support(daily, support, "ffmc", "dmc", "dc", "isi", "bui", "fwi")
    daily = daily.withColumn("year", cal.year_of_ord(F.col("ord"))).withColumn(
        "period", F.when(F.col("year") < first_output_year, "history").otherwise("output"))
    limits = indicators.season_thresholds(daily.where(F.col("year").between(*reference_years)), "fwi", support)
    annual = indicators.annual_season_indicators(daily, "fwi", limits, ("cell", "period")).join(support, "cell")
    annual = annual.withColumns({
        n: masks.fill_inside(F.col(n).cast("double"), F.col("support")) for n in ("fwixx", "fwixd", "fwils", "fwisa")})
    return daily.where("period = 'output'").drop("period"), annual


def publish(df: DataFrame, value: str, variable: str, path: str, overwrite: bool = False) -> dict:
    """Pack one variable, refuse saturation, publish whole, reopen and check it, and return the packing report.

    The input is evaluated once; everything else works on that copy.
    """
    scale, offset = packing.specification(variable)
    df = cut_lineage(df.select("cell", "ord", F.col(value).alias(value)))
    report = scalar_row(packing.packing_report(df, value, scale, offset)).asDict()
    if not report["valid_packing"]:
        raise ValueError(f"{variable} does not fit its packing: {report}")
    packed = df.select("cell", "ord", cal.year_of_ord(F.col("ord")).alias("year"),
                       packing.pack(F.col(value), scale, offset, variable).alias("code"))
    # Files hold whole cells of one year, in cell order, for contiguous reads.
    ordered = packed.repartition("year", F.expr("cell div 1024")).sortWithinPartitions("year", "cell", "ord")
    stores.publish(ordered, path, partition_by=["year"], overwrite=overwrite)
    verify_published(df, value, variable, path)
    return report


def verify_published(df: DataFrame, value: str, variable: str, path: str) -> None:
    """Reopen a published store: it must hold every cell and day of ``df`` with the code of its value, and nothing else.

    A code is the nearest step to its value, so equal codes are values within half a
    packing step.  Both sides come down to one row, nothing is joined.
    """
    scale, offset = packing.specification(variable)

    def summary(rows: DataFrame):
        return scalar_row(rows.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("code") != packing.FILL).alias("valid"),
            F.sum(F.xxhash64("cell", "ord").cast("decimal(38,0)")).alias("keys"),
            F.sum(F.xxhash64("cell", "ord", F.col("code").cast("smallint")).cast("decimal(38,0)")).alias("values")))

    wanted = summary(df.select("cell", "ord", packing.pack(F.col(value), scale, offset, variable).alias("code")))
    found = summary(df.sparkSession.read.parquet(path))
    if wanted != found:
        raise OSError(f"{path} does not hold what was published: {found} instead of {wanted}")


def publish_batch(products: dict[str, tuple[DataFrame, str, str]], overwrite: bool = False) -> dict[str, dict]:
    """Publish several (data, value, variable) by path; a store that is there and whole is left alone."""
    reports = {}
    for path, (df, value, variable) in products.items():
        stores.recover(df.sparkSession, path)
        if not overwrite and stores.exists(df.sparkSession, path):
            verify_published(df, value, variable, path)
            reports[path] = {"skipped": True}
        else:
            reports[path] = {"skipped": False, **publish(df, value, variable, path, overwrite)}
    return reports


def inputs_report(reference: DataFrame, historical: DataFrame, simulation: DataFrame, value: str, minimum_years: int) -> DataFrame:
    """One row per input: time checks over all cells, before any adjustment starts."""
    def check(df: DataFrame, name: str) -> DataFrame:
        checks = qc.time_checks(df, ["cell"], minimum_years)
        flags = ("time_monotonic", "time_unique", "daily_without_gaps", "training_period_sufficient")
        return checks.agg(*[F.bool_and(f).alias(f) for f in flags]).withColumn("input", F.lit(name))

    return check(reference, "reference").unionByName(check(historical, "historical")).unionByName(check(simulation, "simulation"))
