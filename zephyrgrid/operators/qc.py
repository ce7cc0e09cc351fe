"""Quality control: time axes, bounds, coverage, consistency, audits, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics as ph
from ..functions.presets import (
    PRECIPITATION_CEILING_MM_DAY,
    STATIC_FLOOR_K,
    TEMPERATURE_VALID_RANGE_K,
    WIND_CEILING_M_S,
)
from ..session import attach_row, cut_lineage
from .aggregate import coarse_mean
from .quantiles import counted_quantiles, exact_quantiles


def time_checks(df: DataFrame, keys: list[str], minimum_years: int | None = None, days_per_year: int = 365) -> DataFrame:
    """Per series: strictly increasing, unique, daily without gaps, long enough.

    A long table has no stored order, so the only way to fail monotonicity is a
    repeated day; both flags are kept because reports list both.
    """
    order = Window.partitionBy(*keys).orderBy("ord")
    steps = df.withColumn("step", F.col("ord") - F.lag("ord").over(order))
    checks = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        (F.count_if(F.col("step") <= 0) == 0).alias("time_monotonic"),
        (F.count_if(F.col("step") == 0) == 0).alias("time_unique"),
        (F.count_if(F.col("step") != 1) == 0).alias("daily_without_gaps"),
    )
    if minimum_years is None:
        return checks
    return checks.withColumn(
        "training_period_sufficient", F.col("days") >= minimum_years * days_per_year
    )


def bounds_hold(variable: str) -> Column:
    """Aggregate column: are all values of ``variable`` physically possible?

    An all-missing column passes.  Precipitation is in mm/day; rsds needs the
    top-of-atmosphere radiation in ``toa``.
    """
    v = F.col(variable)
    low, high = TEMPERATURE_VALID_RANGE_K
    bad = {
        "hurs": (v < 0) | (v > 100),
        "pr": (v < 0) | (v > PRECIPITATION_CEILING_MM_DAY),
        "wind": v < 0,
        "prsnratio": (v < 0) | (v > 1),
        "tasskew": (v < 0) | (v > 1),
        "tas": (v <= low) | (v >= high),
        "ps": v < 0, "rlds": v < 0, "tasrange": v < 0,
    }
    if variable == "rsds":
        index = ph.clearness_index(v, F.col("toa"))
        return F.count_if((index < 0) | (index > 1)) == 0
    if variable not in bad:
        raise ValueError(f"no physical bounds for {variable!r}")
    return F.count_if(bad[variable]) == 0


def variable_report(df: DataFrame, variables: list[str], days: int, minimum_valid_fraction: float = 0.95) -> DataFrame:
    """One row per variable: coverage, extrema, bounds, warnings and the verdict.

    Two grouped passes over one scan: per cell, then overall.
    """
    if "rsds" in variables:
        df = ph.with_top_radiation(df)
    else:
        df = df.withColumn("toa", F.lit(None).cast("double"))
    long = df.select(
        "cell", "toa",
        F.explode(F.array(*[
            F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value")) for v in variables
        ])).alias("s"),
    ).select("cell", "toa", "s.variable", "s.value")
    v = F.col("value")
    infinite = F.abs(v) == F.lit(float("inf"))
    low, high = TEMPERATURE_VALID_RANGE_K
    name = F.col("variable")
    below_zero = name.isin("pr", "wind", "hurs", "prsnratio", "tasskew", "ps", "rlds", "tasrange") & (v < 0)
    above = (
        ((name == "hurs") & (v > 100)) | ((name == "pr") & (v > PRECIPITATION_CEILING_MM_DAY))
        | (name.isin("prsnratio", "tasskew") & (v > 1))
    )
    outside = (name == "tas") & ((v <= low) | (v >= high))
    index = ph.clearness_index(v, F.col("toa"))
    dark = (name == "rsds") & ((index < 0) | (index > 1))
    per_cell = long.groupBy("variable", "cell").agg(
        F.count(v).alias("valid"), F.count_if(infinite).alias("infinite"),
        F.count_if(below_zero | above | outside | dark).alias("bad"),
        F.count_if((name == "wind") & (v > WIND_CEILING_M_S)).alias("strong"),
        F.min(v).alias("low"), F.max(v).alias("high"),
    )
    thin = (F.col("valid") > 0) & (F.col("valid") / F.lit(days) < minimum_valid_fraction)
    report = per_cell.groupBy("variable").agg(
        F.min("low").alias("minimum"), F.max("high").alias("maximum"),
        (F.sum("valid") / (F.count(F.lit(1)) * F.lit(days))).alias("finite_fraction"),
        F.count_if(F.col("valid") == 0).alias("all_missing_cells"),
        F.count_if(thin).alias("partial_cells"),
        F.sum("infinite").alias("infinite_values"),
        (F.sum("bad") == 0).alias("bounds_ok"),
        (F.sum("strong") > 0).alias("wind_warning"),
    )
    return report.withColumn(
        "valid", (F.col("partial_cells") == 0) & (F.col("infinite_values") == 0) & F.col("bounds_ok")
    )


def metadata_checks(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Units must match (fatal); standard names should (warning)."""
    joined = expected.join(found, "variable", "left")
    return joined.select(
        "variable",
        F.col("unit").eqNullSafe(F.col("expected_unit")).alias("unit_ok"),
        F.when(~F.col("standard_name").eqNullSafe(F.col("expected_name")), F.lit("standard_name differs")).alias("warning"),
    )


def close_enough(a: Column, b: Column, relative: float, absolute: float = 1e-8) -> Column:
    """Aggregate column: do all pairs agree within the tolerances?"""
    return F.coalesce(
        F.max(F.abs(a - b) - (F.lit(absolute) + F.lit(relative) * F.abs(b))) <= 0, F.lit(True)
    )


def linked_consistency(df: DataFrame) -> DataFrame:
    """One row of checks between linked variables, for whichever are present."""
    have = set(df.columns)
    tests: dict[str, Column] = {}
    none = lambda condition: F.count_if(condition) == 0
    if {"tas", "tasmin", "tasmax"} <= have:
        tests["temperature_order"] = none(~((F.col("tasmin") <= F.col("tas")) & (F.col("tas") <= F.col("tasmax"))))
    if {"pr", "prsn"} <= have:
        tests["snow_within_rain"] = none((F.col("prsn") < 0) | (F.col("prsn") > F.col("pr")))
    if {"tasmin", "tas", "tasskew", "tasrange"} <= have:
        tests["tasmin_consistent"] = close_enough(
            F.col("tasmin"), F.col("tas") - F.col("tasskew") * F.col("tasrange"), 1e-6)
    if {"tasmax", "tas", "tasskew", "tasrange"} <= have:
        tests["tasmax_consistent"] = close_enough(
            F.col("tasmax"), F.col("tas") + (1 - F.col("tasskew")) * F.col("tasrange"), 1e-6)
    if {"prsn", "pr", "prsnratio"} <= have:
        tests["prsn_consistent"] = close_enough(F.col("prsn"), F.col("pr") * F.col("prsnratio"), 1e-6)
    if {"huss", "tas", "hurs", "ps"} <= have:
        tests["huss_range"] = none((F.col("huss") < 0) | (F.col("huss") > 1))
        tests["huss_consistent"] = close_enough(
            F.col("huss"), ph.specific_humidity(F.col("tas"), F.col("hurs"), F.col("ps")), 1e-4)
    row = df.agg(*[c.alias(n) for n, c in tests.items()])
    return row.withColumn("valid", F.forall(F.array(*[F.col(n) for n in tests]), lambda ok: ok))


def tile_report(written: DataFrame, reference: DataFrame, variable: str, days: int, tile: str,
                minimum_valid_fraction: float = 0.95) -> DataFrame:
    """QC of written tiles over the whole record against the reference's first year of cells."""
    v = F.col(variable)
    per_cell = written.groupBy(tile, "cell").agg(
        F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
        (F.count_if(F.abs(v) == F.lit(float("inf"))) > 0).alias("infinite"),
        F.bool_and(F.coalesce(v == STATIC_FLOOR_K, F.lit(False))).alias("frozen"),
    )
    expected = reference.groupBy(tile, "cell").agg((F.count(variable) > 0).alias("expected"))
    both = per_cell.join(expected, [tile, "cell"], "full_outer")
    active = F.coalesce(F.col("n"), F.lit(0)) > 0
    wanted = F.coalesce("expected", F.lit(False))
    report = both.groupBy(tile).agg(
        F.count_if(active).alias("active_cells"),
        F.count_if(active & (F.col("n") / F.lit(days) < minimum_valid_fraction)).alias("partial_cells"),
        F.count_if(wanted & ~active).alias("missing_reference_cells"),
        F.count_if(active & ~wanted).alias("extra_cells"),
        F.min("low").alias("minimum"), F.max("high").alias("maximum"),
        F.count_if("infinite").alias("infinite_cells"),
        (F.count_if("frozen") if variable == "tas" else F.lit(0)).alias("static_cells"),
    )
    low, high = TEMPERATURE_VALID_RANGE_K
    limits = {"pr": (0.0, PRECIPITATION_CEILING_MM_DAY), "wind": (0.0, None), "tas": (low, high), "hurs": (0.0, 100.0)}
    floor, ceiling = limits.get(variable, (None, None))
    ok = (F.col("partial_cells") + F.col("missing_reference_cells") + F.col("extra_cells")
          + F.col("infinite_cells") + F.col("static_cells")) == 0
    if floor is not None:
        ok = ok & F.coalesce(F.col("minimum") >= floor, F.lit(True))
    if ceiling is not None:
        ok = ok & F.coalesce(F.col("maximum") <= ceiling, F.lit(True))
    return report.withColumn("valid", ok)


def edge_audit(differences: DataFrame, group: str) -> DataFrame:
    """Pairs, missing endpoints and the p95 step of each group, against same-source controls."""
    # One pass over the differences: rows with the same step become one, whatever is asked of them later.
    held = cut_lineage(differences.groupBy(group, "difference").agg(
        F.count_if(F.col("first").isNull()).alias("no_first"), F.count_if(F.col("second").isNull()).alias("no_second"),
        F.count(F.lit(1)).alias("n"), F.min(F.least("first", "second")).alias("low"), F.max(F.greatest("first", "second")).alias("high")))
    counts = held.groupBy(group).agg(
        F.coalesce(F.sum(F.when(F.col("difference").isNotNull(), F.col("n"))), F.lit(0)).alias("paired"),
        F.sum(F.col("no_first") + F.col("no_second")).alias("missing"),
        F.sum("n").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    p95 = counted_quantiles(held, "difference", "n", [0.95], group).select(group, F.col("quantile").alias("p95"))
    report = counts.join(p95, group, "left").withColumn("missing_fraction", F.col("missing") / (2 * F.col("rows")))
    # Codes may have any number of digits: controls of "a-b" are "same-a" and "same-b".
    controls = p95.where(F.col(group).startswith("same-") & (F.col("p95") != 0)).select(
        F.substring_index(group, "-", -1).alias("source"), F.col("p95").alias("control"))
    crossing = report.where(~F.col(group).startswith("same-")).select(group, F.explode(F.split(group, "-")).alias("source"))
    control = crossing.join(controls, "source").groupBy(group).agg(F.avg("control").alias("control"))
    return report.join(control, group, "left").select(
        group, "paired", "missing", "missing_fraction", "low", "high", "p95",
        F.try_divide(F.col("p95"), F.col("control")).alias("control_ratio"))


def coarse_consistency(fine: DataFrame, stored: DataFrame, value: str) -> DataFrame:
    again = coarse_mean(fine, value).withColumnRenamed(value, "again")
    gap = stored.join(again, ["coarse", "ord"]).select(F.abs(F.col("again") - F.col(value)).alias("gap"))
    summary = gap.agg(F.count("gap").alias("compared"), F.avg("gap").alias("mean_error"), F.max("gap").alias("max_error"))
    p99 = exact_quantiles(gap, "gap", [0.99]).select(F.col("quantile").alias("p99_error"))
    return attach_row(summary, p99)


def temporal_report(df: DataFrame, value: str, days: int) -> DataFrame:
    order = Window.partitionBy("cell").orderBy("ord")
    jump = F.when(F.col("ord") - F.lag("ord").over(order) == 1, F.abs(F.col(value) - F.lag(value).over(order)))
    steps = df.select("cell", "ord", value, jump.alias("jump"))
    cells = steps.groupBy("cell").agg(F.count(value).alias("n"), F.stddev_pop(value).alias("s"))
    summary = cells.agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("n") != days).alias("partial_series"),
        F.count_if(F.col("s") == 0).alias("constant_series"))
    jumps = steps.agg(F.count("jump").alias("jumps"), F.avg("jump").alias("jump_mean"), F.max("jump").alias("jump_max"))
    points = exact_quantiles(steps, "jump", [0.5, 0.99]).agg(
        F.max(F.when(F.col("p") == 0.5, F.col("quantile"))).alias("jump_p50"),
        F.max(F.when(F.col("p") == 0.99, F.col("quantile"))).alias("jump_p99"))
    return attach_row(attach_row(summary, jumps), points)


def calendar_report(df: DataFrame) -> DataFrame:
    """Days per cell and year: extremes, uniqueness, gaps and leap days."""
    yearly = df.groupBy("cell", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ord").alias("u"),
        (F.max("ord") - F.min("ord") + 1).alias("span"),
        F.count_if((F.col("month") == 2) & (F.col("day") == 29)).alias("leap"))
    return yearly.groupBy("year").agg(
        F.min("n").alias("fewest"), F.max("n").alias("most"),
        F.bool_and(F.col("n") == F.col("u")).alias("unique"),
        F.bool_and(F.col("n") == F.col("span")).alias("gapless"), F.sum("leap").alias("leap_days"))


def sample_edges(edges: DataFrame, group: str, limit: int) -> DataFrame:
    """Up to ``limit`` edges per group in the order of a stable hash: the sampling audit.

    Each group's candidates are cut down per salt first, so no task sorts a whole group.
    """
    mixed = edges.withColumn(
        "h", F.pmod(F.col("a_cell") * F.lit(2654435761) + F.col("b_cell") * F.lit(40503), F.lit(1000003)))
    salted = mixed.withColumn("salt", F.pmod("a_cell", F.lit(64)))
    for keys in ([group, "salt"], [group]):
        order = Window.partitionBy(*keys).orderBy("h", "a_cell", "b_cell")
        salted = salted.withColumn("r", F.row_number().over(order)).where(F.col("r") <= limit)
    return salted.drop("h", "salt", "r")


def reference_audit(df: DataFrame, bounds: dict[str, tuple[float, float]], probabilities: list[float]) -> DataFrame:
    """One row per variable: count, moments, extremes, quantiles (p1, p50, ...) and values outside its bounds.

    All variables go through the same scans: one row per value, labelled by variable.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("variable"), F.col(n).cast("double").alias("v"), F.lit(a).alias("floor"), F.lit(b).alias("ceiling"))
                                for n, (a, b) in bounds.items()])).alias("x")
    long = df.select(pairs).select("x.*").where("v IS NOT NULL AND NOT isnan(v)")
    moments = long.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("deviation"), F.min("v").alias("minimum"),
        F.max("v").alias("maximum"), F.count_if((F.col("v") < F.col("floor")) | (F.col("v") > F.col("ceiling"))).alias("outside"))
    points = exact_quantiles(long, "v", probabilities, by="variable")
    ranks = points.groupBy("variable").agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(f"p{round(p * 100)}") for p in probabilities])
    return moments.join(ranks, "variable")
