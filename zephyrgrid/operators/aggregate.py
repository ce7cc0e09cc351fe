"""Block means, coverage, climatologies, edge and boundary statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics as ph
from ..session import attach_row, cut_lineage
from .quantiles import counted_quantiles, exact_quantiles


def area_weighted_mean(value: Column, lat: Column) -> Column:
    """Cosine-weighted mean over valid cells; NULL when none is valid."""
    weight = ph.latitude_weight(lat)
    return F.try_divide(F.sum(weight * value), F.sum(F.when(value.isNotNull(), weight)))


def coarse_mean(df: DataFrame, value: str, keys: tuple[str, ...] = ("ord",)) -> DataFrame:
    return df.groupBy("coarse", *keys).agg(area_weighted_mean(F.col(value), F.col("lat")).alias(value))


def conservation(fine: DataFrame, coarse: DataFrame, value: str, tolerance: float = 0.05) -> DataFrame:
    """One row comparing aggregated fine values with the coarse field.

    ``fine`` has (coarse, ord, lat, value), ``coarse`` has (coarse, ord, value).
    """
    back = coarse_mean(fine, value).withColumnRenamed(value, "aggregated")
    pair = coarse.select("coarse", "ord", F.col(value).alias("target")).join(back, ["coarse", "ord"], "left")
    gap = F.col("aggregated") - F.col("target")
    metrics = pair.agg(
        F.avg(F.abs(gap)).alias("mean_absolute_error"),
        F.max(F.abs(gap)).alias("maximum_absolute_error"),
        F.sqrt(F.avg(gap * gap)).alias("root_mean_square_error"),
        F.avg(gap).alias("mean_bias"),
        F.stddev_pop("target").alias("deviation"),
        F.avg(F.abs(F.col("target"))).alias("magnitude"),
    )
    scale = F.when(F.col("deviation") > 0, F.col("deviation")).otherwise(F.col("magnitude"))
    normalized = F.when(scale > 0, F.col("root_mean_square_error") / scale).otherwise(
        F.col("root_mean_square_error")
    )
    return metrics.withColumn("normalized_rmse", normalized).withColumn(
        "valid", F.coalesce(F.col("normalized_rmse") <= tolerance, F.lit(False))
    ).drop("deviation", "magnitude")


def coverage(df: DataFrame, value: str, days: int, minimum: float = 0.95, cells: DataFrame | None = None) -> DataFrame:
    """One row: share of valid values, empty cells, thin cells, infinite values."""
    finite = F.col(value).isNotNull() & (F.abs(F.col(value)) < F.lit(float("inf")))
    per_cell = df.groupBy("cell").agg(
        F.count_if(finite).alias("valid"),
        F.count_if(F.abs(F.col(value)) == F.lit(float("inf"))).alias("infinite"),
    )
    if cells is not None:
        per_cell = cells.select("cell").join(per_cell, "cell", "left").na.fill(0)
    thin = (F.col("valid") > 0) & (F.col("valid") / F.lit(days) < minimum)
    return per_cell.agg(
        (F.sum("valid") / (F.count(F.lit(1)) * F.lit(days))).alias("finite_fraction"),
        F.count_if(F.col("valid") == 0).alias("all_missing_cells"),
        F.count_if(thin).alias("partial_cells"),
        (F.sum("infinite") > 0).alias("has_infinite"),
    ).withColumn("valid", (F.col("partial_cells") == 0) & ~F.col("has_infinite"))


def climatology_jump(df: DataFrame, value: str) -> DataFrame:
    """Largest over median step between neighbouring days of the mean annual cycle."""
    spatial = df.groupBy("ord", "doy").agg(F.avg(value).alias("m"))
    cycle = spatial.groupBy("doy").agg(F.avg("m").alias("m"))
    # At most 365 rows by construction, so one task orders them.
    step = F.abs(F.col("m") - F.lag("m").over(Window.orderBy("doy")))
    steps = cycle.withColumn("step", step)
    summary = steps.agg(F.max("step").alias("largest"), F.percentile("step", 0.5).alias("typical"))
    ratio = F.when(F.col("typical") > 0, F.col("largest") / F.col("typical")).otherwise(F.lit(0.0))
    return summary.withColumn("ratio", ratio).withColumn(
        "discontinuity", (F.col("typical") > 0) & (F.col("ratio") > 10)
    )


def distribution(df: DataFrame, value: str, probabilities: list[float]) -> DataFrame:
    """Count, mean and deviation with exact whole-table quantiles, one row per quantile."""
    moments = df.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation")
    )
    points = exact_quantiles(df, value, probabilities).select("p", "quantile")
    return attach_row(points, moments)


def neighbour_edges(cells: DataFrame, side: int, *carry: str) -> DataFrame:
    """Pairs of cells that touch to the south-north or west-east (longitude wraps)."""
    cols = ["cell", *carry]
    moved = cells.select(*cols, "fi", "fj").withColumn(
        "s", F.explode(F.array(
            F.struct(F.lit("lat").alias("axis"), F.lit(1).alias("di"), F.lit(0).alias("dj")),
            F.struct(F.lit("lon").alias("axis"), F.lit(0).alias("di"), F.lit(1).alias("dj")),
        ))
    )
    first = moved.select(
        *[F.col(c).alias(f"a_{c}") for c in cols], "s.axis",
        (F.col("fi") + F.col("s.di")).alias("fi"),
        F.pmod(F.col("fj") + F.col("s.dj"), F.lit(side)).alias("fj"),
    )
    second = cells.select(*[F.col(c).alias(f"b_{c}") for c in cols], "fi", "fj")
    return first.join(second, ["fi", "fj"]).drop("fi", "fj")


def edge_differences(df: DataFrame, edges: DataFrame, value: str) -> DataFrame:
    """Both endpoint values of every edge on every day that either endpoint has."""
    series = df.select("cell", "ord", F.col(value).alias("v"))
    long = edges.select(
        "*", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("a_cell").alias("cell")),
                               F.struct(F.lit(1).alias("end"), F.col("b_cell").alias("cell")))).alias("e")
    ).select(*[c for c in edges.columns], "e.end", "e.cell")
    keys = edges.columns
    both = long.join(series, "cell").groupBy(*keys, "ord").agg(
        F.max(F.when(F.col("end") == 0, F.col("v"))).alias("first"),
        F.max(F.when(F.col("end") == 1, F.col("v"))).alias("second"),
    )
    return both.withColumn("difference", F.abs(F.col("first") - F.col("second")))


def source_pair(a: Column, b: Column) -> Column:
    """Label of a same-source or cross-source pair; NULL when an endpoint has no source."""
    low, high = F.least(a, b), F.greatest(a, b)
    label = F.when(a == b, F.concat(F.lit("same-"), a.cast("string"))).otherwise(
        F.concat_ws("-", low.cast("string"), high.cast("string"))
    )
    return F.when((a > 0) & (b > 0), label)


def boundary_statistics(edges: DataFrame, group: str, value: str) -> DataFrame:
    """Median, p95, p99 and count of a difference for each label of ``group``."""
    points = exact_quantiles(edges, value, [0.5, 0.95, 0.99], by=group)
    return points.groupBy(group).agg(
        F.max("n").alias("edges"),
        F.max(F.when(F.col("p") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("p") == 0.95, F.col("quantile"))).alias("p95"),
        F.max(F.when(F.col("p") == 0.99, F.col("quantile"))).alias("p99"),
    )


def gradient_ratio(edges: DataFrame, difference: str, on_boundary: str) -> DataFrame:
    """Median step on every n-th boundary over the median step elsewhere."""
    labelled = edges.withColumn("place", F.when(F.col(on_boundary), "on").otherwise("off"))
    medians = exact_quantiles(labelled, difference, [0.5], by="place")
    row = medians.agg(
        F.max(F.when(F.col("place") == "on", F.col("quantile"))).alias("on_median"),
        F.max(F.when(F.col("place") == "off", F.col("quantile"))).alias("off_median"),
    )
    return row.withColumn("ratio", F.try_divide("on_median", F.nullif(F.col("off_median"), F.lit(0.0))))


def land_gap_summary(cells: DataFrame, share: str, area: str, covered: str) -> DataFrame:
    """Land and missing land for four land-share limits (long form, one row per limit)."""
    # The land-share limits; 0 means any land at all.
    limits = (("any_land", 0.0), ("land_1pct", 0.01), ("land_10pct", 0.1), ("land_50pct", 0.5))
    flags = F.array(*[
        F.struct(F.lit(n).alias("limit"),
                 ((F.col(share) > 0) if t == 0 else (F.col(share) >= t)).alias("land"))
        for n, t in limits
    ])
    land_area = F.col(share) * F.col(area)
    rows = cells.select(land_area.alias("area"), F.col(covered).alias("covered"), F.explode(flags).alias("f"))
    missing = F.col("f.land") & ~F.col("covered")
    return rows.groupBy("f.limit").agg(
        F.count_if("f.land").alias("land_cells"),
        F.count_if(missing).alias("missing_cells"),
        F.sum(F.when(missing, F.col("area")).otherwise(0.0)).alias("missing_area"),
        F.try_divide(
            F.sum(F.when(missing, F.col("area")).otherwise(0.0)), F.sum(F.when(F.col("f.land"), F.col("area")))
        ).alias("missing_fraction"),
    )


def weighted_annulus_series(df: DataFrame, ring: DataFrame, value: str) -> DataFrame:
    """Area-weighted mean per place and year over the valid ring cells, and their number."""
    v, w = F.col(value), F.col("weight")
    return df.join(ring.select("place", "cell", "weight"), "cell").groupBy("place", "year").agg(
        F.try_divide(F.sum(v * w), F.sum(F.when(v.isNotNull(), w))).alias("mean"),
        F.count_distinct(F.when(v.isNotNull(), F.col("cell"))).alias("cells"),
    )


def edge_comparison(df: DataFrame, current: str, alternative: str, neighbour: str) -> DataFrame:
    """Does an alternative value join its neighbour more smoothly than the current one?"""
    joins = df.select(
        F.abs(F.col(current) - F.col(neighbour)).alias("now"),
        F.abs(F.col(alternative) - F.col(neighbour)).alias("then"),
    )
    # One pass over the joins: each step becomes a value with its number of rows before anything is asked of it.
    now, then = F.col("now"), F.col("then")
    both = now.isNotNull() & then.isNotNull()
    steps = joins.select(F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("x"), both.alias("both"), F.coalesce(then < now, F.lit(False)).alias("better"))
        for kind in ("now", "then")])).alias("s")).select("s.*")
    held = cut_lineage(steps.groupBy("kind", "x").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("both").alias("both"), F.count_if("better").alias("better")))
    p95 = counted_quantiles(held, "x", "n", [0.95], "kind").agg(
        F.max(F.when(F.col("kind") == "now", F.col("quantile"))).alias("p95_now"),
        F.max(F.when(F.col("kind") == "then", F.col("quantile"))).alias("p95_then"),
    )
    counts = held.where("kind = 'now'").agg(F.coalesce(F.sum("both"), F.lit(0)).alias("pairs"), F.sum("better").alias("better")).select(
        "pairs", F.try_divide("better", "pairs").alias("improved"))
    return attach_row(counts, p95).withColumn(
        "p95_change", F.col("p95_then") - F.col("p95_now")
    ).withColumn(
        "p95_percent_change",
        F.when(F.col("p95_now") != 0, 100 * (F.try_divide(F.col("p95_then"), F.col("p95_now")) - 1)),
    )


def seam_diagnostics(df: DataFrame, value: str, seam: int, side: int, south: float, north: float) -> DataFrame:
    """Step across a longitude seam against the steps beside it, per day.

    Columns ``seam-1 | seam`` form the seam; wet days only (at least 1 unit).
    """
    place = F.pmod(F.col("fj") - F.lit(seam - 2), F.lit(side))
    wide = (
        df.where(F.col("lat").between(south, north)).withColumn("place", place).where("place < 4")
        .groupBy("ord", "fi")
        .agg(*[F.max(F.when(F.col("place") == i, F.col(value))).alias(f"v{i}") for i in range(4)])
    )
    ok = F.expr("v0 + v1 + v2 + v3 IS NOT NULL")
    daily = wide.where(ok).groupBy("ord").agg(
        F.avg(F.abs(F.col("v1") - F.col("v2"))).alias("seam_mean"),
        (0.5 * (F.avg(F.abs(F.col("v0") - F.col("v1"))) + F.avg(F.abs(F.col("v2") - F.col("v3"))))).alias("beside_mean"),
        (0.5 * (F.avg("v1") + F.avg("v2"))).alias("rain"),
    )
    return daily.select("ord", "seam_mean", "beside_mean", F.when(
        F.col("rain") >= 1, F.col("seam_mean") / (F.col("beside_mean") + 0.01)).alias("ratio"))
