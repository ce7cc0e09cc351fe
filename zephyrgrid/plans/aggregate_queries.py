"""Queries over aggregates, windows and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as agg
from ..operators import indicators as ind
from ..operators import masks, windows
from ..operators.quantiles import circular_day_windows, group_percentiles, sorted_array_quantiles
from ..session import scalar_row
from ..sources.cube import cell_table, daily_cube, grid_side
from .registry import query, rounded

PROBABILITIES = [i / 10 for i in range(11)]
DISTRIBUTION = [0.0, 0.001, 0.01, 0.5, 0.99, 0.999, 1.0]


def axis_days(cube) -> int:
    """Length of the shared time axis: distinct days of the cube, one number."""
    return scalar_row(cube.agg(F.count_distinct("ord").alias("n")))["n"]


@query("area_weighted_coarse_mean", """
SELECT coarse, ord, round(sum(cos(radians(lat)) * tasm) / sum(CASE WHEN tasm IS NOT NULL THEN cos(radians(lat)) END), 6) AS tasm
FROM cube GROUP BY coarse, ord""", "cube")
def area_weighted_coarse_mean(spark, d):
    return rounded(agg.coarse_mean(daily_cube(spark, d, "tasm"), "tasm"), 6, "tasm")


@query("conservation_metrics", """
target AS (SELECT coarse, ord, avg(tas) AS t FROM cube GROUP BY ALL),
back AS (SELECT coarse, ord, sum(cos(radians(lat)) * tas) / sum(cos(radians(lat))) AS a FROM cube GROUP BY ALL),
m AS (SELECT avg(abs(a - t)) AS e1, max(abs(a - t)) AS e2, sqrt(avg((a - t) * (a - t))) AS e3,
  avg(a - t) AS e4, stddev_pop(t) AS s FROM target JOIN back USING (coarse, ord))
SELECT round(e1, 8) AS mean_absolute_error, round(e2, 8) AS maximum_absolute_error,
  round(e3, 8) AS root_mean_square_error, round(e4, 8) AS mean_bias, round(e3 / s, 8) AS normalized_rmse,
  e3 / s <= 0.05 AS valid FROM m""", "cube")
def conservation_metrics(spark, d):
    c = daily_cube(spark, d, "tas")
    target = c.groupBy("coarse", "ord").agg(F.avg("tas").alias("tas"))
    out = agg.conservation(c, target, "tas")
    return rounded(out, 8, *[c for c in out.columns if c != "valid"])


@query("coverage_report", """
n AS (SELECT count(DISTINCT ord) AS days FROM cube),
per AS (SELECT cell, count(tasm) AS valid FROM cube GROUP BY cell)
SELECT round(sum(valid) / (count(*) * any_value(days)), 9) AS finite_fraction,
  count(*) FILTER (valid = 0) AS all_missing_cells,
  count(*) FILTER (valid > 0 AND valid / days < 0.7) AS partial_cells, FALSE AS has_infinite,
  count(*) FILTER (valid > 0 AND valid / days < 0.7) = 0 AS valid FROM per, n""", "cube")
def coverage_report(spark, d):
    c = daily_cube(spark, d, "tasm")
    return rounded(agg.coverage(c, "tasm", axis_days(c), 0.7), 9, "finite_fraction")


@query("global_extrema", """
SELECT min(tasm) AS tas_min, max(tasm) AS tas_max, min(pr) AS pr_min, max(pr) AS pr_max,
  min(wind) AS wind_min, max(wind) AS wind_max FROM cube""", "cube")
def global_extrema(spark, d):
    c = daily_cube(spark, d, "tasm", "pr", "wind")
    return c.agg(*[f(v).alias(f"{n}_{s}") for n, v in (("tas", "tasm"), ("pr", "pr"), ("wind", "wind"))
                   for s, f in (("min", F.min), ("max", F.max))])


@query("doy_climatology_jump", """
s AS (SELECT ord, doy, avg(tasm) AS m FROM cube GROUP BY ALL),
c AS (SELECT doy, avg(m) AS m FROM s GROUP BY doy),
j AS (SELECT abs(m - lag(m) OVER (ORDER BY doy)) AS step FROM c),
r AS (SELECT max(step) AS largest, quantile_cont(step, 0.5) AS typical FROM j)
SELECT round(largest, 6) AS largest, round(typical, 6) AS typical, round(largest / typical, 6) AS ratio,
  largest / typical > 10 AS discontinuity FROM r""", "cube")
def doy_climatology_jump(spark, d):
    return rounded(agg.climatology_jump(daily_cube(spark, d, "tasm"), "tasm"), 6, "largest", "typical", "ratio")


@query("support_footprint", """
n AS (SELECT count(DISTINCT ord) AS days FROM cube),
f AS (SELECT cell, coarse, count(tas) >= 0.78 * any_value(days) AND count(pr) >= 0.78 * any_value(days) AS support FROM cube, n GROUP BY ALL),
c AS (SELECT coarse, count(*) FILTER (m > 130 AND m < 377) >= 0.9 * any_value(days) AS support
  FROM (SELECT coarse, ord, avg(tas) AS m FROM cube GROUP BY ALL), n GROUP BY coarse)
SELECT f.cell, f.support AND coalesce(c.support, FALSE) AS support FROM f LEFT JOIN c USING (coarse)""", "cube")
def support_footprint(spark, d):
    """The virtual cube has gaps, so a day share stands in for 'every day'."""
    c = daily_cube(spark, d, "tas", "pr")
    days = axis_days(c)
    fine = c.groupBy("cell", "coarse").agg(
        ((F.count("tas") >= 0.78 * days) & (F.count("pr") >= 0.78 * days)).alias("support"))
    model = c.groupBy("coarse", "ord").agg(F.avg("tas").alias("m"))
    inside = F.when((F.col("m") > 130) & (F.col("m") < 377), 1)
    coarse = model.groupBy("coarse").agg((F.count(inside) >= 0.9 * days).alias("support"))
    return masks.combined_support(fine, coarse).select("cell", "support")


@query("complete_support", """
n AS (SELECT count(DISTINCT ord) AS days FROM cube)
SELECT cell, count(tas) = any_value(days) AND count(pr) = any_value(days) AS support,
  any_value(days) - least(count(tas), count(pr)) AS missing_days FROM cube, n GROUP BY cell""", "cube")
def complete_support(spark, d):
    """Which cells have both variables on every day of the axis, and how many days the others lack."""
    c = daily_cube(spark, d, "tas", "pr")
    return masks.complete_support(c, axis_days(c), "tas", "pr")


_THRESHOLDS = """lim AS (SELECT cell, quantile_cont(wind, 0.95) AS q95, (min(wind) + max(wind)) / 2 AS midrange
  FROM cube WHERE year BETWEEN 1995 AND 1998 GROUP BY cell)"""


@query("season_thresholds", _THRESHOLDS + """
SELECT cell, round(CASE WHEN land THEN coalesce(q95, 0) ELSE q95 END, 8) AS q95,
  round(CASE WHEN land THEN coalesce(midrange, 0) ELSE midrange END, 8) AS midrange
FROM cells LEFT JOIN lim USING (cell)""", "cube", "cells")
def season_thresholds(spark, d):
    reference = daily_cube(spark, d, "wind").where("year BETWEEN 1995 AND 1998")
    mask = cell_table(spark, d).select("cell", F.col("land").alias("support"))
    out = ind.season_thresholds(reference, "wind", mask).select("cell", "q95", "midrange")
    return rounded(out, 8, "q95", "midrange")


_ANNUAL = _THRESHOLDS + """,
r AS (SELECT cell, year, ord, wind, CASE WHEN count(*) OVER w = 90 THEN sum(coalesce(wind, 0)) OVER w / 90 END AS s
  FROM cube WINDOW w AS (PARTITION BY cell ORDER BY ord ROWS BETWEEN 45 PRECEDING AND 44 FOLLOWING))"""


@query("annual_fwi_indicators", _ANNUAL + """
SELECT cell, year, round(max(wind), 8) AS fwixx, count(*) FILTER (wind > round(q95, 10)) AS fwixd,
  count(*) FILTER (wind > midrange) AS fwils, round(max(s), 8) AS fwisa
FROM r JOIN lim USING (cell) GROUP BY cell, year""", "cube")
def annual_fwi_indicators(spark, d):
    """Season indicators of a stand-in index; one shuffle on the cell, thresholds joined per cell."""
    c = daily_cube(spark, d, "wind")
    limits = ind.season_thresholds(c.where("year BETWEEN 1995 AND 1998"), "wind")
    limits = limits.withColumn("q95", F.round("q95", 10))
    return rounded(ind.annual_season_indicators(c, "wind", limits), 8, "fwixx", "fwisa")


@query("annual_climate_indices", """
s AS (SELECT *, CASE WHEN pr < 1 THEN ord - sum(CASE WHEN pr < 1 THEN 1 ELSE 0 END) OVER (PARTITION BY cell, year ORDER BY ord) END AS spell FROM cube),
runs AS (SELECT cell, year, max(n) AS cdd FROM (SELECT cell, year, spell, count(*) AS n FROM s WHERE spell IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT cell, year, round(avg(tasm - 273.15), 6) AS tg_mean, round(sum(CASE WHEN pr >= 1 THEN pr ELSE 0 END), 6) AS prcptot,
  max(pr) AS rx1day, coalesce(any_value(cdd), 0)::BIGINT AS cdd,
  round(sum(greatest(0, tasm - 273.15 - (65 - 32) * 5.0::DOUBLE / 9)), 6) AS cdd65,
  round(sum(greatest(0, (65 - 32) * 5.0::DOUBLE / 9 - (tasm - 273.15))), 6) AS hdd65
FROM (SELECT * FROM cube WHERE tasm IS NOT NULL) LEFT JOIN runs USING (cell, year) GROUP BY cell, year""", "cube")
def annual_climate_indices(spark, d):
    c = daily_cube(spark, d, "tasm", "pr")
    full = ind.annual_climate_indices(c.where("tasm IS NOT NULL"), "tasm", "pr")
    runs = windows.longest_run(c, ["cell", "year"], F.col("pr") < 1)
    out = full.drop("cdd").join(runs.withColumnRenamed("longest", "cdd"), ["cell", "year"])
    return rounded(out, 6, "tg_mean", "prcptot", "cdd65", "hdd65")


@query("longest_dry_run", """
f AS (SELECT cell, year, ord - row_number() OVER (PARTITION BY cell, year ORDER BY ord) AS g FROM cube WHERE pr < 1),
l AS (SELECT cell, year, count(*) AS n FROM f GROUP BY cell, year, g)
SELECT cell, year, max(coalesce(n, 0))::BIGINT AS longest FROM (SELECT DISTINCT cell, year FROM cube) LEFT JOIN l USING (cell, year) GROUP BY ALL""",
       "cube")
def longest_dry_run(spark, d):
    return windows.longest_run(daily_cube(spark, d, "pr"), ["cell", "year"], F.col("pr") < 1)


@query("degree_days", """
SELECT cell, year, round(sum(greatest(0, tas - 273.15 - 55.0 / 3)), 6) AS cooling,
  round(sum(greatest(0, 55.0 / 3 - (tas - 273.15))), 6) AS heating FROM cube GROUP BY ALL""", "cube")
def degree_days(spark, d):
    c = daily_cube(spark, d, "tas", "pr")
    out = ind.annual_climate_indices(c).select(
        "cell", "year", F.col("cdd65").alias("cooling"), F.col("hdd65").alias("heating"))
    return rounded(out, 6, "cooling", "heating")


@query("mean_annual_max", """
SELECT cell, round(avg(p), 8) AS mean_peak, count(p) AS years
FROM (SELECT cell, year, max(wind) AS p FROM cube GROUP BY ALL) GROUP BY cell""", "cube")
def mean_annual_max(spark, d):
    return rounded(ind.mean_annual_maximum(daily_cube(spark, d, "wind"), "wind"), 8, "mean_peak")


@query("period_change", """
SELECT cell, round(a, 6) AS before, round(b, 6) AS after, round(b - a, 6) AS change,
  a IS NOT NULL AND b IS NULL AS lost, a IS NULL AND b IS NOT NULL AS gained FROM (
  SELECT cell, avg(tasm) FILTER (year <= 1998) AS a, avg(tasm) FILTER (year >= 1999) AS b
  FROM cube GROUP BY cell)""", "cube")
def period_change(spark, d):
    out = ind.period_change(daily_cube(spark, d, "tasm"), "tasm", (None, 1998), (1999, None))
    return rounded(out, 6, "before", "after", "change")


@query("display_limits", """
SELECT p::DOUBLE AS p, round(quantile_cont(c, p), 6) AS quantile FROM (
  SELECT avg(tasm) FILTER (year >= 1999) - avg(tasm) FILTER (year < 1999) AS c FROM cube GROUP BY cell),
  (SELECT unnest([0.01::DOUBLE, 0.99::DOUBLE]) AS p) GROUP BY p""".replace("quantile_cont(c, p)", "CASE WHEN p = 0.01::DOUBLE THEN quantile_cont(c, 0.01) ELSE quantile_cont(c, 0.99) END"),
       "cube")
def display_limits(spark, d):
    from ..operators.quantiles import exact_quantiles

    change = ind.period_change(daily_cube(spark, d, "tasm"), "tasm", (None, 1998), (1999, None))
    out = exact_quantiles(change, "change", [0.01, 0.99]).select("p", "quantile")
    return rounded(out, 6, "quantile")


@query("distribution_summary", """
m AS (SELECT count(tasm) AS n, avg(tasm) AS mean, stddev_pop(tasm) AS deviation FROM cube),
q AS (SELECT unnest([0, 0.001, 0.01, 0.5, 0.99, 0.999, 1]::DOUBLE[]) AS p,
  unnest(quantile_cont(tasm, [0, 0.001, 0.01, 0.5, 0.99, 0.999, 1])) AS quantile FROM cube)
SELECT p, round(quantile, 6) AS quantile, n, round(mean, 6) AS mean, round(deviation, 6) AS deviation FROM q, m""",
       "cube")
def distribution_summary(spark, d):
    out = agg.distribution(daily_cube(spark, d, "tasm"), "tasm", DISTRIBUTION)
    return rounded(out, 6, "quantile", "mean", "deviation")


@query("quantile_vectors", """
v AS (SELECT cell, month, count(tasm) AS n, quantile_cont(tasm, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS qs
  FROM cube GROUP BY cell, month)
SELECT cell, month, n, (i / 10)::DOUBLE AS p, round(qs[i + 1], 6) AS quantile FROM v, (SELECT unnest(range(11)) AS i)""", "cube")
def quantile_vectors(spark, d):
    v = group_percentiles(daily_cube(spark, d, "tasm"), ["cell", "month"], "tasm", PROBABILITIES)
    out = v.select("cell", "month", "n", F.posexplode("quantiles").alias("i", "quantile"))
    return rounded(out.withColumn("p", F.col("i") / 10).drop("i"), 6, "quantile")


@query("climatology", """
SELECT cell, round(avg(m), 6) AS mean FROM (SELECT cell, year, avg(tas) AS m FROM cube GROUP BY ALL) GROUP BY cell""", "cube")
def climatology(spark, d):
    yearly = daily_cube(spark, d, "tas").groupBy("cell", "year").agg(F.avg("tas").alias("m"))
    return yearly.groupBy("cell").agg(F.round(F.avg("m"), 6).alias("mean"))


_EDGES = """edges AS (
  SELECT a.cell AS a_cell, b.cell AS b_cell, a.code AS a_code, b.code AS b_code, x.axis, a.fi, a.fj
  FROM cells a, grid, (VALUES ('lat', 1, 0), ('lon', 0, 1)) x(axis, di, dj), cells b
  WHERE b.fi = a.fi + x.di AND b.fj = (a.fj + x.dj) % side),
pairs AS (SELECT *, CASE WHEN a_code > 0 AND b_code > 0 THEN CASE WHEN a_code = b_code THEN 'same-' || a_code
  ELSE least(a_code, b_code) || '-' || greatest(a_code, b_code) END END AS pair FROM edges)"""

_DIFF = _EDGES + """,
ends AS (SELECT a_cell, b_cell, axis, pair, 0 AS e, a_cell AS cell FROM pairs UNION ALL
  SELECT a_cell, b_cell, axis, pair, 1, b_cell FROM pairs),
diffs AS (SELECT a_cell, b_cell, axis, pair, ord, max(tasm) FILTER (e = 0) AS first, max(tasm) FILTER (e = 1) AS second
  FROM ends JOIN cube USING (cell) WHERE pair IS NOT NULL GROUP BY ALL)"""


def _pairs(spark, d):
    edges = agg.neighbour_edges(cell_table(spark, d), grid_side(spark, d), "code")
    return edges.withColumn("pair", agg.source_pair(F.col("a_code"), F.col("b_code")))


@query("neighbour_edges", _EDGES + "SELECT a_cell, b_cell, a_code, b_code, axis FROM edges", "cells")
def neighbour_edges(spark, d):
    return agg.neighbour_edges(cell_table(spark, d), grid_side(spark, d), "code")


@query("source_boundary_differences", _EDGES + """,
m AS (SELECT cell, avg(tas) AS v FROM cube GROUP BY cell),
x AS (SELECT pair, abs(a.v - b.v) AS g FROM pairs JOIN m a ON a.cell = a_cell JOIN m b ON b.cell = b_cell WHERE pair IS NOT NULL)
SELECT pair, count(g) AS edges, round(quantile_cont(g, 0.5), 6) AS median, round(quantile_cont(g, 0.95), 6) AS p95,
  round(quantile_cont(g, 0.99), 6) AS p99 FROM x GROUP BY pair""", "cube", "cells")
def source_boundary_differences(spark, d):
    means = daily_cube(spark, d, "tas").groupBy("cell").agg(F.avg("tas").alias("v"))
    cells = cell_table(spark, d).join(means, "cell")
    edges = agg.neighbour_edges(cells, grid_side(spark, d), "code", "v").select(
        agg.source_pair(F.col("a_code"), F.col("b_code")).alias("pair"),
        F.abs(F.col("a_v") - F.col("b_v")).alias("gap"))
    return rounded(agg.boundary_statistics(edges, "pair", "gap"), 6, "median", "p95", "p99")


@query("edge_audit", _DIFF + """,
q AS (SELECT pair, quantile_cont(abs(first - second), 0.95) AS p95, count(abs(first - second)) AS paired,
    count(*) FILTER (first IS NULL) + count(*) FILTER (second IS NULL) AS missing, count(*) AS n,
    min(least(first, second)) AS low, max(greatest(first, second)) AS high FROM diffs GROUP BY pair)
SELECT pair, paired, missing::BIGINT AS missing, round(missing / (2.0 * n), 6) AS missing_fraction, low, high,
  round(p95, 6) AS p95,
  round(p95 / (SELECT avg(nullif(s.p95, 0)) FROM q s WHERE s.pair IN ('same-' || q.pair[1], 'same-' || q.pair[3]) AND length(q.pair) = 3), 6) AS control_ratio
FROM q""", "cube", "cells")
def edge_audit(spark, d):
    from ..operators.qc import edge_audit as audit

    series = agg.edge_differences(daily_cube(spark, d, "tasm"), _pairs(spark, d).where("pair IS NOT NULL").select(
        "a_cell", "b_cell", "axis", "pair"), "tasm")
    return rounded(audit(series, "pair"), 6, "missing_fraction", "p95", "control_ratio")


@query("boundary_gradient_ratio", _EDGES + """,
m AS (SELECT cell, avg(tas) AS v FROM cube GROUP BY cell),
x AS (SELECT axis, abs(a.v - b.v) AS g, (CASE WHEN axis = 'lon' THEN fj ELSE fi END) % 2 = 1 AS onb
  FROM edges, m a, m b, grid WHERE a.cell = a_cell AND b.cell = b_cell AND axis = 'lon' AND fj < side - 1),
r AS (SELECT quantile_cont(g, 0.5) FILTER (onb) AS a, quantile_cont(g, 0.5) FILTER (NOT onb) AS b FROM x)
SELECT round(a, 6) AS on_median, round(b, 6) AS off_median, round(a / b, 6) AS ratio FROM r""", "cube", "cells")
def boundary_gradient_ratio(spark, d):
    side = grid_side(spark, d)
    means = daily_cube(spark, d, "tas").groupBy("cell").agg(F.avg("tas").alias("v"))
    cells = cell_table(spark, d).join(means, "cell")
    edges = agg.neighbour_edges(cells, side, "fj", "v").where(
        (F.col("axis") == "lon") & (F.col("a_fj") < side - 1))
    steps = edges.select(F.abs(F.col("a_v") - F.col("b_v")).alias("gap"), (F.col("a_fj") % 2 == 1).alias("edge"))
    return rounded(agg.gradient_ratio(steps, "gap", "edge"), 6, "on_median", "off_median", "ratio")


@query("land_gap_summary", """
c AS (SELECT land_share AS s, land_share * cos(radians(lat)) AS area, land AS ok FROM cells),
l AS (SELECT * FROM (VALUES ('any_land', 0.0), ('land_1pct', 0.01), ('land_10pct', 0.1), ('land_50pct', 0.5)) t(lim, t)),
x AS (SELECT lim, area, ok, CASE WHEN t = 0 THEN s > 0 ELSE s >= t::DOUBLE END AS isl FROM c, l)
SELECT lim AS "limit", count(*) FILTER (isl) AS land_cells, count(*) FILTER (isl AND NOT ok) AS missing_cells,
  round(sum(CASE WHEN isl AND NOT ok THEN area ELSE 0 END), 6) AS missing_area,
  round(sum(CASE WHEN isl AND NOT ok THEN area ELSE 0 END) / sum(CASE WHEN isl THEN area END), 6) AS missing_fraction
FROM x GROUP BY lim""", "cells")
def land_gap_summary(spark, d):
    cells = cell_table(spark, d).withColumn("area", F.cos(F.radians("lat")))
    return rounded(agg.land_gap_summary(cells, "land_share", "area", "land"), 6, "missing_area", "missing_fraction")


@query("coverage_counts", """
SELECT count(*) FILTER (land AND tasm IS NULL) AS supported_missing, count(*) FILTER (NOT land AND tasm IS NOT NULL) AS valid_outside,
  count(*) FILTER (land_share > 0.3 AND NOT land) AS land_missing, count(*) FILTER (land) AS supported
FROM cube JOIN (SELECT cell, land, land_share FROM cells) USING (cell)""", "cube", "cells")
def coverage_counts(spark, d):
    cells = cell_table(spark, d).select("cell", "land", (F.col("land_share") > 0.3).alias("mapped"))
    return masks.coverage_counts(daily_cube(spark, d, "tasm").join(cells, "cell"), "tasm", "land", "mapped")


@query("fine_coarse_consistency", """
a AS (SELECT coarse, ord, sum(cos(radians(lat)) * tas) / sum(cos(radians(lat))) AS e, avg(tas) AS t FROM cube GROUP BY ALL)
SELECT count(*) AS compared, round(avg(abs(e - t)), 8) AS mean_error, round(quantile_cont(abs(e - t), 0.99), 8) AS p99_error,
  round(max(abs(e - t)), 8) AS max_error FROM a""", "cube")
def fine_coarse_consistency(spark, d):
    from ..operators.qc import coarse_consistency

    c = daily_cube(spark, d, "tas")
    stored = c.groupBy("coarse", "ord").agg(F.avg("tas").alias("tas"))
    return rounded(coarse_consistency(c, stored, "tas"), 8, "mean_error", "p99_error", "max_error")


@query("temporal_report", """
j AS (SELECT cell, ord, tasm, CASE WHEN ord - lag(ord) OVER w = 1 THEN abs(tasm - lag(tasm) OVER w) END AS jump
  FROM cube WINDOW w AS (PARTITION BY cell ORDER BY ord)),
c AS (SELECT cell, count(tasm) AS n, stddev_pop(tasm) AS s FROM j GROUP BY cell)
SELECT (SELECT count(*) FROM c) AS cells, (SELECT count(*) FROM c WHERE n <> (SELECT count(DISTINCT ord) FROM cube)) AS partial_series,
  (SELECT count(*) FROM c WHERE s = 0) AS constant_series, count(jump) AS jumps, round(avg(jump), 6) AS jump_mean,
  round(quantile_cont(jump, 0.5), 6) AS jump_p50, round(quantile_cont(jump, 0.99), 6) AS jump_p99, max(jump) AS jump_max FROM j""", "cube")
def temporal_report(spark, d):
    from ..operators.qc import temporal_report as report

    c = daily_cube(spark, d, "tasm")
    return rounded(report(c, "tasm", axis_days(c)), 6, "jump_mean", "jump_p50", "jump_p99")


@query("calendar_report", """
y AS (SELECT cell, year, count(*) AS n, count(DISTINCT ord) AS u, max(ord) - min(ord) + 1 AS span,
  count(*) FILTER (month = 2 AND day = 29) AS leap FROM cube GROUP BY cell, year)
SELECT year, min(n) AS fewest, max(n) AS most, bool_and(n = u) AS "unique", bool_and(n = span) AS gapless,
  sum(leap)::BIGINT AS leap_days FROM y GROUP BY year""", "cube")
def calendar_report(spark, d):
    from ..operators.qc import calendar_report as report

    return report(daily_cube(spark, d, "tas"))


@query("seam_ratio", """
p AS (SELECT ord, fi, pr + 1 AS v, ((fj - 0) % side + side) % side AS place FROM cube, grid WHERE lat BETWEEN -50 AND 50),
w AS (SELECT ord, fi, max(v) FILTER (place = 0) AS v0, max(v) FILTER (place = 1) AS v1, max(v) FILTER (place = 2) AS v2,
  max(v) FILTER (place = 3) AS v3 FROM p WHERE place < 4 GROUP BY ord, fi),
x AS (SELECT ord, avg(abs(v1 - v2)) AS s, 0.5 * (avg(abs(v0 - v1)) + avg(abs(v2 - v3))) AS b, 0.5 * (avg(v1) + avg(v2)) AS r
  FROM w WHERE v0 + v1 + v2 + v3 IS NOT NULL GROUP BY ord)
SELECT ord, round(s, 6) AS seam_mean, round(b, 6) AS beside_mean, round(CASE WHEN r >= 1 THEN s / (b + 0.01) END, 6) AS ratio FROM x""",
       "cube")
def seam_ratio(spark, d):
    c = daily_cube(spark, d, "pr").withColumn("v", F.col("pr") + 1)
    out = agg.seam_diagnostics(c, "v", 2, grid_side(spark, d), -50.0, 50.0)
    return rounded(out, 6, "seam_mean", "beside_mean", "ratio")


@query("wet_land_fraction", """
SELECT ord, round(count(*) FILTER (pr >= 1)::DOUBLE / count(pr), 8) AS wet_fraction FROM cube JOIN (SELECT cell FROM cells WHERE land) USING (cell) GROUP BY ord""",
       "cube", "cells")
def wet_land_fraction(spark, d):
    land = cell_table(spark, d).where("land").select("cell")
    return daily_cube(spark, d, "pr").join(land, "cell", "left_semi").groupBy("ord").agg(
        F.round(F.try_divide(F.count_if(F.col("pr") >= 1), F.count("pr")), 8).alias("wet_fraction"))


@query("mean_annual_total", """
SELECT cell, round(sum(CASE WHEN tasm IS NOT NULL THEN pr END) / (SELECT count(DISTINCT year) FROM cube), 6) AS total FROM cube GROUP BY cell""",
       "cube")
def mean_annual_total(spark, d):
    """Annual totals need one valid day; a cell without any stays missing."""
    c = daily_cube(spark, d, "tasm", "pr")
    years = scalar_row(c.agg(F.count_distinct("year").alias("n")))["n"]
    return c.groupBy("cell").agg(
        F.round(F.sum(F.when(F.col("tasm").isNotNull(), F.col("pr"))) / years, 6).alias("total"))


@query("edge_comparison", """
j AS (SELECT abs(a.tasm - b.tas) AS now, abs(a.tas * 0.5 + b.tas * 0.5 - b.tas) AS then_
  FROM cube a, grid, cube b WHERE a.ord = b.ord AND (b.fi = a.fi + 1 AND b.fj = a.fj OR b.fi = a.fi AND b.fj = (a.fj + 1) % side)),
s AS (SELECT count(*) FILTER (now IS NOT NULL AND then_ IS NOT NULL) AS pairs, count(*) FILTER (then_ < now) AS better,
  quantile_cont(now, 0.95) AS a, quantile_cont(then_, 0.95) AS b FROM j)
SELECT pairs, round(better / pairs, 6) AS improved, round(a, 6) AS p95_now, round(b, 6) AS p95_then,
  round(b - a, 6) AS p95_change, round(100 * (b / a - 1), 6) AS p95_percent_change FROM s""", "cube")
def edge_comparison(spark, d):
    """Across the edges between neighbouring cells: would the mean of both sides join more smoothly?"""
    c = daily_cube(spark, d, "tas", "tasm")
    edges = agg.neighbour_edges(cell_table(spark, d).select("cell", "fi", "fj"), grid_side(spark, d)).select("a_cell", "b_cell")
    own = c.select(F.col("cell").alias("a_cell"), "ord", "tas", "tasm")
    other = c.select(F.col("cell").alias("b_cell"), "ord", F.col("tas").alias("n"))
    joined = edges.join(own, "a_cell").join(other, ["b_cell", "ord"]).withColumn("alt", F.col("tas") * 0.5 + F.col("n") * 0.5)
    return rounded(agg.edge_comparison(joined, "tasm", "alt", "n"), 6, "improved", "p95_now", "p95_then", "p95_change", "p95_percent_change")


@query("source_code_counts", "SELECT code, count(*) AS cells FROM cells GROUP BY code", "cells")
def source_code_counts(spark, d):
    return cell_table(spark, d).groupBy("code").agg(F.count(F.lit(1)).alias("cells"))


@query("active_cell_bookkeeping", """
m AS (SELECT ci, count(*) FILTER (land) AS expected FROM cells GROUP BY ci),
a AS (SELECT ci, count(DISTINCT cell) FILTER (tasm IS NOT NULL) AS active FROM cube GROUP BY ci)
SELECT ci, expected, coalesce(active, 0)::BIGINT AS active, expected = coalesce(active, 0) AS matches FROM m LEFT JOIN a USING (ci)""",
       "cube", "cells")
def active_cell_bookkeeping(spark, d):
    expected = cell_table(spark, d).groupBy("ci").agg(F.count_if("land").alias("expected"))
    per_cell = daily_cube(spark, d, "tasm").groupBy("ci", "cell").agg(F.count("tasm").alias("n"))
    active = per_cell.groupBy("ci").agg(F.count_if(F.col("n") > 0).alias("active"))
    return expected.join(active, "ci", "left").select(
        "ci", "expected", F.coalesce("active", F.lit(0)).alias("active"),
        (F.col("expected") == F.coalesce("active", F.lit(0))).alias("matches"))


@query("rolling_season_mean", """
SELECT cell, ord, round(CASE WHEN count(*) OVER w = 90 THEN sum(coalesce(tasm - 260, 0)) OVER w / 90 END, 6) AS season
FROM cube WINDOW w AS (PARTITION BY cell ORDER BY ord ROWS BETWEEN 45 PRECEDING AND 44 FOLLOWING)""", "cube")
def rolling_season_mean(spark, d):
    season = windows.rolling_season_mean(F.col("tasm") - 260, ["cell"])
    return daily_cube(spark, d, "tasm").select("cell", "ord", F.round(season, 6).alias("season"))


_LEAST_DAYS = 285
_YEARLY = f"""y AS (SELECT cell, year, CASE WHEN count(tas) >= {_LEAST_DAYS} THEN avg(tas) END AS v FROM cube GROUP BY ALL)"""


def _yearly(spark, d):
    """The mean over all days of each year; missing where a cell has fewer than 285 of them."""
    return daily_cube(spark, d, "tas").groupBy("cell", "year").agg(
        F.when(F.count("tas") >= _LEAST_DAYS, F.avg("tas")).alias("v"))


@query("gap_aware_five_year_mean", _YEARLY + """,
g AS (SELECT *, year - row_number() OVER (PARTITION BY cell ORDER BY year) AS island FROM y)
SELECT cell, year, round(CASE WHEN count(v) OVER w >= 3 THEN avg(v) OVER w END, 6) AS smooth FROM g
WINDOW w AS (PARTITION BY cell, island ORDER BY year ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""", "cube")
def gap_aware_five_year_mean(spark, d):
    out = windows.gap_aware_mean(_yearly(spark, d), ["cell"], "year", "v").select("cell", "year", "smooth")
    return rounded(out, 6, "smooth")


@query("year_densify", _YEARLY + """,
s AS (SELECT cell, min(year) AS a, max(year) AS b FROM y GROUP BY cell)
SELECT s.cell, t.year, round(y.v, 6) AS v FROM s, LATERAL (SELECT unnest(range(a, b + 1)) AS year) t
LEFT JOIN y ON y.cell = s.cell AND y.year = t.year""", "cube")
def year_densify(spark, d):
    return rounded(windows.year_axis(_yearly(spark, d), ["cell"]), 6, "v")


@query("adjacent_change", """
SELECT cell, ord, round(CASE WHEN ord - lag(ord) OVER w = 1 THEN tasm - lag(tasm) OVER w END, 6) AS change FROM cube
WINDOW w AS (PARTITION BY cell ORDER BY ord)""", "cube")
def adjacent_change(spark, d):
    out = windows.adjacent_change(daily_cube(spark, d, "tasm"), "cell", "tasm").select("cell", "ord", "change")
    return rounded(out, 6, "change")


@query("trend_per_decade", """
SELECT cell, round(CASE WHEN count(v) >= 2 THEN regr_slope(v, year) * 10 END, 6) AS trend
FROM (SELECT cell, year, avg(tas) AS v FROM cube GROUP BY ALL) GROUP BY cell""", "cube")
def trend_per_decade(spark, d):
    yearly = daily_cube(spark, d, "tas").groupBy("cell", "year").agg(F.avg("tas").alias("v"))
    return yearly.groupBy("cell").agg(F.round(windows.trend_per_decade(F.col("v"), F.col("year")), 6).alias("trend"))


@query("first_day_of_year", """
SELECT cell, year, min(ord) AS first_ord, arg_min(month, ord) AS month, arg_min(day, ord) AS day FROM cube GROUP BY cell, year""", "cube")
def first_day_of_year(spark, d):
    return windows.first_day_of_year(daily_cube(spark, d, "tas"), ["cell"])


@query("doy_window_quantiles", """
b AS (SELECT cell, min(ord) AS lo, max(ord) AS hi FROM cube GROUP BY cell),
x AS (SELECT c.cell, ((c.doy - 1 + k) % 365 + 365) % 365 + 1 AS doy, tasm FROM cube c JOIN b USING (cell),
  (SELECT unnest(range(-15, 16)) AS k) WHERE tasm IS NOT NULL AND c.ord + k BETWEEN lo AND hi)
SELECT cell, doy, count(*) AS n, round(quantile_cont(tasm, 0.1), 6) AS q10, round(quantile_cont(tasm, 0.5), 6) AS q50,
  round(quantile_cont(tasm, 0.9), 6) AS q90 FROM x WHERE (cell, doy) IN (SELECT cell, doy FROM cube) GROUP BY cell, doy""", "cube")
def doy_window_quantiles(spark, d):
    w = circular_day_windows(daily_cube(spark, d, "tasm"), ["cell"], "tasm", 15)
    q = sorted_array_quantiles(F.col("values"), [0.1, 0.5, 0.9])
    return w.select("cell", "doy", F.size("values").alias("n"), q.alias("q")).select(
        "cell", "doy", "n", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q10", "q50", "q90"))])


_AUDITED = {"tas": (150.0, 350.0), "hurs": (0.0, 100.0), "pr": (0.0, 3000.0), "wind": (0.0, 90.0), "tasrange": (0.0, 60.0), "ps": (30000.0, 104800.0)}
_AUDIT_RANKS = (0.01, 0.05, 0.5, 0.95, 0.99)


@query("reference_audit", f"""
l AS (UNPIVOT (SELECT tas, hurs, pr, wind, tasrange, ps FROM roles WHERE role = 'ref') ON tas, hurs, pr, wind, tasrange, ps INTO NAME variable VALUE v),
b(variable, low, high) AS (VALUES {", ".join(f"('{n}', {a}::DOUBLE, {b}::DOUBLE)" for n, (a, b) in _AUDITED.items())})
SELECT variable, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS deviation, min(v) AS minimum, max(v) AS maximum,
  {", ".join(f"round(quantile_cont(v, {p}), 6) AS p{round(p * 100)}" for p in _AUDIT_RANKS)}, count(*) FILTER (v < low OR v > high) AS outside
FROM l JOIN b USING (variable) GROUP BY variable""", "roles")
def reference_audit(spark, d):
    """One row per reference variable: moments, extremes, quantiles and values outside the audit bounds."""
    from ..operators.qc import reference_audit as audit
    from ..sources.cube import role_series

    out = audit(role_series(spark, d, "ref", *_AUDITED), _AUDITED, list(_AUDIT_RANKS))
    return rounded(out, 6, "mean", "deviation", *[f"p{round(p * 100)}" for p in _AUDIT_RANKS])
