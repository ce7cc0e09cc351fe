"""Queries over humidity adjustment, downscaling and fire weather."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.presets import VARIABLES
from ..operators import downscale as ds
from ..operators import fireweather as fw
from ..operators import humidity, indicators, masks, packing
from ..operators.regrid import Axis
from ..session import shared_directory
from ..sources.cube import cell_table, daily_cube, grid_side, role_series, table, with_cell_keys
from ..streaming import fire_season
from .adjust_queries import series
from .registry import query, rounded
from .spatial_queries import OVERLAP_SQL


@query("bounded_humidity")
def bounded_humidity(spark, d):
    """Seeded NumPy draws have no SQL counterpart; golden vectors cover the kernel."""
    r, h, s = series(spark, d, "hurs")
    return rounded(humidity.adjust_humidity(r, h, s, "hurs"), 6, "adjusted")

def _list_quantile(values: str, p: str) -> str:
    """Linear quantile of a sorted list; an interval's right end never passes the last value."""
    x = f"(({p}) * (len({values}) - 1))"
    return f"({values}[floor({x})::BIGINT + 1] + ({x} - floor({x})) * ({values}[least(len({values}), floor({x})::BIGINT + 2)] - {values}[floor({x})::BIGINT + 1]))"


def _knot(values: str, table: str) -> str:
    """1-based left knot of a value in an ordered list."""
    return f"greatest(1, least(len({table}) - 1, len(list_filter({table}, lambda q: q <= {values}))))::BIGINT"


_SHARE = "greatest(0, least(1, CASE WHEN {t}[{j} + 1] > {t}[{j}] THEN ({v} - {t}[{j}]) / ({t}[{j} + 1] - {t}[{j}]) ELSE ({v} >= {t}[{j} + 1])::INT END))"


@query("bounded_humidity_inner", f"""
s AS (SELECT role, cell, ord, doy, 5 + 0.9::DOUBLE * hurs AS v FROM roles),
c AS (SELECT DISTINCT cell, doy AS centre FROM s WHERE role = 'sim' AND cell IN (SELECT cell FROM s GROUP BY cell HAVING count(DISTINCT role) = 3)),
w AS (SELECT c.cell, centre, role, ord, doy, v FROM c JOIN s ON s.cell = c.cell AND least(abs(doy - centre), 365 - abs(doy - centre)) <= 15),
l AS (SELECT cell, centre, list(v ORDER BY v) FILTER (role = 'ref') AS ol, list(v ORDER BY v) FILTER (role = 'hist') AS pl,
  list(v ORDER BY v) FILTER (role = 'sim') AS fl FROM w GROUP BY ALL),
n AS (SELECT *, least(51, len(ol), len(pl), len(fl)) AS n FROM l WHERE len(ol) > 0 AND len(pl) > 0),
t AS (SELECT *, list_transform(range(n), lambda i: {_list_quantile('ol', 'CASE WHEN i = n - 1 THEN 1 ELSE i * (1::DOUBLE / (n - 1)) END')}) AS oq,
  list_transform(range(n), lambda i: {_list_quantile('pl', 'CASE WHEN i = n - 1 THEN 1 ELSE i * (1::DOUBLE / (n - 1)) END')}) AS pq,
  list_transform(range(n), lambda i: {_list_quantile('fl', 'CASE WHEN i = n - 1 THEN 1 ELSE i * (1::DOUBLE / (n - 1)) END')}) AS fq FROM n),
k AS (SELECT cell, centre, n, oq, pq, fq, v, {_knot('v', 'oq')} AS j FROM (SELECT cell, centre, n, oq, pq, fq, unnest(ol) AS v FROM t)),
h AS (SELECT *, {_SHARE.format(t='oq', j='j', v='v')} AS share FROM k),
x AS (SELECT cell, centre, v, n, oq[j] + share * (oq[j + 1] - oq[j]) AS o, pq[j] + share * (pq[j + 1] - pq[j]) AS p, fq[j] + share * (fq[j + 1] - fq[j]) AS f FROM h),
g AS (SELECT cell, centre, list(moved ORDER BY moved) AS goal FROM (SELECT cell, centre, greatest(0, least(100, CASE
    WHEN n < 2 THEN v WHEN p = o THEN f WHEN p < o AND f < p THEN o + f - p WHEN p < o THEN 100 - (100 - o) * (100 - f) / (100 - p) WHEN f > p THEN o + f - p
    ELSE o * f / p END)) AS moved FROM x) WHERE moved > 0.01 AND moved < 99.99 GROUP BY ALL),
m AS (SELECT t.cell, t.centre, list_transform(range(51), lambda i: {_list_quantile('fl', 'CASE WHEN i = 50 THEN 1 ELSE i * (1::DOUBLE / 50) END')}) AS source,
  list_transform(range(51), lambda i: {_list_quantile('goal', 'CASE WHEN i = 50 THEN 1 ELSE i * (1::DOUBLE / 50) END')}) AS target FROM t JOIN g USING (cell, centre)),
a AS (SELECT s.cell, s.ord, s.v, source, target, {_knot('s.v', 'source')} AS j FROM s JOIN m ON m.cell = s.cell AND m.centre = s.doy WHERE s.role = 'sim'),
b AS (SELECT cell, ord, target[j] + {_SHARE.format(t='source', j='j', v='v')} * (target[j + 1] - target[j]) AS r FROM a)
SELECT cell, ord, round(CASE WHEN r <= 0.01 THEN 0 WHEN r >= 99.99 THEN 100 ELSE r END, 9) AS adjusted FROM b""", "roles")
def bounded_humidity_inner(spark, d):
    """Humidity kept clear of both bounds: nothing is drawn, so every adjusted value has its SQL."""
    inner = [df.withColumn("hurs", 5 + 0.9 * F.col("hurs")) for df in series(spark, d, "hurs")]
    return rounded(humidity.adjust_humidity(*inner, "hurs").where("adjusted IS NOT NULL"), 9, "adjusted")


def _downscaled(spark, d, value: str, variable: str):
    side = grid_side(spark, d)
    half = side // 2
    observations = role_series(spark, d, "ref", value)
    coarse = role_series(spark, d, "sim", value).groupBy("ci", "cj", "ord", "month").agg(F.avg(value).alias(value))
    preset = VARIABLES[variable].in_unit("mm d-1" if variable == "pr" else None)  # the cube holds daily sums
    fine = ds.downscale(observations, coarse, value, Axis(-60.0 + 60.0 / side, 120.0 / side, side), half, half, 2,
                        preset.downscale_bounds, all_invalid_value=preset.all_invalid_value)
    return fine.select((F.col("fi") * side + F.col("fj")).alias("cell"), "ord", value)


@query("mbcnsd_temperature")
def mbcnsd_temperature(spark, d):
    return rounded(_downscaled(spark, d, "tas", "tas"), 6, "tas")


@query("mbcnsd_precipitation")
def mbcnsd_precipitation(spark, d):
    return rounded(_downscaled(spark, d, "pr", "pr"), 6, "pr")


@query("mbcnsd_controlled")
def mbcnsd_controlled(spark, d):
    """Downscaled temperature with value controls and the land mask."""
    fine = masks.value_controls(_downscaled(spark, d, "tas", "tas"))
    land = cell_table(spark, d).select("cell", F.col("land").alias("support"))
    return rounded(masks.apply_support(fine, land, "tas").select("cell", "ord", "tas"), 6, "tas")


_COVER_SQL = """
w AS (SELECT coarse, count(DISTINCT cell) AS active FROM roles WHERE role = 'ref' GROUP BY ALL),
s AS (SELECT coarse, month, count(DISTINCT ord) AS days FROM roles WHERE role = 'sim' GROUP BY ALL)
SELECT coarse, month, days, 4 * days AS "values", (4 - active) * days AS missing, 0::BIGINT AS outside
FROM s JOIN w USING (coarse)"""


def _coverage(spark, d, value: str, variable: str, low: float, high: float):
    """Per coarse cell and month of the downscaled field: days, values, missing and impossible ones."""
    side = grid_side(spark, d)
    fine = _downscaled(spark, d, value, variable).withColumn("month", cal.month_of_doy(F.pmod("ord", F.lit(365)) + 1))
    coarse = F.expr(f"cell div {side} div 2 * {side // 2} + cell % {side} div 2")
    return fine.groupBy(coarse.alias("coarse"), "month").agg(
        F.count_distinct("ord").alias("days"), F.count(F.lit(1)).alias("values"), F.count_if(F.col(value).isNull()).alias("missing"),
        F.count_if((F.col(value) < low) | (F.col(value) > high)).alias("outside"))


@query("mbcnsd_temperature_coverage", _COVER_SQL, "roles")
def mbcnsd_temperature_coverage(spark, d):
    """Every simulated day of every active cell is filled, within the variable's limits."""
    return _coverage(spark, d, "tas", "tas", 150.0, 350.0)


@query("mbcnsd_precipitation_coverage", _COVER_SQL, "roles")
def mbcnsd_precipitation_coverage(spark, d):
    return _coverage(spark, d, "pr", "pr", 0.0, 3000.0)


@query("bounded_humidity_coverage", """
r AS (SELECT cell FROM roles GROUP BY cell HAVING count(DISTINCT role) = 3)
SELECT cell, count(*) AS days, count(*) FILTER (cell NOT IN (SELECT cell FROM r)) AS missing, 0::BIGINT AS outside
FROM roles WHERE role = 'sim' GROUP BY cell""", "roles")
def bounded_humidity_coverage(spark, d):
    """Per cell: simulated days, days left unadjusted, values outside 0..100 percent or between a bound and its threshold."""
    r, h, s = series(spark, d, "hurs")
    v = F.col("adjusted")
    outside = (v < humidity.LOW) | (v > humidity.HIGH) | ((v > humidity.LOW) & (v <= humidity.LOW_EDGE)) | (
        (v < humidity.HIGH) & (v >= humidity.HIGH_EDGE))
    return humidity.adjust_humidity(r, h, s, "hurs").groupBy("cell").agg(
        F.count(F.lit(1)).alias("days"), F.count_if(v.isNull()).alias("missing"), F.count_if(outside).alias("outside"))


_LE = "[" + ", ".join("[" + ", ".join(map(str, row)) + "]" for row in fw.DAY_LENGTH.tolist()) + "]::DOUBLE[][]"
_LF = "[" + ", ".join("[" + ", ".join(map(str, row)) + "]" for row in fw.DRYING.tolist()) + "]::DOUBLE[][]"

_WEATHER = f"""w AS MATERIALIZED (
  SELECT *, min(t) OVER back > 12 AS warm, max(t) OVER back < 5 AS cold FROM (
    SELECT cell, row_number() OVER (PARTITION BY cell ORDER BY ord) AS n, ord, tas - 273.15::DOUBLE AS t, pr AS x,
      wind * 3.6::DOUBLE AS w, hurs AS h,
      ({_LE})[CASE WHEN lat < -30 THEN 1 WHEN lat < -15 THEN 2 WHEN lat < 15 THEN 3 WHEN lat < 30 THEN 4 ELSE 5 END][month] AS le,
      ({_LF})[CASE WHEN lat < -15 THEN 1 WHEN lat < 15 THEN 2 ELSE 3 END][month] AS lf
    FROM cube)
  WINDOW back AS (PARTITION BY cell ORDER BY n ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""


def _day_step(inner: str) -> str:
    """One day of the three codes: adds f3, p3, d3 to rows with yesterday's f, p, d and today's weather."""
    return f"""(
  SELECT *, greatest(0, least(101, 59.5 * (250 - m3) / (147.2 + m3))) AS f3,
    greatest(0, p2 + CASE WHEN t < -1.1 THEN 0 ELSE 1.894 * (t + 1.1) * (100 - h) * le * 0.0001 END) AS p3,
    d2 + greatest(0, (0.36 * (greatest(t, -2.8) + 2.8) + lf) / 2) AS d3
  FROM (
    SELECT *, CASE WHEN m2 > ed THEN ed + (m2 - ed) * power(10, -kd) WHEN m2 < ed AND m2 < ew THEN ew - (ew - m2) * power(10, -kw) ELSE m2 END AS m3,
      CASE WHEN x > 1.5 THEN greatest(0, 43.43 * (5.6348 - ln(20 + 280 / exp(0.023 * p) + 1000 * (0.92 * x - 1.27)
        / (48.77 + b * (0.92 * x - 1.27)) - 20))) ELSE p END AS p2,
      CASE WHEN x > 2.8 THEN greatest(0, d - 400 * ln(1 + 3.937 * (0.83 * x - 1.27) / (800 * exp(-d / 400)))) ELSE d END AS d2
    FROM (
      SELECT *, CASE WHEN x > 0.5 THEN least(250, m + 42.5 * (x - 0.5) * exp(-100 / (251 - m)) * (1 - exp(-6.93 / (x - 0.5)))
          + CASE WHEN m > 150 THEN 0.0015 * power(m - 150, 2) * sqrt(x - 0.5) ELSE 0 END) ELSE m END AS m2,
        0.942 * power(h, 0.679) + 11 * exp((h - 100) / 10) + 0.18 * (21.1 - t) * (1 - exp(-0.115 * h)) AS ed,
        0.618 * power(h, 0.753) + 10 * exp((h - 100) / 10) + 0.18 * (21.1 - t) * (1 - exp(-0.115 * h)) AS ew,
        (0.424 * (1 - power(h / 100, 1.7)) + 0.0694 * sqrt(w) * (1 - power(h / 100, 8))) * 0.581 * exp(0.0365 * t) AS kd,
        (0.424 * (1 - power((100 - h) / 100, 1.7)) + 0.0694 * sqrt(w) * (1 - power((100 - h) / 100, 8))) * 0.581 * exp(0.0365 * t) AS kw,
        CASE WHEN p <= 33 THEN 100 / (0.5 + 0.3 * p) WHEN p <= 65 THEN 14 - 1.3 * ln(p) ELSE 6.2 * ln(p) - 17.2 END AS b
      FROM (SELECT *, 147.2 * (101 - f) / (59.5 + f) AS m FROM {inner}))))"""


_WALK = _WEATHER + """,
r(cell, n, ord, w, f, p, d) AS (
  SELECT DISTINCT cell, 0::BIGINT, 0::BIGINT, 0::DOUBLE, 85::DOUBLE, 6::DOUBLE, 15::DOUBLE FROM w
  UNION ALL
  SELECT cell, n, ord, w, f3, p3, d3 FROM """ + _day_step(
    "(SELECT w.*, r.f, r.p, r.d FROM r JOIN w ON w.cell = r.cell AND w.n = r.n + 1)") + ")"

# Three warm days start a season, three cold days end it, the drought code overwinters,
# and cells without any season take the walk above.
_SEASON = _WALK + """,
z0(cell, n, ord, w, act, f, p, d, au, wp) AS (
  SELECT DISTINCT cell, 0::BIGINT, 0::BIGINT, 0::DOUBLE, FALSE, 85::DOUBLE, 6::DOUBLE, 15::DOUBLE, NULL::DOUBLE, 0::DOUBLE FROM w
  UNION ALL
  SELECT cell, n, ord, w, act, CASE WHEN act THEN f3 ELSE f END, CASE WHEN act THEN p3 ELSE p END, CASE WHEN act THEN d3 ELSE d END,
    CASE WHEN was AND NOT act THEN d WHEN act AND NOT was THEN NULL ELSE au END,
    CASE WHEN was AND NOT act THEN x WHEN NOT act THEN wp + x ELSE wp END
  FROM """ + _day_step("""(
    SELECT * EXCLUDE (f, p, d), CASE WHEN act AND NOT was THEN 85 ELSE f END AS f, CASE WHEN act AND NOT was THEN 6 ELSE p END AS p,
      CASE WHEN act AND NOT was THEN coalesce(greatest(400 * ln(800 / (0.75 * 800 * exp(-au / 400) + 0.75 * 3.94 * wp)), 15), 15) ELSE d END AS d
    FROM (SELECT w.*, z0.act AS was, w.n >= 4 AND (z0.act OR w.warm) AND NOT w.cold AS act, z0.f, z0.p, z0.d, z0.au, z0.wp
      FROM z0 JOIN w ON w.cell = z0.cell AND w.n = z0.n + 1))""") + """),
ever AS (SELECT cell, bool_or(act) AS ever FROM z0 GROUP BY cell),
codes AS (
  SELECT cell, ord, w, FALSE AS always_on, CASE WHEN act THEN f END AS f, CASE WHEN act THEN p END AS p, CASE WHEN act THEN d END AS d
  FROM z0 JOIN ever USING (cell) WHERE n > 0 AND ever
  UNION ALL SELECT cell, ord, w, TRUE, f, p, d FROM r JOIN ever USING (cell) WHERE n > 0 AND NOT ever)"""

_FINAL = """,
i AS (SELECT *, 19.1152 * exp(147.2 * (101 - f) / (59.5 + f) * -0.1386) * (1 + power(147.2 * (101 - f) / (59.5 + f), 5.31) / 49300000) * exp(0.05039 * w) AS isi,
  CASE WHEN p IS NOT NULL THEN greatest(0, CASE WHEN p + 0.4 * d = 0 THEN 0 WHEN p <= 0.4 * d THEN 0.8 * d * p / (p + 0.4 * d)
    ELSE p - (1 - 0.8 * d / (p + 0.4 * d)) * (0.92 + power(0.0114 * p, 1.7)) END) END AS bui FROM codes),
z AS (SELECT *, 0.1 * isi * CASE WHEN bui <= 80 THEN 0.626 * power(bui, 0.809) + 2 ELSE 1000 / (25 + 108.64 / exp(0.023 * bui)) END AS bb FROM i),
fire AS (SELECT cell, ord, always_on, f AS ffmc, p AS dmc, d AS dc, isi, bui,
  CASE WHEN bb <= 1 THEN bb ELSE exp(2.72 * power(0.434 * ln(bb), 0.647)) END AS fwi FROM z)"""

_ROUNDED = ", ".join(f"round({n}, 4) AS {n}" for n in ("ffmc", "dmc", "dc", "isi", "bui", "fwi"))
_ALWAYS = _WALK + ",\ncodes AS (SELECT cell, ord, w, TRUE AS always_on, f, p, d FROM r WHERE n > 0)" + _FINAL
_DAILY = _SEASON + _FINAL

_INDICES = ("ffmc", "dmc", "dc", "isi", "bui", "fwi")


def _weather(spark, d):
    return daily_cube(spark, d, "tas", "hurs", "pr", "wind")


@query("cffwis_always_on", _ALWAYS + f"SELECT cell, ord, {_ROUNDED} FROM fire", "cube", recursive=True)
def cffwis_always_on(spark, d):
    out = fw.daily_fire_weather(_weather(spark, d), seasonal=False)
    return rounded(out.select("cell", "ord", *_INDICES), 4, *_INDICES)


@query("cffwis_daily", _DAILY + f"SELECT cell, ord, always_on, {_ROUNDED} FROM fire", "cube", recursive=True)
def cffwis_daily(spark, d):
    """With season handling and overwintering; kernels are tested on published values."""
    out = fw.daily_fire_weather(_weather(spark, d))
    return rounded(out.select("cell", "ord", "always_on", *_INDICES), 4, *_INDICES)


@query("cffwis_streamed", _DAILY + f"SELECT cell, ord, always_on, {_ROUNDED} FROM fire", "cube", recursive=True)
def cffwis_streamed(spark, d):
    """The same indices from a stream that gets one year at a time and is started anew for each."""
    root = f"{shared_directory(spark)}/fire-stream-{uuid.uuid4().hex}"
    columns = ["cell", "ord", "month", "lat", "tas", "hurs", "pr", "wind"]
    _weather(spark, d).select("year", *columns).write.partitionBy("year").parquet(f"{root}/years")
    years = spark.read.parquet(f"{root}/years")
    for row in years.select("year").distinct().orderBy("year").collect():
        years.where(F.col("year") == row["year"]).select(*columns).write.mode("append").parquet(f"{root}/incoming")
        fire_season.start(spark, f"{root}/incoming", f"{root}/codes", f"{root}/checkpoint").awaitTermination()
    out = fire_season.settled(spark.read.parquet(f"{root}/codes"))
    return rounded(out.select("cell", "ord", "always_on", *_INDICES), 4, *_INDICES)


@query("cffwis_history_continuity", _DAILY + f"SELECT cell, ord, always_on, {_ROUNDED} FROM fire WHERE ord >= 29 * 365",
       "cube", recursive=True)
def cffwis_history_continuity(spark, d):
    """Projection years only, but with the history in front of them."""
    out = fw.daily_fire_weather(_weather(spark, d)).where(F.col("ord") >= (1999 - 1970) * 365)
    return rounded(out.select("cell", "ord", "always_on", *_INDICES), 4, *_INDICES)


@query("annual_fwi_end_to_end", _DAILY + """,
s AS (SELECT cell, ord, 1970 + ord // 365 AS year, CASE WHEN ord < 29 * 365 THEN 'history' ELSE 'future' END AS period, land,
  round(CASE WHEN land THEN fwi END, 6) AS v FROM fire JOIN (SELECT cell, land FROM cells) USING (cell)),
lim AS (SELECT cell, quantile_cont(v, 0.95) AS q, (min(v) + max(v)) / 2 AS m FROM s WHERE year BETWEEN 1995 AND 1998 GROUP BY cell),
l2 AS (SELECT cell, round(CASE WHEN land THEN coalesce(q, 0) ELSE q END, 6) AS q, round(CASE WHEN land THEN coalesce(m, 0) ELSE m END, 6) AS m
  FROM (SELECT cell, land FROM cells) LEFT JOIN lim USING (cell)),
k AS (SELECT *, CASE WHEN count(*) OVER b = 90 THEN sum(coalesce(v, 0)) OVER b / 90 END AS season FROM s
  WINDOW b AS (PARTITION BY cell, period ORDER BY ord ROWS BETWEEN 45 PRECEDING AND 44 FOLLOWING)),
y AS (SELECT cell, period, year, any_value(land) AS land, count(v) AS n, max(v) AS a, count(*) FILTER (v > q) AS b, count(*) FILTER (v > m) AS c, max(season) AS e
  FROM k LEFT JOIN l2 USING (cell) GROUP BY ALL)
SELECT cell, period, year, round(CASE WHEN land THEN coalesce(a, 0) END, 4) AS fwixx,
  CASE WHEN land THEN CASE WHEN n > 0 THEN b ELSE 0 END::DOUBLE END AS fwixd, CASE WHEN land THEN CASE WHEN n > 0 THEN c ELSE 0 END::DOUBLE END AS fwils,
  round(CASE WHEN land THEN CASE WHEN n > 0 THEN coalesce(e, 0) ELSE 0 END END, 4) AS fwisa FROM y""", "cube", "cells", recursive=True)
def annual_fwi_end_to_end(spark, d):
    """Daily index, reference thresholds and annual indicators on supported land, gaps as 0."""
    daily = fw.daily_fire_weather(_weather(spark, d)).select("cell", "ord", "fwi")
    daily = daily.withColumn("year", (F.floor(F.col("ord") / 365) + 1970).cast("bigint"))
    support = cell_table(spark, d).select("cell", F.col("land").alias("support"))
    daily = masks.apply_support(daily, support, "fwi").withColumn("fwi", F.round("fwi", 6))
    period = F.when(F.col("year") <= 1998, "history").otherwise("future")
    daily = daily.withColumn("period", period)
    limits = indicators.season_thresholds(daily.where("year BETWEEN 1995 AND 1998"), "fwi", support)
    limits = limits.withColumns({n: F.round(n, 6) for n in ("q95", "midrange")})
    annual = indicators.annual_season_indicators(daily, "fwi", limits, ("cell", "period"))
    filled = annual.join(support, "cell").withColumns({
        n: masks.fill_inside(F.col(n).cast("double"), F.col("support")) for n in ("fwixx", "fwixd", "fwils", "fwisa")})
    return rounded(filled.drop("support"), 4, "fwixx", "fwisa")


@query("fire_weather_report", _DAILY + """,
p AS (SELECT cell, count(ffmc) AS a, count(dmc) AS b, count(dc) AS c, count(isi) AS e, count(bui) AS g, count(fwi) AS h,
  least(min(ffmc), min(dmc), min(dc), min(isi), min(bui), min(fwi)) AS low FROM fire GROUP BY cell)
SELECT count(*) FILTER (least(coalesce(a, 0), coalesce(b, 0), coalesce(c, 0), coalesce(e, 0), coalesce(g, 0), coalesce(h, 0)) = 0) AS cells_without_value,
  round(min(low), 6) AS minimum, FALSE AS has_infinite,
  count(*) FILTER (least(coalesce(a, 0), coalesce(b, 0), coalesce(c, 0), coalesce(e, 0), coalesce(g, 0), coalesce(h, 0)) = 0) = 0 AND min(low) >= -1e-9 AS valid
FROM (SELECT cell FROM cells WHERE land) LEFT JOIN p USING (cell)""", "cube", "cells", recursive=True)
def fire_weather_report(spark, d):
    support = cell_table(spark, d).select("cell", F.col("land").alias("support"))
    return rounded(fw.fire_report(fw.daily_fire_weather(_weather(spark, d)), support), 6, "minimum")


@query("downscale_end_to_end")
def downscale_end_to_end(spark, d):
    """Adjust the coarse simulation, downscale it, control values and mask: the whole chain."""
    from .pipeline import adjust_and_downscale

    side = grid_side(spark, d)
    fine = (Axis(-60.0 + 60.0 / side, 120.0 / side, side), Axis(180.0 / side, 360.0 / side, side, True))

    def coarse(role):
        return role_series(spark, d, role, "tas").groupBy("ci", "cj", "ord", "doy", "month").agg(F.avg("tas").alias("tas"))

    _, spread = adjust_and_downscale(
        role_series(spark, d, "ref", "tas"), coarse("hist"), coarse("sim"), "tas", "tas", fine, side // 2, side // 2, 2)
    land = cell_table(spark, d).select("cell", F.col("land").alias("support"))
    out = masks.apply_support(masks.value_controls(spread), land, "tas")
    return rounded(out.select("cell", "ord", "tas"), 5, "tas")


@query("preprocess_end_to_end", OVERLAP_SQL + """,
raw AS (SELECT (l_partkey % (side * side)) // side AS fi, l_partkey % side AS fj, CAST(l_shipdate AS DATE) AS dt,
  sum(round(l_tax * 100)::BIGINT)::DOUBLE / count(*) / 86400 AS v FROM lineitem, grid GROUP BY ALL),
nl AS (SELECT ti, count(*) AS a FROM lw GROUP BY ti), no AS (SELECT tj, count(*) AS b FROM ow GROUP BY tj),
reg AS (SELECT ti, tj, dt, CASE WHEN count(v) = any_value(a * b) THEN sum(lw.w * ow.w * v) / sum(lw.w * ow.w) END AS v
  FROM raw JOIN lw USING (fi) JOIN ow USING (fj) JOIN nl USING (ti) JOIN no USING (tj) GROUP BY ti, tj, dt),
nx AS (SELECT *, lead(v) OVER o AS nv, lead(dt) OVER o AS nd FROM reg WINDOW o AS (PARTITION BY ti, tj ORDER BY dt)),
mv AS (SELECT ti, tj, dt, CASE WHEN month(dt) = 2 AND day(dt) = 28 AND nd = dt + 1 AND day(nd) = 29 THEN v + nv ELSE v END AS v
  FROM nx WHERE NOT (month(dt) = 2 AND day(dt) = 29)),
k AS (SELECT *, dayofyear(make_date(2001, month(dt), day(dt)))::BIGINT AS doy FROM mv)
SELECT ti * (side - 1) + tj AS cell, ti AS fi, tj AS fj, year(dt) AS year, month(dt) AS month, doy, (year(dt) - 1970) * 365 + doy - 1 AS ord,
  round(v::FLOAT::DOUBLE * 86400, 3) AS value FROM k, grid""", "grid")
def preprocess_end_to_end(spark, d):
    """Raw daily precipitation to the next coarser grid and the 365-day calendar."""
    from .pipeline import preprocess

    side = grid_side(spark, d)
    n = side - 1
    source = (Axis(-60.0 + 60.0 / side, 120.0 / side, side), Axis(180.0 / side, 360.0 / side, side, True))
    target = (Axis(-60.0 + 60.0 / n, 120.0 / n, n), Axis(180.0 / n, 360.0 / n, n, True))
    raw = table(spark, d, "lineitem").groupBy(
        F.expr(f"l_partkey % {side * side}").alias("cell"), F.year("l_shipdate").cast("bigint").alias("year"),
        F.month("l_shipdate").cast("bigint").alias("month"), F.dayofmonth("l_shipdate").cast("bigint").alias("day"),
    ).agg((F.sum(F.rint(F.col("l_tax") * 100).cast("bigint")) / F.count(F.lit(1))).alias("value"))
    out = preprocess(with_cell_keys(raw, side), "pr", "mm d-1", "proleptic_gregorian", source, target)
    return out.withColumn("value", F.round(F.col("value").cast("double") * 86400, 3))


def _code(name: str, column: str) -> str:
    scale, offset = packing.specification(name)
    return (f"CASE WHEN {column} IS NULL THEN -32768 ELSE round_even((round({column}, 6) - {offset}::DOUBLE) / {scale}::DOUBLE, 0) END::BIGINT AS {name}")


@query("pack_fire_indices", _DAILY + f"SELECT cell, ord, {', '.join(_code(n, n) for n in _INDICES)} FROM fire", "cube", recursive=True)
def pack_fire_indices(spark, d):
    daily = rounded(fw.daily_fire_weather(_weather(spark, d)), 6, *_INDICES)
    return packing.pack_columns(daily, *_INDICES).select("cell", "ord", *_INDICES)


@query("pack_annual_indicators", """
y AS (SELECT cell, year, avg(tas - 273.15) AS t, sum(CASE WHEN pr >= 1 THEN pr ELSE 0 END) AS p, max(pr) AS x,
  sum(greatest(0, tas - 273.15 - 55.0 / 3)) AS c, sum(greatest(0, 55.0 / 3 - (tas - 273.15))) AS h FROM cube GROUP BY ALL)
SELECT cell, year, """ + ", ".join(_code(n, c) for n, c in (
    ("tg_mean", "t"), ("prcptot", "p"), ("rx1day", "x"), ("cdd65", "c"), ("hdd65", "h"))) + " FROM y", "cube")
def pack_annual_indicators(spark, d):
    names = ("tg_mean", "prcptot", "rx1day", "cdd65", "hdd65")
    annual = indicators.annual_climate_indices(daily_cube(spark, d, "tas", "pr"))
    return packing.pack_columns(rounded(annual, 6, *names), *names).select("cell", "year", *names)
