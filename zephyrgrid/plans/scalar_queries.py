"""Queries over single rows: units, bounds, physics, calendars, source classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import physics as ph
from ..functions import units
from ..functions.presets import VARIABLES
from ..operators import masks
from ..sources.cube import cell_table, daily_cube, table
from .registry import query, rounded

_ALL = ("cell, fi, fj, ci, cj, coarse, lat, lon, year, month, day, doy, ord, tas, hurs, pr, wind, "
        "tasrange, tasskew, prsnratio, ps, rsds, rlds, tasm")


@query("cube_scan", f"SELECT {_ALL} FROM cube", "cube")
def cube_scan(spark, d):
    return daily_cube(spark, d)


@query("unit_convert", """
SELECT cell, ord, round(pr / 86400, 12) AS pr_flux, round(tas - 273.15, 6) AS tas_c,
  round(tas * 9 / 5 - 459.67, 6) AS tas_f, round(hurs * 0.01, 6) AS hurs_share,
  round(wind * 3.6, 6) AS wind_kmh, round(ps / 100, 6) AS ps_hpa FROM cube""", "cube")
def unit_convert(spark, d):
    c = daily_cube(spark, d, "pr", "tas", "hurs", "wind", "ps")
    return c.select(
        "cell", "ord",
        F.round(units.convert(F.col("pr"), "mm d-1", "kg m-2 s-1"), 12).alias("pr_flux"),
        F.round(units.convert(F.col("tas"), "K", "degC"), 6).alias("tas_c"),
        F.round(units.convert(F.col("tas"), "K", "degF"), 6).alias("tas_f"),
        F.round(units.convert(F.col("hurs"), "%", "1"), 6).alias("hurs_share"),
        F.round(units.convert(F.col("wind"), "m s-1", "km h-1"), 6).alias("wind_kmh"),
        F.round(units.convert(F.col("ps"), "Pa", "hPa"), 6).alias("ps_hpa"),
    )


@query("physical_clip", """
SELECT cell, ord, CASE WHEN tasm IS NULL THEN NULL ELSE least(greatest(tasm - 280, 0), 20) END AS v,
  least(prsnratio * 1.2, 1) AS ratio FROM cube""", "cube")
def physical_clip(spark, d):
    low, high = VARIABLES["prsnratio"].clip
    return daily_cube(spark, d, "tasm", "prsnratio").select(
        "cell", "ord",
        ph.clip(F.col("tasm") - 280, 0.0, 20.0).alias("v"),
        ph.clip(F.col("prsnratio") * 1.2, low, high).alias("ratio"),
    )


@query("threshold_to_bound", """
SELECT cell, ord, CASE WHEN x >= 0.1 THEN x ELSE 0 END AS pr,
  CASE WHEN h IS NULL OR h < 0.01 THEN 0 WHEN h > 99.99 THEN 100 ELSE h END AS hurs
FROM (SELECT cell, ord, CASE WHEN tasm IS NOT NULL THEN pr END AS x,
  CASE WHEN tasm IS NOT NULL THEN hurs END AS h FROM cube)""", "cube")
def threshold_to_bound(spark, d):
    seen = F.col("tasm").isNotNull()
    return daily_cube(spark, d, "tasm", "pr", "hurs").select(
        "cell", "ord",
        ph.threshold_to_bound(F.when(seen, F.col("pr")), VARIABLES["pr"].adjust_bounds).alias("pr"),
        ph.threshold_to_bound(F.when(seen, F.col("hurs")), VARIABLES["hurs"].adjust_bounds).alias("hurs"),
    )


@query("restore_boundary_masks", """
SELECT cell, ord, CASE WHEN tasskew > 0.0001 AND tasskew < 0.9999 THEN prsnratio
  WHEN tasskew >= 0.9999 THEN 1 ELSE 0 END AS v FROM cube""", "cube")
def restore_boundary_masks(spark, d):
    return daily_cube(spark, d, "tasskew", "prsnratio").select(
        "cell", "ord",
        ph.restore_boundary(
            F.col("prsnratio"), F.col("tasskew"), VARIABLES["tasskew"].adjust_bounds
        ).alias("v"),
    )


@query("logit_roundtrip", """
SELECT cell, ord, round(ln(x / (1 - x)), 6) AS z, round(x, 6) AS back
FROM (SELECT cell, ord, least(greatest(tasskew, 0.0001::DOUBLE), 0.9999::DOUBLE) AS x FROM cube)""", "cube")
def logit_roundtrip(spark, d):
    bounds = VARIABLES["tasskew"].adjust_bounds
    z = daily_cube(spark, d, "tasskew").select(
        "cell", "ord", ph.to_logit(F.col("tasskew"), bounds).alias("z")
    )
    return rounded(z.withColumn("back", ph.from_logit(F.col("z"), bounds)), 6, "z", "back")


TOP_SQL = """geo AS (
  SELECT *, 2 * pi() * (doy - 1) / 365.0 AS a, radians(lat) AS phi FROM cube),
sun AS (
  SELECT *, 0.006918 - 0.399912*cos(a) + 0.070257*sin(a) - 0.006758*cos(2*a) + 0.000907*sin(2*a)
      - 0.002697*cos(3*a) + 0.00148*sin(3*a) AS dec,
    1.00011 + 0.034221*cos(a) + 0.00128*sin(a) + 0.000719*cos(2*a) + 0.000077*sin(2*a) AS dist
  FROM geo),
top AS (
  SELECT *, 1361 / pi() * dist * (h * sin(phi) * sin(dec) + cos(phi) * cos(dec) * sin(h)) AS ra
  FROM (SELECT *, acos(greatest(-1, least(1, -tan(phi) * tan(dec)))) AS h FROM sun))"""


@query("clearness_index", TOP_SQL + """
SELECT cell, ord, round(ra, 4) AS toa, round(rsds / ra, 8) AS kt,
  round(rsds / ra * ra, 4) AS back FROM top""", "cube")
def clearness_index(spark, d):
    c = ph.with_top_radiation(daily_cube(spark, d, "rsds"))
    top = F.col("toa")
    kt = ph.clearness_index(F.col("rsds"), top)
    return c.select(
        "cell", "ord", F.round(top, 4).alias("toa"), F.round(kt, 8).alias("kt"),
        F.round(kt * top, 4).alias("back"),
    )


@query("value_controls", """
SELECT cell, ord, least(greatest(pr * 500, 0), 3000) AS pr, least(greatest(wind * 6, 0), 46) AS wind,
  least(greatest(hurs * 1.5 - 10, 0), 100) AS hurs,
  CASE WHEN t BETWEEN 130 AND 377 AND NOT frozen THEN t END AS tas,
  greatest(tasrange - 2, 0) AS tasrange, least(greatest(tasskew * 1.5, 0), 1) AS tasskew,
  least(greatest(prsnratio * 1.5, 0), 1) AS prsnratio
FROM (SELECT *, coalesce(bool_and(t = 150) OVER (PARTITION BY cell), FALSE) AS frozen
  FROM (SELECT *, CASE WHEN cell % 5 = 0 THEN 150 WHEN tas > 300 THEN tas + 100 ELSE tas END AS t FROM cube))""",
       "cube")
def value_controls(spark, d):
    c = daily_cube(spark, d, "pr", "wind", "hurs", "tas", "tasrange", "tasskew", "prsnratio")
    t = F.when(F.col("cell") % 5 == 0, F.lit(150.0)).when(F.col("tas") > 300, F.col("tas") + 100).otherwise(F.col("tas"))
    raw = c.select(
        "cell", "ord", (F.col("pr") * 500).alias("pr"), (F.col("wind") * 6).alias("wind"),
        (F.col("hurs") * 1.5 - 10).alias("hurs"), t.alias("tas"),
        (F.col("tasrange") - 2).alias("tasrange"), (F.col("tasskew") * 1.5).alias("tasskew"),
        (F.col("prsnratio") * 1.5).alias("prsnratio"),
    )
    return masks.value_controls(raw, precipitation="pr", precipitation_unit="mm d-1")


@query("static_floor_mask", """
SELECT cell, ord, CASE WHEN NOT bool_and(v = 150) OVER (PARTITION BY cell) THEN v END AS v
FROM (SELECT cell, ord, CASE WHEN cell % 4 = 1 THEN 150 WHEN ord % 9 = 0 THEN 150 ELSE tas END AS v FROM cube)""",
       "cube")
def static_floor_mask(spark, d):
    v = F.when((F.col("cell") % 4 == 1) | (F.col("ord") % 9 == 0), F.lit(150.0)).otherwise(F.col("tas"))
    return masks.mask_static_floor(daily_cube(spark, d, "tas").select("cell", "ord", v.alias("v")), "v")


@query("derive_components", """
SELECT cell, ord, tas - tasskew * tasrange AS tasmin, tas + (1 - tasskew) * tasrange AS tasmax,
  pr * prsnratio AS prsn FROM cube""", "cube")
def derive_components(spark, d):
    c = daily_cube(spark, d, "tas", "tasrange", "tasskew", "pr", "prsnratio")
    return ph.derive_components(c).select("cell", "ord", "tasmin", "tasmax", "prsn")


@query("specific_humidity", """
SELECT cell, ord, round(w / (1 + w), 9) AS huss FROM (
  SELECT cell, ord, hurs / 100 * (0.62198 * es / (ps - es)) AS w FROM (
    SELECT cell, ord, hurs, ps, 100 * exp(-6096.9385 / tas + 16.635794 - 2.711193e-2 * tas
      + 1.673952e-5 * tas * tas + 2.433502 * ln(tas)) AS es FROM cube))""", "cube")
def specific_humidity(spark, d):
    c = ph.derive_components(daily_cube(spark, d, "tas", "hurs", "ps"))
    return rounded(c.select("cell", "ord", "huss"), 9, "huss")


@query("magnus_humidity", """
SELECT cell, ord, round(least(greatest(100 * exp(17.625 * td / (243.04 + td) - 17.625 * t / (243.04 + t)), 0), 100), 6) AS rh
FROM (SELECT cell, ord, tas - 273.15 AS t, tas - tasrange + tasskew * 4 - 273.15 AS td FROM cube)""", "cube")
def magnus_humidity(spark, d):
    c = daily_cube(spark, d, "tas", "tasrange", "tasskew")
    t = F.col("tas") - 273.15
    td = F.col("tas") - F.col("tasrange") + F.col("tasskew") * 4 - 273.15
    return c.select("cell", "ord", F.round(ph.magnus_relative_humidity(t, td), 6).alias("rh"))


@query("wind_speed", """
SELECT cell, ord, round(sqrt(u * u + v * v), 6) AS speed
FROM (SELECT cell, ord, wind AS u, tasrange - 5 AS v FROM cube)""", "cube")
def wind_speed(spark, d):
    return daily_cube(spark, d, "wind", "tasrange").select(
        "cell", "ord", F.round(F.hypot(F.col("wind"), F.col("tasrange") - 5), 6).alias("speed")
    )


@query("longitude_normalize", """
SELECT cell, (lon0 % 360 + 360) % 360 AS lon360,
  ((lon0 + 180) % 360 + 360) % 360 - 180 AS signed,
  CAST(row_number() OVER (PARTITION BY fi ORDER BY (lon0 % 360 + 360) % 360) - 1 AS BIGINT) AS position
FROM (SELECT cell, fi, lon - 200 AS lon0 FROM cells)""", "cells")
def longitude_normalize(spark, d):
    return masks.standardize_longitude(
        cell_table(spark, d).select("cell", "fi", (F.col("lon") - 200).alias("lon0")), "lon0", row="fi"
    ).select("cell", F.col("lon360"), "signed", "position")


@query("local_noon_offset", """
SELECT cell, o AS utc_offset, CAST((o % 24 + 24) % 24 AS BIGINT) AS utc_hour FROM (
  SELECT cell, CAST(round_even(12 - (((lon + 180) % 360 + 360) % 360 - 180) / 15, 0) AS BIGINT) AS o FROM cells)""",
       "cells")
def local_noon_offset(spark, d):
    offset = ph.local_noon_utc_offset(F.col("lon"))
    return cell_table(spark, d).select(
        "cell", offset.alias("utc_offset"), F.pmod(offset, F.lit(24)).cast("bigint").alias("utc_hour")
    )


@query("nearest_hour_utc", """
SELECT cell, ord, CAST(round_even((epoch(make_date(year, month, day)) + 43200
  + round_even(-(((lon + 180) % 360 + 360) % 360 - 180) * 240, 0)) / 3600.0, 0) AS BIGINT) AS utc_hours
FROM cube""", "cube")
def nearest_hour_utc(spark, d):
    noon = F.timestamp_seconds(
        F.unix_date(F.make_date("year", "month", "day")).cast("bigint") * 86400 + 43200
    )
    stamp = ph.nearest_hour_utc(noon, F.col("lon"))
    return daily_cube(spark, d, "tas").select(
        "cell", "ord", (F.unix_timestamp(stamp) / 3600).cast("bigint").alias("utc_hours")
    )


@query("noleap_calendar", """
SELECT DISTINCT year, month, day, doy, ord, CAST(1970 + ord // 365 AS BIGINT) AS year_back,
  CAST(month(make_date(2001, 1, 1) + (ord % 365)::INTEGER) AS BIGINT) AS month_back FROM cube""", "cube")
def noleap_calendar(spark, d):
    c = daily_cube(spark, d, "tas").select("year", "month", "day", "doy", "ord").distinct()
    return c.withColumn("year_back", cal.year_of_ord(F.col("ord"))).withColumn(
        "month_back", cal.month_of_doy(cal.doy_of_ord(F.col("ord")))
    )


@query("leap_day_shift", """
daily AS (
  SELECT l_suppkey % 10 AS cell, CAST(l_shipdate AS DATE) AS dt, sum(l_quantity::BIGINT)::DOUBLE AS pr
  FROM lineitem GROUP BY ALL),
n AS (
  SELECT *, lead(pr) OVER w AS next_pr, lead(dt) OVER w AS next_dt
  FROM daily WINDOW w AS (PARTITION BY cell ORDER BY dt))
SELECT cell, year(dt) AS year, month(dt) AS month, day(dt) AS day,
  CASE WHEN month(dt) = 2 AND day(dt) = 28 AND next_dt = dt + 1 AND day(next_dt) = 29
    THEN pr + next_pr ELSE pr END AS pr
FROM n WHERE NOT (month(dt) = 2 AND day(dt) = 29)""", "grid")
def leap_day_shift(spark, d):
    daily = (
        table(spark, d, "lineitem")
        .groupBy((F.col("l_suppkey") % 10).alias("cell"), F.to_date("l_shipdate").alias("dt"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("pr"))
        .select("cell", F.year("dt").alias("year"), F.month("dt").alias("month"),
                F.dayofmonth("dt").alias("day"), "pr")
    )
    return cal.move_leap_accumulation(daily, "pr")


@query("calendar_360_to_noleap", """
src AS (
  SELECT cell, year, d, sum(pr) AS pr FROM (
    SELECT cell, year, least(360, (month - 1) * 30 + least(day, 30)) AS d, pr FROM cube) GROUP BY ALL),
mapped AS (SELECT cell, year, CAST(round_even(365.0::DOUBLE * d / 360, 0) AS BIGINT) AS doy, pr FROM src),
axis AS (SELECT * FROM (SELECT DISTINCT cell, year FROM src), (SELECT unnest(range(1, 366)) AS doy)),
dense AS (
  SELECT a.cell, a.year, a.doy, m.pr, m.doy IS NOT NULL AS has,
    (lag(m.pr) OVER w + lead(m.pr) OVER w) / 2 AS mid
  FROM axis a LEFT JOIN mapped m USING (cell, year, doy)
  WINDOW w AS (PARTITION BY a.cell ORDER BY a.year, a.doy))
SELECT cell, year, doy, round(CASE WHEN has THEN pr ELSE mid END, 6) AS pr FROM dense""", "cube")
def calendar_360_to_noleap(spark, d):
    c = daily_cube(spark, d, "pr").select(
        "cell", "year",
        F.least(F.lit(360), (F.col("month") - 1) * 30 + F.least(F.col("day"), F.lit(30))).alias("doy360"),
        "pr",
    )
    source = c.groupBy("cell", "year", "doy360").agg(F.sum("pr").alias("pr"))
    return rounded(cal.expand_360_day(source, "pr"), 6, "pr")


@query("circular_day_distance", """
SELECT cell, ord, least(abs(doy - k), 365 - abs(doy - k)) AS distance, abs(month - k % 12 - 1) AS months
FROM (SELECT cell, ord, doy, month, (cell * 53) % 365 + 1 AS k FROM cube)""", "cube")
def circular_day_distance(spark, d):
    k = F.col("cell") * 53 % 365 + 1
    return daily_cube(spark, d, "tas").select(
        "cell", "ord",
        cal.circular_distance(F.col("doy"), k, 365).alias("distance"),
        cal.circular_distance(F.col("month"), k % 12 + 1, None).alias("months"),
    )


@query("boundary_signal_transfer", """
SELECT cell, ord, round(least(greatest(CASE WHEN h = o THEN s WHEN h < o AND s < h THEN o + s - h
    WHEN h < o THEN 100 - (100 - o) * (100 - s) / (100 - h) WHEN s > h THEN o + s - h
    ELSE 0 + (o - 0) * (s - 0) / (h - 0) END, 0), 100), 6) AS v
FROM (SELECT cell, ord, hurs AS o, prsnratio * 100 AS h, wind * 9 AS s FROM cube)""", "cube")
def boundary_signal_transfer(spark, d):
    v = ph.boundary_signal_transfer(
        F.col("hurs"), F.col("prsnratio") * 100, F.col("wind") * 9, 0.0, 100.0
    )
    return daily_cube(spark, d, "hurs", "prsnratio", "wind").select("cell", "ord", F.round(v, 6).alias("v"))


@query("source_class_combine", """
SELECT cell, CAST(CASE WHEN land AND (a = 0 OR b = 0 OR c = 0) THEN 4 WHEN a = 0 OR b = 0 OR c = 0 THEN 0
  WHEN a = 3 OR b = 3 OR c = 3 THEN 3 WHEN a = 2 OR b = 2 OR c = 2 THEN 2 ELSE 1 END AS BIGINT) AS class
FROM (SELECT cell, land, code AS a, (code + fi) % 4 AS b, CASE WHEN code = 0 THEN 0 ELSE 1 END AS c FROM cells)""",
       "cells")
def source_class_combine(spark, d):
    codes = [F.col("code"), (F.col("code") + F.col("fi")) % 4,
             F.when(F.col("code") == 0, F.lit(0)).otherwise(F.lit(1))]
    return cell_table(spark, d).select(
        "cell", ph.combined_source_class(codes, F.col("land")).alias("class")
    )


@query("reference_unit_normalize", """
SELECT cell, ord, least(greatest(tasskew * 100, 0), 100) AS hurs, greatest(prm * 1000 - 1, 0) AS pr
FROM (SELECT cell, ord, tasskew, pr / 1000 AS prm FROM cube)""", "cube")
def reference_unit_normalize(spark, d):
    """Humidity share to percent and metres of water to millimetres, with round-off clipped."""
    c = daily_cube(spark, d, "tasskew", "pr")
    return c.select(
        "cell", "ord",
        ph.clip(F.col("tasskew") * 100, 0.0, 100.0).alias("hurs"),
        ph.clip(F.col("pr") / 1000 * 1000 - 1, 0.0, None).alias("pr"),
    )


@query("period_region_slice", """
SELECT cell, ord, tas FROM cube, (SELECT max(fi) + 1 AS n FROM cube)
WHERE year BETWEEN 1997 AND 1999 AND fi >= n // 4 AND fi < n - n // 4""", "cube")
def period_region_slice(spark, d):
    from ..sources.cube import grid_side

    side = grid_side(spark, d)
    return masks.period_region(
        daily_cube(spark, d, "tas"), 1997, 1999, rows=(side // 4, side - side // 4)
    ).select("cell", "ord", "tas")


@query("grid_cell_weights", "SELECT cell, round(cos(radians(lat)), 9) AS weight FROM cells", "cells")
def grid_cell_weights(spark, d):
    return cell_table(spark, d).select("cell", F.round(ph.latitude_weight(F.col("lat")), 9).alias("weight"))
