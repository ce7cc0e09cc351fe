"""Queries over joins, neighbourhoods, masks on the grid and regridding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import physics as ph
from ..operators import align, components, indicators, masks, regrid, windows
from ..operators.aggregate import weighted_annulus_series
from ..sources.cube import cell_table, daily_cube, grid_side, role_series, table
from .registry import query, rounded


def _role(spark, d, role, *columns):
    return role_series(spark, d, role, *columns)


def _places(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("place"),
        ((F.col("c_custkey") * 37 % 1100) / 10 - 55).alias("plat"),
        (F.col("c_custkey") * 73 % 3600 / 10).alias("plon"))


_PLACES = """places AS (SELECT c_custkey AS place, (c_custkey * 37 % 1100)::DOUBLE / 10 - 55 AS plat,
  (c_custkey * 73 % 3600)::DOUBLE / 10 AS plon FROM customer)"""


def _axes(side):
    step = 120.0 / side
    return (regrid.Axis(-60.0 + step / 2, step, side), regrid.Axis(180.0 / side, 360.0 / side, side, True))


@query("exact_align", "SELECT cell, ord, tas AS reference, pr AS historical FROM cube", "cube")
def exact_align(spark, d):
    """Strict alignment of two variables of one cube; unequal axes are refused."""
    left = daily_cube(spark, d, "tas").select("cell", "ord", F.col("tas").alias("reference"))
    right = daily_cube(spark, d, "pr").select("cell", "ord", F.col("pr").alias("historical"))
    return align.align(left, right, ["cell", "ord"])


@query("common_days", """
SELECT r.cell, r.ord, r.tas AS reference, h.tas AS historical
FROM roles r JOIN roles h ON r.cell = h.cell AND r.ord = h.ord WHERE r.role = 'ref' AND h.role = 'hist'""", "roles")
def common_days(spark, d):
    """Inner alignment of two series of different days."""
    r = _role(spark, d, "ref", "tas").select("cell", "ord", F.col("tas").alias("reference"))
    h = _role(spark, d, "hist", "tas").select("cell", "ord", F.col("tas").alias("historical"))
    return align.align(r, h, ["cell", "ord"], exact=False)


@query("alignment_report", """
k AS (SELECT cell, ord, bool_or(role = 'ref') AS r, bool_or(role = 'hist') AS h FROM roles WHERE role <> 'sim' GROUP BY ALL)
SELECT count(*) FILTER (r AND NOT h) AS only_left, count(*) FILTER (h AND NOT r) AS only_right, count(*) FILTER (r AND h) AS both FROM k""",
       "roles")
def alignment_report(spark, d):
    r, h = (_role(spark, d, x, "tas").select("cell", "ord") for x in ("ref", "hist"))
    return align.alignment_report(r, h, ["cell", "ord"])


@query("grid_equality", """
a AS (SELECT DISTINCT fi, lat FROM roles WHERE role = 'hist'), b AS (SELECT DISTINCT fi, lat FROM roles WHERE role = 'sim')
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_left,
  (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_right,
  (SELECT count(*) FROM a JOIN b USING (fi, lat)) AS both""", "roles")
def grid_equality(spark, d):
    a, b = (_role(spark, d, x, "tas").select("fi", "lat").distinct() for x in ("hist", "sim"))
    return align.alignment_report(a, b, ["fi", "lat"])


@query("axis_select", """
SELECT cell, ord, tas FROM cube WHERE fi IN (SELECT fi FROM cells WHERE code = 1) AND fj IN (SELECT fj FROM cells WHERE code = 2)""",
       "cube", "cells")
def axis_select(spark, d):
    cells = cell_table(spark, d)
    rows = cells.where("code = 1").select("fi").distinct()
    columns = cells.where("code = 2").select("fj").distinct()
    return daily_cube(spark, d, "tas").join(rows, "fi").join(columns, "fj").select("cell", "ord", "tas")


@query("nearest_label_join", """
SELECT a.cell, a.ord, a.tas, b.code FROM cube a JOIN cells b ON round(a.lat, 5) = round(b.lat, 5) AND round(a.lon, 5) = round(b.lon, 5)""",
       "cube", "cells")
def nearest_label_join(spark, d):
    labels = cell_table(spark, d).select((F.col("lat") + 1e-7).alias("lat"), (F.col("lon") - 1e-7).alias("lon"), "code")
    return align.label_join(daily_cube(spark, d, "tas"), labels, ["lat", "lon"]).select("cell", "ord", "tas", "code")


@query("coarse_fine_join", """
c AS (SELECT coarse, ord, avg(tas) AS m FROM cube GROUP BY ALL)
SELECT cell, ord, round(tas - m, 6) AS anomaly FROM cube JOIN c USING (coarse, ord)""", "cube")
def coarse_fine_join(spark, d):
    c = daily_cube(spark, d, "tas")
    means = c.groupBy("coarse", "ord").agg(F.avg("tas").alias("m"))
    out = align.nest(c.select("cell", "fi", "fj", "ord", "tas"), means, 2, grid_side(spark, d) // 2, "ord")
    return out.select("cell", "ord", F.round(F.col("tas") - F.col("m"), 6).alias("anomaly"))


@query("masked_fill_zero", """
SELECT cell, ord, CASE WHEN land THEN tasm END AS masked, CASE WHEN land AND tasm IS NULL THEN 0 ELSE tasm END AS filled
FROM cube JOIN (SELECT cell, land FROM cells) USING (cell)""", "cube", "cells")
def masked_fill_zero(spark, d):
    mask = cell_table(spark, d).select("cell", F.col("land").alias("support"))
    c = daily_cube(spark, d, "tasm").withColumn("masked", F.col("tasm"))
    out = masks.apply_support(c, mask, "masked")
    return out.select("cell", "ord", "masked", masks.fill_inside(F.col("tasm"), F.col("support")).alias("filled"))


@query("halo_context", """
SELECT a.coarse, x.di::BIGINT AS di, y.dj::BIGINT AS dj, b.coarse AS neighbour,
  CASE WHEN a.cj + y.dj < 0 THEN -360 WHEN a.cj + y.dj >= side // 2 THEN 360 ELSE 0 END::BIGINT AS lon_shift
FROM (SELECT DISTINCT coarse, ci, cj FROM cells) a, grid, (SELECT unnest(range(-1, 2)) AS di) x, (SELECT unnest(range(-1, 2)) AS dj) y,
  (SELECT DISTINCT coarse, ci, cj FROM cells) b
WHERE b.ci = a.ci + x.di AND b.cj = (a.cj + y.dj + side // 2) % (side // 2)""", "cells")
def halo_context(spark, d):
    half = grid_side(spark, d) // 2
    return align.halo_context(cell_table(spark, d).select("coarse", "ci", "cj").distinct(), half, half)


_PLAN = """ord8(r, di, dj) AS (VALUES (0,-1,0),(1,1,0),(2,0,-1),(3,0,1),(4,-1,-1),(5,-1,1),(6,1,-1),(7,1,1)),
plan AS (SELECT g.cell, arg_min(v.cell, r) AS donor FROM cells g, grid, ord8, cells v
  WHERE g.code = 0 AND g.land_share > 0.1 AND v.code > 0 AND v.fi = g.fi + di AND v.fj = (g.fj + dj + side) % side GROUP BY g.cell)"""


def _plan(spark, d):
    cells = cell_table(spark, d).withColumn("valid", F.col("code") > 0).withColumn("mapped", F.col("land_share") > 0.1)
    return masks.coastal_plan(cells, grid_side(spark, d), "valid", "mapped")


@query("coastal_fill_plan", _PLAN + "SELECT cell, donor FROM plan", "cells")
def coastal_fill_plan(spark, d):
    return _plan(spark, d)


@query("donor_fill", _PLAN + """
SELECT p.cell, c.ord, c.tas, TRUE AS filled FROM plan p JOIN cube c ON c.cell = p.donor
UNION ALL SELECT cell, ord, tas, FALSE FROM cube WHERE cell NOT IN (SELECT cell FROM plan)""", "cube", "cells")
def donor_fill(spark, d):
    c = daily_cube(spark, d, "tas").select("cell", "ord", "tas")
    return masks.fill_from_donor(c, _plan(spark, d), "tas")


@query("reference_source_compose", """
o AS (SELECT cell, ord, tas AS ext FROM roles WHERE role = 'hist'), h AS (SELECT cell, ord, tasm FROM cube)
SELECT h.cell, h.ord, coalesce(n, dn, CASE WHEN land THEN ext END) AS value,
  CASE WHEN n IS NOT NULL THEN 1 WHEN dn IS NOT NULL THEN 2 WHEN land AND ext IS NOT NULL THEN 3 ELSE 0 END::BIGINT AS source
FROM (SELECT cell, ord, CASE WHEN ord % 3 = 0 THEN tasm END AS n, CASE WHEN ord % 3 = 1 THEN tasm END AS dn FROM h) h
JOIN (SELECT cell, land FROM cells) USING (cell) LEFT JOIN o USING (cell, ord)""", "cube", "roles", "cells")
def reference_source_compose(spark, d):
    c = daily_cube(spark, d, "tasm").select(
        "cell", "ord", F.when(F.col("ord") % 3 == 0, F.col("tasm")).alias("n"),
        F.when(F.col("ord") % 3 == 1, F.col("tasm")).alias("dn"))
    external = _role(spark, d, "hist", "tas").select("cell", "ord", F.col("tas").alias("ext"))
    land = cell_table(spark, d).select("cell", "land")
    joined = c.join(land, "cell").join(external, ["cell", "ord"], "left")
    return masks.compose_reference(joined, "n", "dn", "ext", "land").select("cell", "ord", "value", "source")


@query("sparse_merge", """
s AS (SELECT cell, ord, tas AS fresh FROM roles WHERE role = 'hist' AND tas > 280)
SELECT cell, ord, CASE WHEN code = 3 THEN coalesce(fresh, tas) ELSE tas END AS tas
FROM cube JOIN (SELECT cell, code FROM cells) USING (cell) LEFT JOIN s USING (cell, ord)""", "cube", "roles", "cells")
def sparse_merge(spark, d):
    dense = daily_cube(spark, d, "tas").select("cell", "ord", "tas").join(cell_table(spark, d).select("cell", "code"), "cell")
    sparse = _role(spark, d, "hist", "tas").where("tas > 280")
    return align.sparse_over_dense(dense, sparse, ["cell", "ord"], "tas", F.col("code") == 3).drop("code")


@query("hourly_assignment", """
h AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, sum(round(value * 100)::BIGINT)::DOUBLE / count(*) / 100 AS v FROM events GROUP BY ALL),
d AS (SELECT min(ts)::DATE AS a, max(ts)::DATE AS b FROM events),
x AS (SELECT cell, CAST(round_even(12 - (((lon + 180) % 360 + 360) % 360 - 180) / 15, 0) AS BIGINT) AS o,
  unnest(range(0, date_diff('day', a, b) + 1)) AS k, a FROM cells, d)
SELECT cell, k AS day_index, h.hour, v FROM x JOIN h ON h.hour = date_diff('day', DATE '1970-01-01', a) * 24 + k * 24 + o""", "cells")
def hourly_assignment(spark, d):
    events = table(spark, d, "events")
    hourly = events.groupBy((F.unix_date(F.to_date("ts")).cast("bigint") * 24 + F.hour("ts")).alias("hour")).agg(
        (F.sum(F.round(F.col("value") * 100).cast("bigint")) / F.count(F.lit(1)) / 100).alias("v"))
    from ..session import attach_row

    span = events.agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    cells = attach_row(cell_table(spark, d).select("cell", ph.local_noon_utc_offset(F.col("lon")).alias("utc_offset")), span)
    days = cells.withColumn("date", F.explode(F.sequence("a", "b")))
    return align.hourly_assignment(days, hourly).select(
        "cell", F.datediff("date", "a").alias("day_index"), "hour", "v")


_NEAREST = _PLACES + """,
h AS (SELECT *, greatest(0, least(side - 1, floor((plat + 60) / (120.0::DOUBLE / side))))::BIGINT AS i,
  floor(plon / (360.0::DOUBLE / side))::BIGINT AS j FROM places, grid),
x AS (SELECT place, cell, NOT (fi = i AND fj = j) AS away,
  round(power(lat - plat, 2) + power((((lon - plon + 180) % 360 + 360) % 360 - 180) * cos(radians(plat)), 2), 6) AS dist
  FROM h JOIN cells c ON abs(c.fi - i) <= 8 AND least((c.fj - j + side) % side, (j - c.fj + side) % side) <= 8 WHERE land)"""


@query("nearest_cell_topk", _NEAREST + """
SELECT place, cell, dist AS distance2 FROM x QUALIFY row_number() OVER (PARTITION BY place ORDER BY away, dist, cell) = 1""", "cells")
def nearest_cell_topk(spark, d):
    side = grid_side(spark, d)
    return align.nearest_valid_cell(_places(spark, d), cell_table(spark, d).where("land"), side, -60.0, 120.0 / side)


_RING = _PLACES + """,
ring AS (SELECT place, cell, km, cos(radians(lat)) AS weight FROM (
  SELECT place, cell, lat, 2 * 6371.0088 * asin(sqrt(least(1, power(sin(radians(lat - plat) / 2), 2)
    + cos(radians(plat)) * cos(radians(lat)) * power(sin(radians(lon - plon) / 2), 2)))) AS km FROM places, cells, grid)
  , grid WHERE km BETWEEN 0.2::DOUBLE * 13343.4 / side AND 1.2::DOUBLE * 13343.4 / side)"""


def _ring(spark, d):
    side = grid_side(spark, d)
    spacing = 13343.4 / side
    return align.ring_cells(_places(spark, d), cell_table(spark, d), side, -60.0, 120.0 / side, 0.2 * spacing, 1.2 * spacing)


@query("city_ring", _RING + "SELECT place, cell, round(km, 4) AS km, round(weight, 8) AS weight FROM ring", "cells")
def city_ring(spark, d):
    return rounded(rounded(_ring(spark, d), 4, "km"), 8, "weight")


@query("annulus_weighted_series", _RING + """,
y AS (SELECT cell, year, avg(tasm) AS v FROM cube GROUP BY ALL)
SELECT place, year, round(sum(v * weight) / sum(CASE WHEN v IS NOT NULL THEN weight END), 6) AS mean,
  count(DISTINCT CASE WHEN v IS NOT NULL THEN cell END) AS cells FROM ring JOIN y USING (cell) GROUP BY place, year""", "cube", "cells")
def annulus_weighted_series(spark, d):
    yearly = daily_cube(spark, d, "tasm").groupBy("cell", "year").agg(F.avg("tasm").alias("v"))
    return rounded(weighted_annulus_series(yearly, _ring(spark, d), "v"), 6, "mean")


@query("history_gaps", """
h AS (SELECT cell, max(ord) AS last_history, count(*) AS history_days FROM roles WHERE role = 'ref' GROUP BY cell),
s AS (SELECT cell, min(ord) AS first_simulation, count(*) AS simulation_days FROM roles WHERE role = 'sim' GROUP BY cell)
SELECT cell, last_history, history_days, first_simulation, simulation_days, coalesce(first_simulation - last_history = 1, FALSE) AS adjacent
FROM h FULL JOIN s USING (cell)""", "roles")
def history_gaps(spark, d):
    return align.history_gaps(_role(spark, d, "ref", "tas"), _role(spark, d, "sim", "tas"), ["cell"])


@query("region_concat", """
u AS (SELECT cell, ord, fi, ((lon + 180) % 360 + 360) % 360 - 180 AS lon, tas FROM cube)
SELECT cell, ord, lon, tas, CAST(dense_rank() OVER (PARTITION BY fi ORDER BY lon) - 1 AS BIGINT) AS position FROM u""", "cube")
def region_concat(spark, d):
    c = daily_cube(spark, d, "tas").select("cell", "ord", "fi", "lon", "tas")
    return align.concatenate_regions(c.where("lon >= 180"), c.where("lon < 180"), "lon", "fi").select(
        "cell", "ord", "lon", "tas", "position")


@query("pending_antijoin", """
f AS (SELECT coarse, year FROM cube GROUP BY ALL HAVING count(tasm) > 1070)
SELECT DISTINCT coarse, year FROM cube WHERE (coarse, year) NOT IN (SELECT coarse, year FROM f)""", "cube")
def pending_antijoin(spark, d):
    c = daily_cube(spark, d, "tasm")
    counts = c.groupBy("coarse", "year").agg(F.count("tasm").alias("n"))
    return align.pending(counts.select("coarse", "year"), counts.where("n > 1070"), ["coarse", "year"])


@query("missing_required_cells", """
e AS (SELECT cell, arg_min(coalesce(tasm, -1), ord) AS a, arg_max(coalesce(tasm, -1), ord) AS b FROM cube GROUP BY cell)
SELECT cell FROM cells WHERE land AND cell NOT IN (SELECT c.cell FROM cells c JOIN e USING (cell) WHERE c.code > 0 AND a <> -1 AND b <> -1)""",
       "cube", "cells")
def missing_required_cells(spark, d):
    cells = cell_table(spark, d)
    ends = daily_cube(spark, d, "tasm").groupBy("cell").agg(
        F.min_by("tasm", "ord").alias("first"), F.max_by("tasm", "ord").alias("last"))
    covered = cells.select("cell", (F.col("code") > 0).alias("covered"))
    return align.missing_cells(cells.where("land").select("cell"), covered, ends)


_COMPONENTS = """m AS (SELECT cell, fi, fj, lat, lon, land_share * cos(radians(lat)) AS area FROM cells WHERE code <> 1),
reach(cell, other) AS (
  SELECT cell, cell FROM m
  UNION
  SELECT r.cell, b.cell FROM reach r JOIN m a ON a.cell = r.other, m b, grid
  WHERE abs(a.fi - b.fi) <= 1 AND ((a.fj - b.fj + side) % side) IN (0, 1, side - 1)),
lab AS (SELECT cell, min(other) AS label FROM reach GROUP BY cell)"""


def _component_mask(spark, d):
    return cell_table(spark, d).where("code <> 1").withColumn("area", F.col("land_share") * F.cos(F.radians("lat")))


@query("connected_components", _COMPONENTS + "SELECT cell, label FROM lab", "cells", recursive=True)
def connected_components(spark, d):
    return components.periodic_components(_component_mask(spark, d), grid_side(spark, d))


@query("gap_clusters", _COMPONENTS + """
SELECT label, count(*) AS cells, round(sum(area), 6) AS area,
  round(CASE WHEN sum(area) > 0 THEN sum(area * lat) / sum(area) ELSE avg(lat) END, 6) AS centroid_lat,
  round(CASE WHEN sum(area) > 0 THEN sum(area * lon) / sum(area) ELSE avg(lon) END, 6) AS centroid_lon,
  min(lat) - 60.0::DOUBLE / any_value(side) AS south, max(lat) + 60.0::DOUBLE / any_value(side) AS north,
  min(lon) - 180.0::DOUBLE / any_value(side) AS west, max(lon) + 180.0::DOUBLE / any_value(side) AS east
FROM m JOIN lab USING (cell), grid GROUP BY label""", "cells", recursive=True)
def gap_clusters(spark, d):
    side = grid_side(spark, d)
    mask = _component_mask(spark, d)
    labels = components.periodic_components(mask, side)
    out = components.cluster_records(mask, labels, "area", (60.0 / side, 180.0 / side))
    return rounded(out, 6, "area", "centroid_lat", "centroid_lon")


_COARSE = "c AS (SELECT coarse, ci, cj, ord, avg(tasm) AS v FROM cube GROUP BY ALL)"


@query("bilinear_broadcast", _COARSE + """,
f AS (SELECT cell, fi, fj, ci, cj, side // 2 AS n, CASE WHEN fi % 2 = 0 THEN -1 ELSE 1 END AS di, CASE WHEN fj % 2 = 0 THEN -1 ELSE 1 END AS dj
  FROM cells, grid),
t AS (SELECT f.cell, c.ord, c.v AS v0, b.v AS v1, e.v AS v2, g.v AS v3 FROM f JOIN c ON c.ci = f.ci AND c.cj = f.cj
  LEFT JOIN c b ON b.ord = c.ord AND b.ci = f.ci AND b.cj = (f.cj + f.dj + n) % n
  LEFT JOIN c e ON e.ord = c.ord AND e.ci = f.ci + f.di AND e.cj = f.cj
  LEFT JOIN c g ON g.ord = c.ord AND g.ci = f.ci + f.di AND g.cj = (f.cj + f.dj + n) % n)
SELECT cell, ord, round(coalesce(0.75 * (0.75 * v0 + 0.25 * v1) + 0.25 * (0.75 * v2 + 0.25 * v3), v0), 9) AS v FROM t""", "cube", "cells")
def bilinear_broadcast(spark, d):
    side = grid_side(spark, d)
    coarse = daily_cube(spark, d, "tasm").groupBy("ci", "cj", "ord").agg(F.avg("tasm").alias("v"))
    fine = regrid.bilinear_broadcast(coarse, "v", side // 2, side // 2, 2)
    return fine.select((F.col("fi") * side + F.col("fj")).alias("cell"), "ord", F.round("v", 9).alias("v"))


@query("linear_regrid", """
t AS (SELECT unnest(range(0, side + 2)) AS k, side FROM grid),
la AS (SELECT k AS ti, greatest(0, least(side - 1, (-60 + (k + 0.5) * 120.0::DOUBLE / (side + 2) - (-60 + 60.0::DOUBLE / side)) / (120.0::DOUBLE / side))) AS p FROM t),
lw AS (SELECT ti, floor(p)::BIGINT AS fi, 1 - (p - floor(p)) AS w FROM la UNION ALL SELECT ti, floor(p)::BIGINT + 1, p - floor(p) FROM la WHERE p > floor(p)),
lo AS (SELECT k AS tj, ((k + 0.5) * 360.0::DOUBLE / (side + 2) - 180.0::DOUBLE / side) / (360.0::DOUBLE / side) AS p, side FROM t),
ow AS (SELECT tj, (floor(p)::BIGINT + side) % side AS fj, 1 - (p - floor(p)) AS w FROM lo UNION ALL SELECT tj, (floor(p)::BIGINT + 1 + side) % side, p - floor(p) FROM lo WHERE p > floor(p)),
s AS (SELECT fi, fj, year, month, avg(tas) AS v FROM cube GROUP BY ALL),
nl AS (SELECT ti, count(*) AS a FROM lw GROUP BY ti), no AS (SELECT tj, count(*) AS b FROM ow GROUP BY tj)
SELECT ti, tj, year, month, round(CASE WHEN count(v) = any_value(a * b) THEN sum(lw.w * ow.w * v) END, 9) AS v
FROM s JOIN lw USING (fi) JOIN ow USING (fj) JOIN nl USING (ti) JOIN no USING (tj) GROUP BY ti, tj, year, month""", "cube")
def linear_regrid(spark, d):
    side = grid_side(spark, d)
    source = _axes(side)
    n = side + 2
    target = (regrid.Axis(-60.0 + 60.0 / n, 120.0 / n, n), regrid.Axis(180.0 / n, 360.0 / n, n, True))
    monthly = daily_cube(spark, d, "tas").groupBy("fi", "fj", "year", "month").agg(F.avg("tas").alias("v"))
    return rounded(regrid.linear_regrid(monthly, source, target, "v", ("year", "month")), 9, "v")


OVERLAP_SQL = """t AS (SELECT unnest(range(0, side - 1)) AS k, side, side - 1 AS n FROM grid),
sx AS (SELECT unnest(range(0, side)) AS s, side FROM grid),
lw AS (SELECT k AS ti, s AS fi, sin(radians(least(-60 + (k + 1) * 120.0::DOUBLE / n, -60 + (s + 1) * 120.0::DOUBLE / t.side)))
    - sin(radians(greatest(-60 + k * 120.0::DOUBLE / n, -60 + s * 120.0::DOUBLE / t.side))) AS w FROM t, sx
  WHERE least((k + 1) * 120.0::DOUBLE / n, (s + 1) * 120.0::DOUBLE / t.side) > greatest(k * 120.0::DOUBLE / n, s * 120.0::DOUBLE / t.side) + 1e-9),
ow AS (SELECT k AS tj, s AS fj, least((k + 1) * 360.0::DOUBLE / n, (s + 1) * 360.0::DOUBLE / t.side) - greatest(k * 360.0::DOUBLE / n, s * 360.0::DOUBLE / t.side) AS w FROM t, sx
  WHERE least((k + 1) * 360.0::DOUBLE / n, (s + 1) * 360.0::DOUBLE / t.side) > greatest(k * 360.0::DOUBLE / n, s * 360.0::DOUBLE / t.side) + 1e-9)"""


@query("conservative_regrid", OVERLAP_SQL + """,
m AS (SELECT fi, fj, year, month, avg(pr) AS v FROM cube GROUP BY ALL),
nl AS (SELECT ti, count(*) AS a FROM lw GROUP BY ti), no AS (SELECT tj, count(*) AS b FROM ow GROUP BY tj)
SELECT ti, tj, year, month, round(CASE WHEN count(v) = any_value(a * b) THEN sum(lw.w * ow.w * v) / sum(lw.w * ow.w) END, 9) AS v
FROM m JOIN lw USING (fi) JOIN ow USING (fj) JOIN nl USING (ti) JOIN no USING (tj) GROUP BY ti, tj, year, month""", "cube")
def conservative_regrid(spark, d):
    side = grid_side(spark, d)
    n = side - 1
    target = (regrid.Axis(-60.0 + 60.0 / n, 120.0 / n, n), regrid.Axis(180.0 / n, 360.0 / n, n, True))
    monthly = daily_cube(spark, d, "pr").groupBy("fi", "fj", "year", "month").agg(F.avg("pr").alias("v"))
    return rounded(regrid.conservative_regrid(monthly, _axes(side), target, "v", ("year", "month")), 9, "v")


@query("bilinear_point_sample", _PLACES + """,
f AS (SELECT side - 1 - fi AS r, fj AS c, month, avg(tas) AS v FROM cube, grid GROUP BY ALL),
p AS (SELECT place, greatest(0, (60 - 60.0::DOUBLE / side - least(plat, 60 - 60.0::DOUBLE / side)) / (120.0::DOUBLE / side)) AS y, plon / (360.0::DOUBLE / side) AS x, side FROM places, grid),
k AS (SELECT place, least(floor(y)::BIGINT + a, side - 1) AS r, (floor(x)::BIGINT + b) % side AS c,
  (CASE WHEN a = 1 THEN y - floor(y) ELSE 1 - y + floor(y) END) * (CASE WHEN b = 1 THEN x - floor(x) ELSE 1 - x + floor(x) END) AS w
  FROM p, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b))
SELECT place AS point, month, round(CASE WHEN count(v) = 4 THEN sum(w * v) END, 6) AS v FROM k JOIN f USING (r, c) GROUP BY ALL""", "cube")
def bilinear_point_sample(spark, d):
    side = grid_side(spark, d)
    north = 60.0 - 60.0 / side
    points = _places(spark, d).select(F.col("place").alias("point"), F.least("plat", F.lit(north)).alias("plat"), "plon")
    field = daily_cube(spark, d, "tas").groupBy(
        (F.lit(side - 1) - F.col("fi")).alias("row"), F.col("fj").alias("column"), "month").agg(F.avg("tas").alias("v"))
    return rounded(regrid.point_sample(points, field, north, 120.0 / side, side, side, "v", ("month",)), 6, "v")


@query("raster_block_sum", """
SELECT fi // 2 AS bi, fj // 2 AS bj, year, round(sum(coalesce(pr, 0)), 6) AS pr FROM cube GROUP BY ALL""", "cube")
def raster_block_sum(spark, d):
    return rounded(regrid.block_sum(daily_cube(spark, d, "pr"), "pr", 2, "year"), 6, "pr")


@query("sparse_chunk_groups", """
SELECT fi // 3 AS chunk_row, fj // 2 AS chunk_column, count(*) AS n, string_agg(cell::VARCHAR, ',' ORDER BY cell) AS cells
FROM cells WHERE code = 3 GROUP BY ALL""", "cells")
def sparse_chunk_groups(spark, d):
    out = regrid.chunk_groups(cell_table(spark, d).where("code = 3"), 3, 2)
    return out.select("chunk_row", "chunk_column", F.size("cells").alias("n"),
                      F.array_join(F.transform("cells", lambda c: c.cast("string")), ",").alias("cells"))


@query("raster_alignment", """
SELECT cell, fi, fj, land_share AS share FROM cells""", "cells")
def raster_alignment(spark, d):
    """Turn a north-to-south, dateline-first raster into the grid's own order."""
    side = grid_side(spark, d)
    raster = cell_table(spark, d).select(
        (F.lit(side - 1) - F.col("fi")).alias("row"),
        F.pmod(F.col("fj") - side // 2, F.lit(side)).alias("column"), F.col("land_share").alias("share"))
    out = regrid.align_raster(raster, side, side)
    return out.select((F.col("fi") * side + F.col("fj")).alias("cell"), "fi", "fj", "share")


@query("grid_nesting", """
f AS (SELECT DISTINCT 'lat' AS axis, fi AS p, lat AS x FROM cells UNION SELECT DISTINCT 'lon', fj, lon FROM cells),
c AS (SELECT DISTINCT 'lat' AS axis, ci AS q, avg(lat) AS x FROM cells GROUP BY ci UNION SELECT DISTINCT 'lon', cj, avg(lon) FROM cells GROUP BY cj),
j AS (SELECT f.axis, f.p, f.x, c.q, c.x + (CASE WHEN f.p % 2 = 0 THEN -0.5 ELSE 0.5 END) * (CASE WHEN f.axis = 'lat' THEN 120.0::DOUBLE ELSE 360.0::DOUBLE END) / side AS e,
  (CASE WHEN f.axis = 'lat' THEN 120.0::DOUBLE ELSE 360.0::DOUBLE END) / side AS st FROM f JOIN c ON c.axis = f.axis AND c.q = f.p // 2, grid)
SELECT axis, count(*) AS fine_cells, count(DISTINCT q) AS coarse_cells, bool_and(abs(x - e) < 1e-6) AS nested,
  abs(max(x) - min(x) + any_value(st) - 360) < 1e-6 AS circular FROM j GROUP BY axis""", "cells")
def grid_nesting(spark, d):
    side = grid_side(spark, d)
    cells = cell_table(spark, d)
    parts = []
    for axis, i, j, x, step in (("lat", "fi", "ci", "lat", 120.0 / side), ("lon", "fj", "cj", "lon", 360.0 / side)):
        fine = cells.select(F.lit(axis).alias("axis"), F.col(i).alias("position"), F.col(x).alias("coordinate")).distinct()
        coarse = cells.groupBy(F.lit(axis).alias("axis"), F.col(j).alias("position")).agg(F.avg(x).alias("coordinate"))
        parts.append(regrid.nesting_report(fine, coarse, 2, step))
    return parts[0].unionByName(parts[1])


@query("canonical_grid_assign", """
SELECT floor((lat + 90) / 1.0)::BIGINT AS row, floor(lon / 1.0)::BIGINT AS "column", floor(lat + 90) - 89.5 AS lat_center,
  floor(lon) + 0.5 AS lon_center, count(*) AS days, round(avg(tas), 6) AS tas FROM cube GROUP BY ALL""", "cube")
def canonical_grid_assign(spark, d):
    """Cube cells placed on the canonical one-degree grid by joining its axis tables."""
    lat, lon = regrid.canonical_axes()
    rows = regrid.axis_table(spark, lat, "row", "lat_center")
    columns = regrid.axis_table(spark, lon, "column", "lon_center")
    c = daily_cube(spark, d, "tas").withColumn("row", F.floor((F.col("lat") - lat.low) / lat.step)).withColumn(
        "column", F.floor((F.col("lon") - lon.low) / lon.step))
    means = c.groupBy("row", "column").agg(F.count(F.lit(1)).alias("days"), F.round(F.avg("tas"), 6).alias("tas"))
    return means.join(rows, "row").join(columns, "column")


@query("city_series", _NEAREST + """,
near AS (SELECT place, cell FROM x QUALIFY row_number() OVER (PARTITION BY place ORDER BY away, dist, cell) = 1),
y AS (SELECT cell, year, sum(greatest(0, tas - 273.15 - 55.0 / 3)) AS v FROM cube GROUP BY ALL),
k AS (SELECT cell, year, v, CASE WHEN count(v) OVER w >= 3 THEN avg(v) OVER w END AS smooth, regr_slope(v, year) OVER (PARTITION BY cell) * 10 AS trend
  FROM y WINDOW w AS (PARTITION BY cell ORDER BY year ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
SELECT place, year, round(v, 6) AS value, round(smooth, 6) AS smooth, round(trend, 5) AS trend FROM near JOIN k USING (cell)""", "cube", "cells")
def city_series(spark, d):
    """Annual cooling degree days at each place: nearest land cell, smoothed series and trend."""
    side = grid_side(spark, d)
    near = align.nearest_valid_cell(_places(spark, d), cell_table(spark, d).where("land"), side, -60.0, 120.0 / side)
    annual = indicators.annual_climate_indices(daily_cube(spark, d, "tas", "pr")).select(
        "cell", "year", F.col("cdd65").alias("value"))
    smooth = windows.gap_aware_mean(annual, ["cell"], "year", "value")
    trend = annual.groupBy("cell").agg(windows.trend_per_decade(F.col("value"), F.col("year")).alias("trend"))
    series = smooth.join(trend, "cell").join(near.select("place", "cell"), "cell")
    return rounded(rounded(series.select("place", "year", "value", "smooth", "trend"), 6, "value", "smooth"), 5, "trend")


@query("polygon_cells", """
p AS (SELECT c_custkey AS polygon, (c_custkey * 73 % 2400)::DOUBLE / 10 - 120 + 0.0137::DOUBLE AS x, (c_custkey * 37 % 700)::DOUBLE / 10 - 35 + 0.0071::DOUBLE AS y,
  5 + (c_custkey * 17 % 45)::DOUBLE AS a, 3 + (c_custkey * 11 % 17)::DOUBLE AS b FROM customer),
e AS (SELECT polygon, x - a AS x1, y - b AS y1, x + a AS x2, y - b / 2 AS y2 FROM p UNION ALL SELECT polygon, x + a, y - b / 2, x, y + b FROM p
  UNION ALL SELECT polygon, x, y + b, x - a, y - b FROM p),
k AS (SELECT cell, side, -60 + fi * 120.0::DOUBLE / side AS yl, 120.0::DOUBLE / side AS dy, CASE WHEN fj < side // 2 THEN fj ELSE fj - side END * 360.0::DOUBLE / side AS xl,
  360.0::DOUBLE / side AS dx FROM cells, grid),
c AS (SELECT polygon, cell, x1, y1, x2, y2, xl, yl, dx, dy, (x2 - x1) * (yl - y1) - (y2 - y1) * (xl - x1) AS s1, (x2 - x1) * (yl - y1) - (y2 - y1) * (xl + dx - x1) AS s2,
  (x2 - x1) * (yl + dy - y1) - (y2 - y1) * (xl - x1) AS s3, (x2 - x1) * (yl + dy - y1) - (y2 - y1) * (xl + dx - x1) AS s4 FROM e, k)
SELECT polygon, cell FROM c GROUP BY polygon, cell
HAVING bool_or(greatest(x1, x2) >= xl AND least(x1, x2) <= xl + dx AND greatest(y1, y2) >= yl AND least(y1, y2) <= yl + dy
    AND least(s1, s2, s3, s4) <= 0 AND greatest(s1, s2, s3, s4) >= 0)
  OR count(*) FILTER ((y1 <= yl + dy / 2) <> (y2 <= yl + dy / 2) AND x1 + (yl + dy / 2 - y1) * (x2 - x1) / nullif(y2 - y1, 0) > xl + dx / 2) % 2 = 1""", "cells")
def polygon_cells(spark, d):
    """Cells touched by one triangle per customer."""
    from ..operators import polygons

    side = grid_side(spark, d)
    key = F.col("c_custkey")
    shapes = table(spark, d, "customer").select(
        key.alias("polygon"), ((key * 73 % 2400) / 10 - 120 + 0.0137).alias("x"), ((key * 37 % 700) / 10 - 35 + 0.0071).alias("y"),
        (5 + key * 17 % 45).cast("double").alias("a"), (3 + key * 11 % 17).cast("double").alias("b"))
    def point(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    x, y, a, b = (F.col(n) for n in "xyab")
    rings = shapes.select("polygon", F.array(point(x - a, y - b), point(x + a, y - b / 2), point(x, y + b)).alias("points"))
    cells = cell_table(spark, d).select("cell", "fi", "fj")
    touched = polygons.touched_cells(rings, polygons.CellGrid(-60.0, 120.0 / side, side, side))
    # One small row per grid cell; sent to the touched cells, which are far more.
    return touched.join(F.broadcast(cells), ["fi", "fj"]).select("polygon", "cell")
