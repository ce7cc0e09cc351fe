"""Queries over packing, segments, stores, quality control and work planning."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import physics as ph
from ..operators import align, packing, qc
from ..session import cut_lineage, place_by, scalar_row, shared_directory
from ..sources import stores, versions
from ..sources.cube import cell_table, daily_cube, role_series, table
from .aggregate_queries import axis_days
from .registry import query, rounded
from .scalar_queries import TOP_SQL


@query("pack_int16", """
SELECT cell, ord, CASE WHEN tasm IS NULL THEN -32768 ELSE round_even((tasm - 253.5::DOUBLE) / 0.005::DOUBLE, 0) END::BIGINT AS tas,
  round_even((wind - 50) / 0.002::DOUBLE, 0)::BIGINT AS wind FROM cube""", "cube")
def pack_int16(spark, d):
    c = daily_cube(spark, d, "tasm", "wind")
    return c.select("cell", "ord", packing.pack(F.col("tasm"), *packing.specification("tas"), "tas").alias("tas"),
                    packing.pack(F.col("wind"), *packing.specification("sfcWind"), "wind").alias("wind"))


@query("unpack_int16", """
SELECT cell, ord, round(round_even((tasm - 253.5::DOUBLE) / 0.005::DOUBLE, 0) * 0.005 + 253.5, 6) AS tas,
  abs(round_even((tasm - 253.5::DOUBLE) / 0.005::DOUBLE, 0) * 0.005 + 253.5 - tasm) <= 0.0025 + 1e-9 AS within_half_step FROM cube""", "cube")
def unpack_int16(spark, d):
    spec = packing.specification("tas")
    c = daily_cube(spark, d, "tasm").withColumn("code", packing.pack(F.col("tasm"), *spec))
    c = c.withColumn("tas", packing.unpack(F.col("code"), *spec))
    return c.select("cell", "ord", F.round("tas", 6).alias("tas"),
                    (F.abs(F.col("tas") - F.col("tasm")) <= spec[0] / 2 + 1e-9).alias("within_half_step"))


@query("repack_int16", """
SELECT cell, ord, CASE WHEN tasm IS NULL THEN -32768 ELSE
  round_even((round_even((tasm - 253.5::DOUBLE) / 0.005::DOUBLE, 0) * 0.005::DOUBLE + 253.5::DOUBLE - 280) / 0.01::DOUBLE, 0) END::BIGINT AS code FROM cube""",
       "cube")
def repack_int16(spark, d):
    spec = packing.specification("tas")
    code = packing.pack(F.col("tasm"), *spec)
    return daily_cube(spark, d, "tasm").select("cell", "ord", code.alias("code")).withColumn(
        "code", packing.repack(F.col("code"), spec, (0.01, 280.0)))


@query("packing_report", """
SELECT count(tasm) AS valid, count(*) - count(tasm) AS missing, min(tasm) AS minimum, max(tasm) AS maximum,
  round(max(abs(round_even((tasm - 253.5::DOUBLE) / 0.005::DOUBLE, 0) * 0.005 + 253.5 - tasm)), 8) AS maximum_error,
  0::BIGINT AS saturated, 0::BIGINT AS infinite, TRUE AS valid_packing FROM cube""", "cube")
def packing_report(spark, d):
    out = packing.packing_report(daily_cube(spark, d, "tasm"), "tasm", *packing.specification("tas"))
    return rounded(out, 8, "maximum_error")


_DENSE_SQL = """
span AS (SELECT min(ord) AS lo, max(ord) AS hi, 1970 + (min(ord) // 365) AS y0, 1970 + (max(ord) // 365) AS y1 FROM cube),
dense AS (SELECT c.cell, days.ord, tas, y0, y1 FROM (SELECT DISTINCT cell FROM cube) c,
  (SELECT unnest(range(lo, hi + 1)) AS ord, y0, y1 FROM span) days LEFT JOIN cube ON cube.cell = c.cell AND cube.ord = days.ord),
parts AS (SELECT cell, ord, CASE WHEN tas IS NULL THEN -32768 ELSE round_even((tas - 253.5::DOUBLE) / 0.005::DOUBLE, 0) END::BIGINT AS code,
  least(2, (1970 + ord // 365 - y0) * 3 // (y1 - y0 + 1))::BIGINT AS segment FROM dense)
"""


def _dense_codes(spark, d):
    """Every cell on every day of the data's span, packed; gaps hold the missing code.  ``part`` is one of three runs of years."""
    spec = packing.specification("tas")
    c = daily_cube(spark, d, "tas")
    span = scalar_row(c.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")))
    lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, -1)
    first, years = 1970 + lo // 365, max(1, hi // 365 - lo // 365 + 1)
    # Each row is followed by the days up to the next one; only rows that hold a value are shuffled and sorted.
    series = Window.partitionBy("cell").orderBy("ord")
    rows = place_by(c.select("cell", "ord", "tas"), "cell").select(
        "cell", F.col("ord").alias("held"), "tas",
        F.when(F.lag("ord").over(series).isNull(), F.lit(lo)).otherwise(F.col("ord")).alias("start"),
        F.greatest(F.col("ord"), F.coalesce(F.lead("ord").over(series), F.lit(hi + 1)) - 1).alias("stop"))
    days = rows.withColumn("ord", F.explode(F.sequence("start", "stop")))
    return days.withColumn("tas", F.when(F.col("ord") == F.col("held"), F.col("tas"))).select(
        "cell", "ord", packing.pack(F.col("tas"), *spec).alias("code"),
        F.least(F.lit(2), F.expr(f"(1970 + ord div 365 - {first}) * 3 div {years}")).alias("part"))


def _merged(spark, d):
    dense = _dense_codes(spark, d)
    parts = [dense.where(F.col("part") == i).drop("part") for i in range(3)]
    return packing.merge_segments(parts, [packing.specification("tas")] * len(parts), ["cell"])


@query("merge_segments", _DENSE_SQL + "SELECT cell, ord, code, segment FROM parts", "cube")
def merge_segments(spark, d):
    """Stacked segments of gap-free series; the operator refuses a seam that is not one day apart."""
    return _merged(spark, d)


@query("segment_boundaries", _DENSE_SQL.rstrip() + """,
g AS (SELECT cell, segment, min(ord) AS first, max(ord) AS last FROM parts GROUP BY ALL)
SELECT * FROM (SELECT cell, segment, first, last, lag(last) OVER w AS previous, first - lag(last) OVER w = 1 AS daily FROM g
  WINDOW w AS (PARTITION BY cell ORDER BY segment)) WHERE previous IS NOT NULL""", "cube")
def segment_boundaries(spark, d):
    return packing.segment_boundaries(_merged(spark, d), ["cell"])


@query("history_concat", _DENSE_SQL + "SELECT cell, ord, code, segment = 0 AS is_history FROM parts", "cube")
def history_concat(spark, d):
    """The first run of years in front of all later ones; the operator refuses a gap between them."""
    dense = _dense_codes(spark, d)
    return align.concatenate_history(dense.where("part = 0").drop("part"), dense.where("part > 0").drop("part"), ["cell"])


@query("append_segment", """
mid AS (SELECT (min(ord) + max(ord)) // 2 AS half FROM cube)
SELECT cell, ord, tas FROM cube, mid WHERE ord > half + 365""", "cube")
def append_segment(spark, d):
    """The later half of the series, given again with a year of overlap, adds only what the store lacks."""
    c = daily_cube(spark, d, "tas").select("cell", "ord", "tas")
    span = scalar_row(c.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")))
    middle = ((span["lo"] or 0) + (span["hi"] or 0)) // 2
    fresh = packing.append_new_rows(c.where(F.col("ord") <= middle + 365), c.where(F.col("ord") > middle), ["cell", "ord"])
    return fresh.select("cell", "ord", "tas")


@query("qc_time", """
s AS (SELECT cell, ord - lag(ord) OVER (PARTITION BY cell ORDER BY ord) AS step FROM cube)
SELECT cell, count(*) AS days, count(*) FILTER (step <= 0) = 0 AS time_monotonic, count(*) FILTER (step = 0) = 0 AS time_unique,
  count(*) FILTER (step <> 1) = 0 AS daily_without_gaps, count(*) >= 5 * 365 AS training_period_sufficient FROM s GROUP BY cell""", "cube")
def qc_time(spark, d):
    return qc.time_checks(daily_cube(spark, d, "tas"), ["cell"], 5)


_QC_VARIABLES = ("tasm", "hurs", "pr", "wind", "prsnratio", "tasskew", "ps", "rlds", "tasrange")


@query("qc_variables", """
n AS (SELECT count(DISTINCT ord) AS days FROM cube),
l AS (UNPIVOT (SELECT cell, tasm + 0.0 AS tas, hurs, pr, wind, prsnratio, tasskew, ps, rlds, tasrange FROM cube)
  ON tas, hurs, pr, wind, prsnratio, tasskew, ps, rlds, tasrange INTO NAME variable VALUE value),
p AS (SELECT variable, cell, count(value) AS v, min(value) AS low, max(value) AS high,
  count(*) FILTER (CASE WHEN variable = 'tas' THEN value <= 130 OR value >= 377 WHEN value < 0 THEN TRUE
    WHEN variable = 'hurs' THEN value > 100 WHEN variable = 'pr' THEN value > 3000
    WHEN variable IN ('prsnratio', 'tasskew') THEN value > 1 ELSE FALSE END) AS bad,
  count(*) FILTER (variable = 'wind' AND value > 46) AS strong FROM l GROUP BY ALL)
SELECT variable, min(low) AS minimum, max(high) AS maximum, round(sum(v) / (count(*) * any_value(days)), 8) AS finite_fraction,
  count(*) FILTER (v = 0) AS all_missing_cells, count(*) FILTER (v > 0 AND v / days < 0.75) AS partial_cells, 0::BIGINT AS infinite_values,
  sum(bad) = 0 AS bounds_ok, sum(strong) > 0 AS wind_warning, count(*) FILTER (v > 0 AND v / days < 0.75) = 0 AND sum(bad) = 0 AS valid
FROM p, n GROUP BY variable""", "cube")
def qc_variables(spark, d):
    c = daily_cube(spark, d, *_QC_VARIABLES).withColumnRenamed("tasm", "tas")
    names = ["tas" if v == "tasm" else v for v in _QC_VARIABLES]
    return rounded(qc.variable_report(c, names, axis_days(c), 0.75), 8, "finite_fraction")


@query("qc_shortwave_bounds", TOP_SQL + """
SELECT fi, count(*) FILTER (ra > 0 AND (rsds / ra < 0 OR rsds / ra > 1)) = 0 AS bounds_ok, count(rsds) AS "values" FROM top GROUP BY fi""", "cube")
def qc_shortwave_bounds(spark, d):
    c = ph.with_top_radiation(daily_cube(spark, d, "rsds"))
    return c.groupBy("fi").agg(qc.bounds_hold("rsds").alias("bounds_ok"), F.count("rsds").alias("values"))


@query("qc_linked_consistency", """
SELECT TRUE AS temperature_order, TRUE AS snow_within_rain, TRUE AS tasmin_consistent, bool_and(abs(tas + (1 - tasskew) * tasrange
  - (tas + (1 - tasskew) * tasrange + CASE WHEN ord % 1000 = 0 THEN 0.01 ELSE 0 END)) <= 1e-8 + 1e-6 * 300) AS tasmax_consistent,
  TRUE AS prsn_consistent, FALSE AS valid FROM cube""", "cube")
def qc_linked_consistency(spark, d):
    """tasmax is off by 0.01 K on every thousandth day, which the check must find."""
    c = ph.derive_components(daily_cube(spark, d, "tas", "tasrange", "tasskew", "pr", "prsnratio"))
    c = c.withColumn("tasmax", F.col("tasmax") + F.when(F.col("ord") % 1000 == 0, 0.01).otherwise(0.0))
    return qc.linked_consistency(c)


@query("qc_tile", """
n AS (SELECT count(DISTINCT ord) AS days FROM cube),
w AS (SELECT coarse, cell, count(tasm) AS n, min(tasm) AS low, max(tasm) AS high FROM cube GROUP BY ALL),
e AS (SELECT coarse, cell, count(tas) > 0 AS x FROM roles JOIN (SELECT cell, code FROM cells) USING (cell) WHERE role = 'ref' AND code > 0 GROUP BY ALL)
SELECT coarse, count(*) FILTER (coalesce(n, 0) > 0) AS active_cells, count(*) FILTER (n > 0 AND n / days < 0.75) AS partial_cells,
  count(*) FILTER (coalesce(x, FALSE) AND coalesce(n, 0) = 0) AS missing_reference_cells,
  count(*) FILTER (NOT coalesce(x, FALSE) AND n > 0) AS extra_cells, min(low) AS minimum, max(high) AS maximum,
  0::BIGINT AS infinite_cells, 0::BIGINT AS static_cells,
  count(*) FILTER (n > 0 AND n / days < 0.75) + count(*) FILTER (coalesce(x, FALSE) AND coalesce(n, 0) = 0)
    + count(*) FILTER (NOT coalesce(x, FALSE) AND n > 0) = 0 AS valid
FROM w FULL JOIN e USING (coarse, cell), n GROUP BY coarse""", "cube", "roles", "cells")
def qc_tile(spark, d):
    written = daily_cube(spark, d, "tasm").withColumnRenamed("tasm", "tas")
    sources = cell_table(spark, d).where("code > 0").select("cell")
    reference = role_series(spark, d, "ref", "tas").join(sources, "cell", "left_semi")
    return qc.tile_report(written, reference, "tas", axis_days(written), "coarse", 0.75)


@query("metadata_checks", """
SELECT p_type AS variable, bool_and(p_size < 50) AS unit_ok, CASE WHEN min(p_brand) <> 'Brand#11' OR min(p_brand) IS NULL THEN 'standard_name differs' END AS warning
FROM part GROUP BY p_type""", "grid")
def metadata_checks(spark, d):
    """Declared against expected metadata, one row per kind of part."""
    found = table(spark, d, "part").groupBy(F.col("p_type").alias("variable")).agg(
        F.when(F.max("p_size") < 50, "K").otherwise("degC").alias("unit"), F.min("p_brand").alias("standard_name"))
    expected = found.select("variable", F.lit("K").alias("expected_unit"), F.lit("Brand#11").alias("expected_name"))
    return qc.metadata_checks(found, expected)


@query("product_coverage", """
SELECT year, count(*) FILTER (land AND tasm IS NULL) AS land_gaps, count(*) FILTER (NOT land AND tasm IS NOT NULL) AS ocean_leaks
FROM cube JOIN (SELECT cell, land FROM cells) USING (cell) GROUP BY year""", "cube", "cells")
def product_coverage(spark, d):
    packed = daily_cube(spark, d, "tasm").withColumn("code", packing.pack(F.col("tasm"), *packing.specification("tas")))
    joined = packed.join(cell_table(spark, d).select("cell", "land"), "cell")
    valid = F.col("code") != packing.FILL
    return joined.groupBy("year").agg(F.count_if(F.col("land") & ~valid).alias("land_gaps"),
                                      F.count_if(~F.col("land") & valid).alias("ocean_leaks"))


_STATES = """m AS (SELECT o_orderpriority AS model, o_orderstatus AS scenario, year(o_orderdate) AS variable, min(o_orderdate)::DATE AS first_day,
  max(o_orderdate)::DATE AS last_day, count(*) AS days FROM orders GROUP BY ALL),
k AS (SELECT model, scenario, count(*) AS stores, count(*) FILTER (days >= 60) AS ready_stores, bool_or(days % 5 = 0) AS published FROM m GROUP BY ALL),
h AS (SELECT o_orderpriority AS model, count(*) % 2 = 0 AS shared FROM orders GROUP BY ALL)"""


@query("queue_plan", _STATES + """
SELECT model, scenario, CASE WHEN published THEN 'complete' WHEN stores = ready_stores THEN 'ready' ELSE 'blocked' END AS status,
  coalesce(shared, FALSE) AS history_reusable, stores - ready_stores AS errors,
  CAST(row_number() OVER (ORDER BY CASE WHEN published THEN 1 WHEN stores = ready_stores THEN 0 ELSE 2 END, NOT coalesce(shared, FALSE), model, scenario) AS BIGINT) AS position
FROM k LEFT JOIN h USING (model)""", "grid")
def queue_plan(spark, d):
    from .queue import plan_queue

    orders = table(spark, d, "orders")
    inventory = orders.groupBy(
        F.col("o_orderpriority").alias("model"), F.col("o_orderstatus").alias("scenario"), F.year("o_orderdate").alias("variable")
    ).agg(F.count(F.lit(1)).alias("days"))
    published = inventory.groupBy("model", "scenario").agg(F.bool_or(F.col("days") % 5 == 0).alias("complete"))
    history = orders.groupBy(F.col("o_orderpriority").alias("model")).agg((F.count(F.lit(1)) % 2 == 0).alias("reusable"))
    return plan_queue(inventory.withColumn("ready", F.col("days") >= 60), published, history)


@query("tile_plan", """
SELECT fi // 2 AS tile_row, fj // 2 AS tile_column, min(fi) AS first_row, max(fi) + 1 AS end_row, min(fj) AS first_column, max(fj) + 1 AS end_column,
  count(*) AS active_cells FROM cells WHERE land GROUP BY ALL""", "cells")
def tile_plan(spark, d):
    return stores.tiles(cell_table(spark, d).where("land"), 2, 2)


@query("store_digest", """
SELECT year, count(*) AS n, sum(code)::BIGINT AS total, min(code) AS low, max(code) AS high
FROM (SELECT year, round_even((tas - 253.5::DOUBLE) / 0.005::DOUBLE, 0)::BIGINT AS code FROM cube) GROUP BY year""", "cube")
def store_digest(spark, d):
    """Order-free summary of packed codes, used to compare two runs."""
    c = daily_cube(spark, d, "tas").select("year", packing.pack(F.col("tas"), *packing.specification("tas")).cast("bigint").alias("code"))
    return c.groupBy("year").agg(F.count("code").alias("n"), F.sum("code").alias("total"), F.min("code").alias("low"), F.max("code").alias("high"))


@query("date_lookup", """
SELECT cell, count(*) FILTER (year = 1997) AS days_in_year, count(*) FILTER (year = 1997 AND month = 3 AND day = 1) AS matches,
  min(ord) FILTER (year = 1997 AND month = 3 AND day = 1) IS NOT NULL AS found FROM cube GROUP BY cell""", "cube")
def date_lookup(spark, d):
    hit = F.expr("year = 1997 AND month = 3 AND day = 1")
    return daily_cube(spark, d, "tas").groupBy("cell").agg(
        F.count_if(F.col("year") == 1997).alias("days_in_year"), F.count_if(hit).alias("matches"), (F.count_if(hit) > 0).alias("found"))


@query("edge_sample", """
SELECT a_cell, b_cell, pair FROM (
  SELECT a.cell AS a_cell, b.cell AS b_cell, CASE WHEN a.code = b.code THEN 'same-' || a.code ELSE least(a.code, b.code) || '-' || greatest(a.code, b.code) END AS pair,
    row_number() OVER (PARTITION BY CASE WHEN a.code = b.code THEN 'same-' || a.code ELSE least(a.code, b.code) || '-' || greatest(a.code, b.code) END
      ORDER BY (a.cell * 2654435761 + b.cell * 40503) % 1000003, a.cell, b.cell) AS r
  FROM cells a, cells b, grid WHERE a.code > 0 AND b.code > 0
    AND ((b.fi = a.fi + 1 AND b.fj = a.fj) OR (b.fi = a.fi AND b.fj = (a.fj + 1) % side))) WHERE r <= 3""", "cells")
def edge_sample(spark, d):
    """A fixed number of edges per source pair, chosen by a stable hash."""
    from ..operators import aggregate as agg
    from ..sources.cube import grid_side

    edges = agg.neighbour_edges(cell_table(spark, d), grid_side(spark, d), "code")
    edges = edges.withColumn("pair", agg.source_pair(F.col("a_code"), F.col("b_code"))).where("pair IS NOT NULL")
    return qc.sample_edges(edges, "pair", 3).select("a_cell", "b_cell", "pair")


@query("json_report", """
SELECT cell, '{"cell":' || cell || ',"days":' || count(*) || ',"years":' || count(DISTINCT year) || '}' AS report FROM cube GROUP BY cell""", "cube")
def json_report(spark, d):
    c = daily_cube(spark, d, "tas").groupBy("cell").agg(F.count(F.lit(1)).alias("days"), F.count_distinct("year").alias("years"))
    return c.select("cell", stores.json_report("cell", "days", "years").alias("report"))


@query("store_roundtrip", "SELECT cell, ord, tas FROM cube", "cube")
def store_roundtrip(spark, d):
    """Write to a staging folder, publish, and read back by year partition."""
    path = f"{shared_directory(spark)}/store-roundtrip-{uuid.uuid4().hex}"
    c = daily_cube(spark, d, "tas").select("cell", "ord", "year", "tas")
    stores.publish(c, path, partition_by=["year"], overwrite=True)
    return spark.read.parquet(path).select("cell", "ord", "tas")


@query("array_store_roundtrip", """
SELECT cell, ord, year, round(lat, 9) AS lat, round(CASE WHEN tasm IS NOT NULL THEN round_even((tasm - 253.5::DOUBLE) / 0.005::DOUBLE, 0) * 0.005::DOUBLE + 253.5 END, 6) AS tas
FROM cube WHERE tasm IS NOT NULL AND lat > 0 AND ord BETWEEN 27 * 365 AND 29 * 365 + 100""", "cube")
def array_store_roundtrip(spark, d):
    """The whole cube as a chunked array of packed codes, of which two years and a hemisphere are read back."""
    from ..sources import arrays
    from ..sources.cube import grid_side
    from ..operators.regrid import Axis

    side = grid_side(spark, d)
    c = daily_cube(spark, d, "tasm").withColumnRenamed("tasm", "tas")
    span = scalar_row(c.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")))
    days = (span["lo"], span["hi"] + 1) if span["lo"] is not None else (0, 0)
    path = f"{shared_directory(spark).removeprefix('file:')}/array-{uuid.uuid4().hex}.zarr"
    arrays.write_array(c, path, "tas", days, Axis(-60 + 60 / side, 120 / side, side), Axis(180 / side, 360 / side, side),
                       "time=180,lat=8,lon=8", packing.specification("tas"), "K")
    back = arrays.open_array(spark, path, "tas").where(f"lat > 0 AND ord BETWEEN {27 * 365} AND {29 * 365 + 100} AND tas IS NOT NULL")
    return back.select((F.col("fi") * side + F.col("fj")).alias("cell"), "ord", "year", F.round("lat", 9).alias("lat"), F.round("tas", 6).alias("tas"))


_TILE = 8


def _versioned(spark, d, columns=("tas",)):
    """A store of the cube's earlier half, to which the later half comes with a year of overlap; (path, cube)."""
    path = f"{shared_directory(spark)}/versions-{uuid.uuid4().hex}"
    c = cut_lineage(daily_cube(spark, d, *columns).select("cell", "ord", *columns))
    span = scalar_row(c.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")))
    middle = ((span["lo"] or 0) + (span["hi"] or 0)) // 2
    versions.create(c.where(F.col("ord") <= middle + 365), path, _TILE)
    versions.append(c.where(F.col("ord") > middle), path, tile_cells=_TILE)
    return path, c


@query("zone_mapped_append", f"""
SELECT year, cell // {_TILE} AS tile, min(ord) AS first, max(ord) AS last, count(*) AS "rows" FROM cube GROUP BY ALL""", "cube")
def zone_mapped_append(spark, d):
    """What the manifest says of every (year, tile) after an append that overlapped the store by a year."""
    path, _ = _versioned(spark, d)
    return versions.entries(spark, path).groupBy("year", "tile").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"))


@query("version_read", "SELECT cell, ord, tas FROM cube WHERE ord BETWEEN 27 * 365 AND 28 * 365 + 90", "cube")
def version_read(spark, d):
    """Days across both segments, from the files whose zones hold them."""
    path, _ = _versioned(spark, d)
    return versions.read(spark, path, days=(27 * 365, 28 * 365 + 91)).select("cell", "ord", "tas")


@query("clone_differences", f"""
SELECT year, cell // {_TILE} AS tile, count(*) AS rows_before, count(*) AS rows_after, round(avg(tas), 6) AS mean_before,
  round(avg(tas + CASE WHEN ord % 2 = 0 THEN 0.5 ELSE 0 END), 6) AS mean_after, sum(CASE WHEN ord % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS changed
FROM cube WHERE year = 1997 AND (cell // {_TILE}) % 2 = 0 GROUP BY ALL""", "cube")
def clone_differences(spark, d):
    """A clone with one year of every second tile rebuilt: which partitions differ from the original, and by how much."""
    path, _ = _versioned(spark, d)
    other = f"{path}-clone"
    versions.clone(spark, path, other)
    region = versions.read(spark, other, days=(27 * 365, 28 * 365)).where(f"(cell div {_TILE}) % 2 = 0")
    versions.replace_region(region.withColumn("tas", F.col("tas") + F.when(F.col("ord") % 2 == 0, 0.5).otherwise(0.0)), other, tile_cells=_TILE)
    changed = versions.changed_partitions(versions.entries(spark, path), versions.entries(spark, other))
    zone = [r["tile"] for r in changed.select("tile").distinct().collect()]
    years = scalar_row(changed.agg(F.min("year").alias("lo"), F.max("year").alias("hi")))
    days = ((years["lo"] - 1970) * 365, (years["hi"] - 1969) * 365) if zone else (0, 0)
    sides = [versions.read(spark, p, days=days, tiles=zone).select("cell", "ord", F.col("tas").alias(n)) for p, n in ((path, "before"), (other, "after"))]
    pairs = sides[0].join(sides[1], ["cell", "ord"]).withColumns({"year": versions.year_of(), "tile": F.expr(f"cell div {_TILE}")})
    means = pairs.groupBy("year", "tile").agg(F.round(F.avg("before"), 6).alias("mean_before"), F.round(F.avg("after"), 6).alias("mean_after"),
                                              F.count_if(F.col("before") != F.col("after")).alias("changed"))
    return changed.join(means, ["year", "tile"])
