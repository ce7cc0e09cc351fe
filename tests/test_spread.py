"""Steps whose few input bytes stand for many rows: what is unfolded, where, and into how many tasks."""

import math

from pyspark.sql import functions as F

from zephyrgrid.operators import align, polygons, regrid
from zephyrgrid.plans import storage_queries


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def _unfolded_inputs(df):
    """Of every row-multiplying step of a plan: the text of what lies below it."""
    lines = _plan(df)
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    below = []
    for at, x in enumerate(lines):
        if "Generate explode" in x:
            end = next((k for k in range(at + 1, len(lines)) if depth[k] <= depth[at]), len(lines))
            below.append("\n".join(lines[at:end]))
    return below


def _grid(spark, side):
    return spark.range(side * side).select(
        F.col("id").alias("cell"), F.expr(f"id div {side}").alias("fi"), (F.col("id") % side).alias("fj"),
        (-60 + (F.expr(f"id div {side}") + 0.5) * 120.0 / side).alias("lat"), ((F.col("id") % side + 0.5) * 360.0 / side).alias("lon"))


def test_windows_of_the_nearest_cell_are_not_unfolded_per_place(spark):
    side = 20
    cells = _grid(spark, side).where("cell % 3 = 0")
    places = spark.range(400).select(F.col("id").alias("place"), (F.col("id") * 37 % 1100 / 10 - 55).alias("plat"), (F.col("id") * 73 % 3600 / 10).alias("plon"))
    places = places.unionByName(places.limit(3).withColumn("place", F.col("place") + 1000))
    near = align.nearest_valid_cell(places, cells, side, -60.0, 120.0 / side)
    assert _unfolded_inputs(near) and not any("plat#" in x for x in _unfolded_inputs(near))
    got = {r.place: (r.cell, r.distance2) for r in near.collect()}
    held = {r.cell: r for r in cells.collect()}
    for p in places.collect():
        i, j = int((p.plat + 60) // (120 / side)), int(p.plon // (360 / side))
        ranks = []
        for c in held.values():
            b = (c.fj - j + side // 2 - 1) % side - side // 2 + 1
            if abs(c.fi - i) > 8 or not -8 <= b <= 8:
                continue
            dx = (c.lon - p.plon + 180) % 360 - 180
            d = (c.lat - p.plat) ** 2 + (dx * math.cos(math.radians(p.plat))) ** 2
            ranks.append(((c.fi, c.fj) != (i, j), round(d, 6), c.cell))
        assert got[p.place] == (min(ranks)[2], min(ranks)[1])
    assert len(got) == 403


def _places(spark):
    return spark.range(40).select(
        F.col("id").alias("place"), (F.col("id") % 20 * 5 - 50.0).alias("plat"), (F.col("id") % 20 * 17.0 + 1).alias("plon"))


def test_places_at_the_same_coordinates_share_one_ring(spark):
    side = 20
    rings = align.ring_cells(_places(spark), _grid(spark, side), side, -60.0, 120.0 / side, 200.0, 1200.0)
    below = _unfolded_inputs(rings)
    assert below and not any("place#" in x for x in below)
    assert all("RepartitionByExpression" in x for x in below)
    got = {}
    for r in rings.collect():
        got.setdefault(r.place, set()).add((r.cell, round(r.km, 6)))
    cells = _grid(spark, side).collect()
    for p in _places(spark).collect():
        want = set()
        for c in cells:
            a, b = math.radians(p.plat), math.radians(c.lat)
            h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(c.lon - p.plon) / 2) ** 2
            km = 2 * align.ph.EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, h)))
            if 200.0 <= km <= 1200.0:
                want.add((c.cell, round(km, 6)))
        assert {c for c, _ in got.get(p.place, ())} == {c for c, _ in want}


def test_touched_cells_are_not_grouped_one_by_one(spark):
    shapes = spark.range(50).select(F.col("id").alias("polygon"), F.array(*[
        F.struct((F.col("id") * 5 - 150.0 + x).alias("x"), (F.col("id") % 9 * 10 - 45.0 + y).alias("y"))
        for x, y in ((0, 0), (40, 0), (40, 25), (0, 25))]).alias("points"))
    grid = polygons.CellGrid(-60.0, 6.0, 20, 20)
    touched = polygons.touched_cells(shapes, grid)
    below = _unfolded_inputs(touched)
    assert all("RepartitionByExpression" in x for x in below)
    assert not any("Aggregate [" in x and "fj#" in x for x in _plan(touched))
    got = [(r.polygon, r.fi, r.fj) for r in touched.collect()]
    want = set()
    for k in range(50):
        x0, y0 = k * 5 - 150.0, k % 9 * 10 - 45.0
        for fi in range(20):
            for s in range(20):
                south, west = -60.0 + fi * 6.0, -180.0 + s * 18.0
                if south <= y0 + 25 and south + 6.0 >= y0 and west <= x0 + 40 and west + 18.0 >= x0:
                    want.add((k, fi, (s - 10) % 20))
    assert len(got) == len(set(got))
    # A cell that meets the outline in its edge only belongs to one of two neighbours; all others are fixed.
    inner = {(k, fi, fj) for k, fi, fj in want
             if -60.0 + fi * 6.0 < k % 9 * 10 - 20.0 and -54.0 + fi * 6.0 > k % 9 * 10 - 45.0
             and -180.0 + (fj + 10) % 20 * 18.0 < k * 5 - 110.0 and -162.0 + (fj + 10) % 20 * 18.0 > k * 5 - 150.0}
    assert inner <= set(got) <= want


def test_sampled_points_are_placed_before_they_unfold(spark):
    points = spark.range(30).select(F.col("id").alias("point"), (F.col("id") - 15.3).alias("plat"), (F.col("id") * 11.7).alias("plon"))
    field = spark.range(400).select(F.expr("id div 20").alias("row"), (F.col("id") % 20).alias("column"), F.col("id").cast("double").alias("v"))
    below = _unfolded_inputs(regrid.point_sample(points, field, 57.0, 6.0, 20, 20, "v"))
    assert below and all("RepartitionByExpression" in x for x in below)


def test_days_without_a_value_are_neither_shuffled_nor_joined(spark):
    dense = storage_queries._dense_codes(spark, "/root/testdata/sf0.001")
    assert not any("Join LeftOuter" in x for x in _plan(dense))
    assert any("RepartitionByExpression" in x and "Window" in x for x in _unfolded_inputs(dense))
    per_cell = dense.groupBy("cell").agg(F.count("*").alias("n"), F.countDistinct("ord").alias("days"), F.min("ord").alias("lo"), F.max("ord").alias("hi"))
    spans = per_cell.select("n", "days", "lo", "hi").distinct().collect()
    assert len(spans) == 1 and spans[0].n == spans[0].days == spans[0].hi - spans[0].lo + 1
