"""Which grid cells touch a polygon: by scan lines and edge boxes, as joins and windows.

Polygons are (polygon, points ARRAY<STRUCT<x, y>>) with x in -180..180; rings
need not repeat their first point.  The grid is (rows x columns) with an even
number of columns counted from longitude 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import place_by


@dataclass(frozen=True)
class CellGrid:
    south: float
    dlat: float
    rows: int
    columns: int

    @property
    def dlon(self) -> float:
        return 360.0 / self.columns

    def column_index(self, signed: Column) -> Column:
        """Column counted from longitude 0 of a column counted from -180."""
        return F.pmod(signed - self.columns // 2, F.lit(self.columns)).cast("bigint")


def ring_edges(polygons: DataFrame) -> DataFrame:
    """One row per edge: (polygon, x1, y1, x2, y2); the ring is closed here."""
    points = F.col("points")
    following = F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1))
    pairs = polygons.select("polygon", F.explode(F.arrays_zip(points.alias("a"), following.alias("b"))).alias("e"))
    return pairs.select("polygon", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"),
                        F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def boundary_cells(edges: DataFrame, grid: CellGrid) -> DataFrame:
    """Cells crossed by an edge: the edge's index box, then a side test of the cell corners."""
    def index(value: Column, origin: float, step: float, size: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(size - 1), F.floor((value - origin) / step)))

    low_y, high_y = F.least("y1", "y2"), F.greatest("y1", "y2")
    top = grid.south + grid.rows * grid.dlat
    inside = edges.where((high_y >= grid.south) & (low_y <= top))
    boxes = inside.withColumn("fi", F.explode(F.sequence(
        index(low_y, grid.south, grid.dlat, grid.rows), index(high_y, grid.south, grid.dlat, grid.rows)))).withColumn(
        "s", F.explode(F.sequence(index(F.least("x1", "x2"), -180.0, grid.dlon, grid.columns),
                                  index(F.greatest("x1", "x2"), -180.0, grid.dlon, grid.columns))))
    corners = [
        (F.col("x2") - F.col("x1")) * (grid.south + (F.col("fi") + a) * grid.dlat - F.col("y1"))
        - (F.col("y2") - F.col("y1")) * (-180.0 + (F.col("s") + b) * grid.dlon - F.col("x1"))
        for a in (0, 1) for b in (0, 1)]
    crossed = (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)
    return boxes.where(crossed).select("polygon", "fi", "s")


def interior_spans(edges: DataFrame, grid: CellGrid) -> DataFrame:
    """First and last column of the cells whose centre lies inside: crossings of a row's centre line, taken in pairs."""
    first = F.ceil((F.least("y1", "y2") - grid.south) / grid.dlat - 0.5)
    last = F.floor((F.greatest("y1", "y2") - grid.south) / grid.dlat - 0.5)
    lines = edges.where(first <= last).withColumn("fi", F.explode(F.sequence(first, last))).where(
        F.col("fi").between(0, grid.rows - 1))
    y = grid.south + (F.col("fi") + 0.5) * grid.dlat
    hits = lines.where((F.col("y1") <= y) != (F.col("y2") <= y)).select(
        "polygon", "fi", (F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x"))
    order = Window.partitionBy("polygon", "fi").orderBy("x")
    spans = hits.withColumn("n", F.row_number().over(order)).withColumn("end", F.lead("x").over(order)).where("n % 2 = 1")
    start = F.ceil((F.col("x") + 180.0) / grid.dlon - 0.5)
    stop = F.floor((F.col("end") + 180.0) / grid.dlon - 0.5)
    inside = spans.select("polygon", "fi", F.greatest(start, F.lit(0)).alias("start"), F.least(stop, F.lit(grid.columns - 1)).alias("stop"))
    return inside.where("start <= stop")


def touched_cells(polygons: DataFrame, grid: CellGrid) -> DataFrame:
    """Distinct (polygon, fi, fj) of all cells whose footprint a polygon touches.

    A footprint that holds a whole small polygon is crossed by its edges; one
    that lies wholly inside a polygon has its centre inside.  Polygons are placed
    once, by a named number of tasks, because each stands for many cells; what is
    sorted or grouped are outlines and spans, and only the result is unfolded.
    """
    edges = ring_edges(place_by(polygons, "polygon"))
    outline = boundary_cells(edges, grid).select("polygon", "fi", F.col("s").alias("start"), F.col("s").alias("stop"))
    rows = place_by(outline.unionByName(interior_spans(edges, grid)), "polygon").groupBy("polygon", "fi").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))
    columns = F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x["start"], x["stop"]))))
    return rows.select("polygon", "fi", F.explode(columns).alias("s")).select("polygon", "fi", grid.column_index(F.col("s")).alias("fj"))


def mapped_land(polygons: DataFrame, grid: CellGrid) -> DataFrame:
    """Cells touched by any polygon, for coastal planning."""
    return touched_cells(polygons, grid).select("fi", "fj").distinct()
