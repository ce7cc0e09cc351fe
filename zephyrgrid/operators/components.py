"""Connected components of masked cells on a grid that wraps in longitude."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scalar_row

SALTS = 16


def _touching(mask: DataFrame, side_columns: int) -> DataFrame:
    steps = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))
        for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)
    ])
    wanted = mask.select("cell", "fi", "fj", F.explode(steps).alias("s")).select(
        "cell", (F.col("fi") + F.col("s.a")).alias("fi"),
        F.pmod(F.col("fj") + F.col("s.b"), F.lit(side_columns)).alias("fj"))
    return wanted.join(mask.select(F.col("cell").alias("other"), "fi", "fj"), ["fi", "fj"]).select("cell", "other")


def periodic_components(mask: DataFrame, columns: int) -> DataFrame:
    """(cell, label) for the cells in ``mask``; the label is the smallest cell of the component.

    Every round takes the smallest label among the neighbours, then follows the
    label's own label, so chains shorten geometrically.  A cell has at most
    eight neighbours, so the first join has no hot key.  The second does, once a
    component holds much of the grid: its few labels are collapsed first and
    salted for the join back.
    """
    edges = cut_lineage(_touching(mask, columns))
    labels = cut_lineage(mask.select("cell", F.col("cell").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("cell").alias("other"), F.col("label").alias("seen")), "other")
        lowest = near.groupBy("cell").agg(F.min("seen").alias("seen"))
        hooked = labels.join(lowest, "cell", "left").select(
            "cell", F.col("label").alias("old"), F.least("label", F.coalesce("seen", "label")).alias("label"))
        hooked = hooked.persist()
        roots = hooked.select("label").distinct().join(
            hooked.select(F.col("cell").alias("label"), F.col("label").alias("root")), "label")
        salted = roots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        jumped = hooked.withColumn("salt", F.pmod("cell", F.lit(SALTS)).cast("int")).join(
            salted, ["label", "salt"]).select("cell", "old", F.col("root").alias("label"))
        jumped = cut_lineage(jumped)
        hooked.unpersist()
        moved = scalar_row(jumped.agg(F.count_if(F.col("label") != F.col("old")).alias("n")))["n"]
        labels = jumped.select("cell", "label")
        if moved == 0:
            return labels


def cluster_records(cells: DataFrame, labels: DataFrame, area: str, half_step: tuple[float, float]) -> DataFrame:
    """Size, area, weighted centroid and bounding box per component, largest area first."""
    joined = cells.join(labels, "cell").groupBy("label").agg(
        F.count(F.lit(1)).alias("cells"), F.sum(area).alias("area"),
        F.sum(F.col(area) * F.col("lat")).alias("wlat"), F.sum(F.col(area) * F.col("lon")).alias("wlon"),
        F.avg("lat").alias("mlat"), F.avg("lon").alias("mlon"),
        (F.min("lat") - half_step[0]).alias("south"), (F.max("lat") + half_step[0]).alias("north"),
        (F.min("lon") - half_step[1]).alias("west"), (F.max("lon") + half_step[1]).alias("east"))
    weighted = F.col("area") > 0
    return joined.select(
        "label", "cells", "area",
        F.when(weighted, F.try_divide("wlat", "area")).otherwise(F.col("mlat")).alias("centroid_lat"),
        F.when(weighted, F.try_divide("wlon", "area")).otherwise(F.col("mlon")).alias("centroid_lon"),
        "south", "north", "west", "east").orderBy(F.desc("area"), "label")
