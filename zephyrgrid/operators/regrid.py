"""Regridding on regular grids: bilinear, linear, conservative, point samples, block sums."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import place_by


@dataclass(frozen=True)
class Axis:
    """A regular axis of cell centres."""

    first: float
    step: float
    size: int
    periodic: bool = False

    @property
    def low(self) -> float:
        return self.first - self.step / 2


def canonical_axes(rows: int = 180, columns: int = 360) -> tuple[Axis, Axis]:
    """Cell centres of the global grid: 1 degree by default."""
    return (
        Axis(-90.0 + 90.0 / rows, 180.0 / rows, rows),
        Axis(180.0 / columns, 360.0 / columns, columns, periodic=True),
    )


def nested_axes(coarse_first: float, coarse_step: float, coarse_size: int, factor: int) -> tuple[Axis, Axis]:
    """A coarse axis and the fine axis nested in it."""
    step = coarse_step / factor
    fine = Axis(coarse_first - coarse_step / 2 + step / 2, step, coarse_size * factor)
    return Axis(coarse_first, coarse_step, coarse_size), fine


def axis_table(spark: SparkSession, axis: Axis, index: str, coordinate: str) -> DataFrame:
    return spark.range(axis.size).select(
        F.col("id").alias(index), (F.lit(axis.first) + F.col("id") * F.lit(axis.step)).alias(coordinate))


def linear_weights(spark: SparkSession, source: Axis, target: Axis, names: tuple[str, str]) -> DataFrame:
    """(target index, source index, weight); ends clamp unless the axis is periodic."""
    center = F.lit(target.first) + F.col("id") * F.lit(target.step)
    position = (center - F.lit(source.first)) / F.lit(source.step)
    if not source.periodic:
        position = F.greatest(F.lit(0.0), F.least(F.lit(float(source.size - 1)), position))
    base = spark.range(target.size).select(F.col("id").alias(names[0]), position.alias("p"))
    base = base.withColumn("lo", F.floor("p")).withColumn("w", F.col("p") - F.floor("p"))
    pair = F.array(F.struct(F.col("lo").alias("s"), (1 - F.col("w")).alias("w")),
                   F.struct((F.col("lo") + 1).alias("s"), F.col("w").alias("w")))
    rows = base.select(names[0], F.explode(pair).alias("e")).where("e.w > 0")
    index = F.pmod(F.col("e.s"), F.lit(source.size)) if source.periodic else F.col("e.s")
    return rows.select(names[0], index.cast("bigint").alias(names[1]), F.col("e.w").alias("w"))


def overlap_weights(spark: SparkSession, source: Axis, target: Axis, names: tuple[str, str], spherical: bool) -> DataFrame:
    """(target index, source index, shared width); latitude widths are differences of sines."""
    low = F.lit(target.low) + F.col("id") * F.lit(target.step)
    high = F.lit(target.low) + (F.col("id") + 1) * F.lit(target.step)
    first = F.floor((low - F.lit(source.low)) / F.lit(source.step))
    last = F.floor((high - F.lit(source.low)) / F.lit(source.step))
    rows = spark.range(target.size).select(
        F.col("id").alias(names[0]), low.alias("low"), high.alias("high"), F.explode(F.sequence(first, last)).alias("s"))
    if not source.periodic:
        rows = rows.where(F.col("s").between(0, source.size - 1))
    a = F.greatest("low", F.lit(source.low) + F.col("s") * F.lit(source.step))
    b = F.least("high", F.lit(source.low) + (F.col("s") + 1) * F.lit(source.step))
    width = F.sin(F.radians(b)) - F.sin(F.radians(a)) if spherical else b - a
    index = F.pmod("s", F.lit(source.size)) if source.periodic else F.col("s")
    return rows.where(b > a).select(names[0], index.cast("bigint").alias(names[1]), width.alias("w"))


def apply_weights(df: DataFrame, lat_weights: DataFrame, lon_weights: DataFrame, value: str,
                  keys: tuple[str, ...], normalize: bool) -> DataFrame:
    """Separable weighted sum; a target with any missing or absent source value is missing.

    The latitude pass folds first, so the wider join meets fewer rows.
    """
    def fold(rows: DataFrame, weights: DataFrame, source: str, target: str, keep: list[str]) -> DataFrame:
        v = F.col(value)
        total = F.sum(F.col("w") * v)
        mean = total / F.sum("w") if normalize else total
        wanted = F.count(F.lit(1)).over(Window.partitionBy(target))
        complete = F.count(v) == F.max("wanted")
        return rows.join(weights.withColumn("wanted", wanted), source).groupBy(target, *keep).agg(F.when(complete, mean).alias(value))

    rows = fold(df.select("fi", "fj", *keys, value), lat_weights, "fi", "ti", ["fj", *keys])
    return fold(rows, lon_weights, "fj", "tj", ["ti", *keys])


def linear_regrid(df: DataFrame, source: tuple[Axis, Axis], target: tuple[Axis, Axis], value: str,
                  keys: tuple[str, ...] = ("ord",)) -> DataFrame:
    spark = df.sparkSession
    lat = linear_weights(spark, source[0], target[0], ("ti", "fi"))
    lon = linear_weights(spark, source[1], target[1], ("tj", "fj"))
    return apply_weights(df, lat, lon, value, keys, normalize=False)


def conservative_regrid(df: DataFrame, source: tuple[Axis, Axis], target: tuple[Axis, Axis], value: str,
                        keys: tuple[str, ...] = ("ord",)) -> DataFrame:
    spark = df.sparkSession
    lat = overlap_weights(spark, source[0], target[0], ("ti", "fi"), spherical=True)
    lon = overlap_weights(spark, source[1], target[1], ("tj", "fj"), spherical=False)
    return apply_weights(df, lat, lon, value, keys, normalize=True)


def coarse_neighbourhood(coarse: DataFrame, value: str, rows: int, columns: int, circular: bool = True,
                         keys: tuple[str, ...] = ("ord",), partition_by: str | None = None) -> DataFrame:
    """(coarse, ci, cj, *keys, v00..v22): each coarse value with its eight neighbours (v11 is its own).

    Every row goes to its neighbours, nine rows per coarse value; ``partition_by``
    places them by that column alone, for a caller that groups by it next.
    """
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    sent = coarse.select("ci", "cj", *keys, value, F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps])).alias("s"))
    target_j = F.col("cj") - F.col("s.b")
    if circular:
        target_j = F.pmod(target_j, F.lit(columns))
    sent = sent.select((F.col("ci") - F.col("s.a")).alias("ci"), target_j.alias("cj"), *keys, "s.a", "s.b", value)
    sent = sent.where(F.col("ci").between(0, rows - 1) & F.col("cj").between(0, columns - 1))
    sent = sent.withColumn("coarse", (F.col("ci") * columns + F.col("cj")).cast("bigint"))
    if partition_by is not None:
        sent = place_by(sent, partition_by)
    def corner(a: int, b: int):
        return F.max(F.when((F.col("a") == a) & (F.col("b") == b), F.col(value))).alias(f"v{a + 1}{b + 1}")

    near = sent.groupBy("coarse", "ci", "cj", *keys).agg(
        *[corner(a, b) for a, b in steps],
        F.count(F.when((F.col("a") == 0) & (F.col("b") == 0), 1)).alias("has"))
    return near.where("has > 0").drop("has")


def interpolated(offset_i, offset_j):
    """Bilinear blend at offsets (in coarse cells, -0.5..0.5) from the centre; else the centre's own value."""
    center = F.col("v11")
    side_i = F.when(offset_i < 0, F.col("v01")).otherwise(F.col("v21"))
    side_j = F.when(offset_j < 0, F.col("v10")).otherwise(F.col("v12"))
    diagonal = (
        F.when((offset_i < 0) & (offset_j < 0), F.col("v00"))
        .when(offset_i < 0, F.col("v02"))
        .when(offset_j < 0, F.col("v20"))
        .otherwise(F.col("v22"))
    )
    wi, wj = F.abs(offset_i), F.abs(offset_j)
    upper = F.when(wj == 0, center).otherwise((1 - wj) * center + wj * side_j)
    lower = F.when(wj == 0, side_i).otherwise((1 - wj) * side_i + wj * diagonal)
    blended = F.when(wi == 0, upper).otherwise((1 - wi) * upper + wi * lower)
    return F.coalesce(blended, center)


def offsets(rows: int, columns: int, factor: int) -> list[tuple[float, float]]:
    """Offsets of the fine cells of one coarse cell, row by row; a single-cell axis does not interpolate."""
    line = [(k + 0.5) / factor - 0.5 for k in range(factor)]
    return [(0.0 if rows == 1 else a, 0.0 if columns == 1 else b) for a in line for b in line]


def bilinear_arrays(near: DataFrame, rows: int, columns: int, factor: int, name: str) -> DataFrame:
    """Replace the neighbourhood columns by one array with the factor*factor fine values."""
    places = F.array(*[
        F.struct(F.lit(a).alias("i"), F.lit(b).alias("j")) for a, b in offsets(rows, columns, factor)])
    values = F.transform(places, lambda place: interpolated(place["i"], place["j"]))
    return near.withColumn(name, values)


def bilinear_broadcast(coarse: DataFrame, value: str, rows: int, columns: int, factor: int,
                       circular: bool = True, keys: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Spread coarse values (ci, cj, *keys, value) over nested fine cells, interpolating linearly.

    The shuffle carries nine rows per coarse value however large ``factor`` is;
    the fine cells are generated after it.
    """
    near = coarse_neighbourhood(coarse, value, rows, columns, circular, keys)
    arrays = bilinear_arrays(near, rows, columns, factor, "fine")
    return arrays.select("ci", "cj", *keys, F.posexplode("fine").alias("k", "x")).select(
        (F.col("ci") * factor + F.expr(f"k div {factor}")).cast("bigint").alias("fi"),
        (F.col("cj") * factor + F.col("k") % factor).cast("bigint").alias("fj"), *keys, F.col("x").alias(value))


def point_sample(points: DataFrame, field: DataFrame, north: float, step: float, rows: int, columns: int,
                 value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Bilinear value of a north-to-south global field at points; rows clamp, columns wrap.

    ``points`` has (point, plat, plon); ``field`` has (row, column, *keys, value).
    """
    y = (F.lit(north) - F.col("plat")) / F.lit(step)
    x = F.pmod("plon", F.lit(360.0)) / F.lit(360.0 / columns)
    # Every point stands for four corners times all keys: the number of tasks is named.
    corners = place_by(points, "point").select("point", y.alias("y"), x.alias("x")).select(
        "point", F.explode(F.array(*[
            F.struct(
                F.least(F.floor("y") + a, F.lit(rows - 1)).alias("row"),
                F.pmod(F.floor("x") + b, F.lit(columns)).alias("column"),
                ((F.col("y") - F.floor("y") if a else 1 - F.col("y") + F.floor("y"))
                 * (F.col("x") - F.floor("x") if b else 1 - F.col("x") + F.floor("x"))).alias("w"))
            for a in (0, 1) for b in (0, 1)])).alias("c")).select("point", "c.row", "c.column", "c.w")
    joined = corners.join(field.select("row", "column", *keys, F.col(value).alias("v")), ["row", "column"])
    complete = F.count("v") == 4
    return joined.groupBy("point", *keys).agg(F.when(complete, F.sum(F.col("w") * F.col("v"))).alias(value))


def block_sum(df: DataFrame, value: str, factor: int, *keys: str) -> DataFrame:
    return df.groupBy(F.expr(f"fi div {factor}").alias("bi"), F.expr(f"fj div {factor}").alias("bj"), *keys).agg(
        F.sum(F.coalesce(F.col(value), F.lit(0.0))).alias(value))


def chunk_groups(cells: DataFrame, rows: int, columns: int) -> DataFrame:
    """Cells of a sparse list grouped by storage chunk; a chunk holds rows*columns cells at most."""
    return cells.groupBy(F.expr(f"fi div {rows}").alias("chunk_row"), F.expr(f"fj div {columns}").alias("chunk_column")).agg(
        F.sort_array(F.collect_list("cell")).alias("cells"))


def align_raster(raster: DataFrame, rows: int, columns: int) -> DataFrame:
    """North-to-south, -180..180 raster indices to ascending latitude and 0..360 longitude."""
    return raster.withColumn("fi", (F.lit(rows - 1) - F.col("row")).cast("bigint")).withColumn(
        "fj", F.pmod(F.col("column") + columns // 2, F.lit(columns)).cast("bigint"))


def nesting_report(fine: DataFrame, coarse: DataFrame, factor: int, step: float) -> DataFrame:
    """Per axis: are the fine centres where an even division of the coarse cells puts them?

    Both tables have (axis, position, coordinate); ``step`` is the fine spacing.
    """
    parents = coarse.select("axis", F.col("position").alias("parent"), F.col("coordinate").alias("center"))
    child = fine.withColumn("parent", F.expr(f"position div {factor}"))
    within = F.col("position") - F.col("parent") * factor
    expected = F.col("center") + (within + 0.5 - factor / 2) * F.lit(step)
    joined = child.join(parents, ["axis", "parent"], "left")
    return joined.groupBy("axis").agg(
        F.count(F.lit(1)).alias("fine_cells"), F.count_distinct("parent").alias("coarse_cells"),
        F.bool_and(F.coalesce(F.abs(F.col("coordinate") - expected) < 1e-6, F.lit(False))).alias("nested"),
        (F.abs(F.max("coordinate") - F.min("coordinate") + step - 360.0) < 1e-6).alias("circular"))
