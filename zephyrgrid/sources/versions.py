"""Stores with versions: a manifest says which files a version consists of and what lies in each.

Rows (cell, ord, ...) are kept in files of one year and one tile of cells.  A manifest has
a row per file: year, tile, first and last day, number of rows and an order-free digest.
From it a reader knows which files its days and tiles can be in, an append which few files
may already hold a day, and a comparison which partitions differ at all.

Files never change.  Appending adds files, replacing a region swaps the entries of its
partitions, cloning copies entries only.  A version becomes visible by creating its
number exclusively; of two writers that started from the same version one fails with
`Conflict` and leaves the store as it was.  Data written by a job that fails is
never listed, so it is never read.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, place_by
from .stores import _file_system, children, exists

TILE_CELLS = 64
PARTITION = ["year", "tile"]
_ENTRIES = ["file", "year", "tile", "first", "last", "rows", "digest"]


class Conflict(RuntimeError):
    """Another writer made the next version first."""


def year_of(ord_: Column | str = "ord") -> Column:
    column = F.col(ord_) if isinstance(ord_, str) else ord_
    return (F.floor(column / 365) + 1970).cast("bigint")


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in children(spark, f"{path}/versions") if name.isdigit())


def entries(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The manifest of a version, the latest by default."""
    number = version if version is not None else max(versions(spark, path), default=0)
    if not number or not exists(spark, f"{path}/versions/{number:09d}"):
        raise FileNotFoundError(f"{path} has no version {version or ''}")
    name = spark.read.text(f"{path}/versions/{number:09d}").first()["value"]
    return spark.read.parquet(f"{path}/manifests/{name}")


@contextmanager
def _listing_in_bundles(spark: SparkSession):
    """While a frame over many paths is made: a few listing tasks per core, where Spark would start one for each path."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _claim(spark: SparkSession, path: str, number: int, manifest: DataFrame) -> int:
    """Write a manifest and make it version ``number``, unless that number is taken."""
    name = uuid.uuid4().hex
    manifest.select(*_ENTRIES).coalesce(1).write.parquet(f"{path}/manifests/{name}")
    system, target = _file_system(spark, f"{path}/versions/{number:09d}")
    try:
        stream = system.create(target, False)
    except Exception as error:
        raise Conflict(f"{path}: version {number} exists already") from error
    stream.write(bytearray(f"{name}\n".encode()))
    stream.close()
    return number


def _written(rows: DataFrame, path: str, tile_cells: int) -> DataFrame:
    """Write rows to files of their own and describe each file from what was written."""
    spark = rows.sparkSession
    folder = f"{path}/data/{uuid.uuid4().hex}"
    keyed = rows.withColumns({"year": year_of(), "tile": F.expr(f"cell div {tile_cells}")})
    # A file costs the same however few rows it has, so the number of tasks must not follow the bytes.
    place_by(keyed, *PARTITION).sortWithinPartitions(*PARTITION, "cell", "ord").write.partitionBy(*PARTITION).option("compression", "zstd").parquet(folder)
    if not children(spark, folder) or not [n for n in children(spark, folder) if n.startswith("year=")]:
        return spark.createDataFrame([], "file string, year bigint, tile bigint, first bigint, last bigint, rows bigint, digest string")
    with _listing_in_bundles(spark):
        stored = spark.read.parquet(folder)
    columns = [F.col(f"`{c}`") for c in sorted(stored.columns) if c not in PARTITION]
    described = stored.groupBy(F.input_file_name().alias("file"), *[F.col(c).cast("bigint").alias(c) for c in PARTITION]).agg(
        F.min("ord").alias("first"), F.max("ord").alias("last"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string").alias("digest"))
    return cut_lineage(described)


def create(df: DataFrame, path: str, tile_cells: int = TILE_CELLS) -> int:
    """The first version of a new store from rows (cell, ord, ...)."""
    if exists(df.sparkSession, f"{path}/versions"):
        raise FileExistsError(path)
    return _claim(df.sparkSession, path, 1, _written(df, path, tile_cells))


def _rows_of(spark: SparkSession, chosen: DataFrame, like: list[str] | None = None) -> DataFrame | None:
    """All rows of the chosen files; the list of files is what a scan plans with anyway."""
    files = [r["file"] for r in chosen.select("file").distinct().collect()]
    if not files:
        return None
    with _listing_in_bundles(spark):
        rows = spark.read.parquet(*files)
    return rows.select(*(like or [c for c in rows.columns if c not in PARTITION]))


def read(spark: SparkSession, path: str, version: int | None = None, days: tuple[int, int] | None = None,
         tiles: list[int] | None = None) -> DataFrame:
    """The rows of a version; ``days`` [first, end) and ``tiles`` limit the files that are opened."""
    found = entries(spark, path, version)
    wanted = found
    if days is not None:
        wanted = wanted.where((F.col("last") >= days[0]) & (F.col("first") < days[1]))
    if tiles is not None:
        wanted = wanted.where(F.col("tile").isin(tiles))
    rows = _rows_of(spark, wanted)
    if rows is None:
        rows = _rows_of(spark, found.limit(1))
        if rows is None:
            raise FileNotFoundError(f"{path} holds no rows")
        rows = rows.where("false")
    return rows if days is None else rows.where((F.col("ord") >= days[0]) & (F.col("ord") < days[1]))


def touched(spark: SparkSession, path: str, batch: DataFrame, version: int | None = None, tile_cells: int = TILE_CELLS) -> DataFrame:
    """The entries whose days and tile overlap those of a batch."""
    zones = batch.groupBy(year_of().alias("year"), F.expr(f"cell div {tile_cells}").alias("tile")).agg(F.min("ord").alias("low"), F.max("ord").alias("high"))
    return entries(spark, path, version).join(zones, PARTITION).where("first <= high AND last >= low").select(*_ENTRIES)


def append(batch: DataFrame, path: str, base: int | None = None, tile_cells: int = TILE_CELLS) -> int:
    """Add the rows of a batch whose (cell, ord) the store lacks; returns the version that holds them.

    Only files whose zone overlaps the batch are read.  A batch given twice adds
    nothing and makes no version.  ``base`` is the version the writer has seen; if
    the store has moved on since, the append fails with `Conflict`.
    """
    spark = batch.sparkSession
    base = base if base is not None else max(versions(spark, path))
    batch = cut_lineage(batch.dropDuplicates(["cell", "ord"]))
    held = _rows_of(spark, touched(spark, path, batch, base, tile_cells), ["cell", "ord"])
    fresh = batch if held is None else batch.join(held, ["cell", "ord"], "left_anti")
    added = _written(fresh, path, tile_cells)
    if added.isEmpty():
        return base
    return _claim(spark, path, base + 1, entries(spark, path, base).select(*_ENTRIES).unionByName(added))


def replace_region(df: DataFrame, path: str, base: int | None = None, tile_cells: int = TILE_CELLS) -> int:
    """Exchange the whole (year, tile) partitions that ``df`` has rows for; all others keep their files."""
    spark = df.sparkSession
    base = base if base is not None else max(versions(spark, path))
    added = _written(df, path, tile_cells)
    kept = entries(spark, path, base).join(added.select(*PARTITION).distinct(), PARTITION, "left_anti")
    return _claim(spark, path, base + 1, kept.select(*_ENTRIES).unionByName(added))


def clone(spark: SparkSession, path: str, target: str, version: int | None = None) -> int:
    """A new store that starts from a version of ``path`` by referring to its files."""
    if exists(spark, f"{target}/versions"):
        raise FileExistsError(target)
    return _claim(spark, target, 1, entries(spark, path, version))


def partition_digests(found: DataFrame) -> DataFrame:
    """(year, tile, rows, digest) of a manifest; digests of files add up to that of their partition."""
    return found.groupBy(*PARTITION).agg(F.sum("rows").alias("rows"), F.sum(F.col("digest").cast("decimal(38,0)")).alias("digest"))


def changed_partitions(left: DataFrame, right: DataFrame) -> DataFrame:
    """(year, tile, rows_before, rows_after) of partitions whose contents differ between two manifests; no data is read."""
    a, b = (partition_digests(x).select(*PARTITION, F.col("rows").alias(f"rows_{n}"), F.col("digest").alias(f"digest_{n}")) for x, n in ((left, "before"), (right, "after")))
    both = a.join(b, PARTITION, "full_outer").where("NOT (digest_before <=> digest_after) OR NOT (rows_before <=> rows_after)")
    return both.select(*PARTITION, *[F.coalesce(f"rows_{n}", F.lit(0)).alias(f"rows_{n}") for n in ("before", "after")])
