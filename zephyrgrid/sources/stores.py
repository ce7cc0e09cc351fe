"""Reading, writing and describing stores of cube data."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_chunks(text: str | None) -> dict[str, int]:
    """``"time=-1,lat=2"`` to a mapping; sizes are -1 or positive."""
    if not text:
        return {}
    chunks: dict[str, int] = {}
    for item in text.split(","):
        name, separator, size = item.partition("=")
        name = name.strip()
        if not separator or not name:
            raise ValueError(f"invalid chunk {item!r}; expected name=size")
        try:
            number = int(size)
        except ValueError:
            raise ValueError(f"chunk size of {name!r} is not a whole number: {size!r}") from None
        if number == 0 or number < -1:
            raise ValueError(f"chunk size of {name!r} must be -1 or positive")
        chunks[name] = number
    return chunks


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def open_cube(spark: SparkSession, path: str, variable: str | None = None) -> DataFrame:
    """Open Parquet or a chunked array store (Zarr format 2, one variable of it); NaN becomes NULL."""
    if path.endswith((".nc", ".nc4")):
        raise ValueError("NetCDF files are not read; convert them to Zarr format 2 or Parquet")
    if path.endswith(".zarr"):
        from .arrays import open_array

        if variable is None:
            raise ValueError("a variable name is needed to open an array store")
        return open_array(spark, path, variable)
    stored = spark.read.parquet(path)
    reals = [name for name, kind in stored.dtypes if kind in ("float", "double")]
    return stored.withColumns({name: F.when(~F.isnan(F.col(f"`{name}`")), F.col(f"`{name}`")) for name in reals})


def write_store(df: DataFrame, path: str, overwrite: bool = False, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, overwrite: bool = False) -> None:
    """Write beside the target and rename once complete, so readers never see half a store."""
    spark = df.sparkSession
    if exists(spark, path) and not overwrite:
        raise FileExistsError(path)
    staging = f"{path}.partial-{uuid.uuid4().hex}"
    write_store(df, staging, partition_by=partition_by)
    system, target = _file_system(spark, path)
    _, source = _file_system(spark, staging)
    _, aside = _file_system(spark, f"{path}.replaced")
    if system.exists(target):
        # The old store steps aside first: at every moment one whole store exists.
        if system.exists(aside):
            system.delete(aside, True)
        if not system.rename(target, aside):
            raise OSError(f"could not set {path} aside")
    if not system.rename(source, target):
        if system.exists(aside):
            system.rename(aside, target)
        raise OSError(f"could not publish {staging} as {path}")
    if system.exists(aside):
        system.delete(aside, True)


def recover(spark: SparkSession, path: str) -> bool:
    """Put back a store that an interrupted ``publish`` had set aside; True if that was needed."""
    system, target = _file_system(spark, path)
    _, aside = _file_system(spark, f"{path}.replaced")
    if system.exists(target) or not system.exists(aside):
        return False
    return bool(system.rename(aside, target))


def write_region(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions (tiles) present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").partitionBy(*partition_by).parquet(path)


def append_segment(df: DataFrame, path: str, keys: list[str]) -> int:
    """Append only rows the store lacks; returns how many, 0 on a repeated run."""
    spark = df.sparkSession
    fresh = df
    if exists(spark, path):
        fresh = df.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    fresh = fresh.persist()
    try:
        count = fresh.count()
        if count:
            fresh.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        fresh.unpersist()
    return count


def prepare_store(spark: SparkSession, path: str, manifest: dict, schema: str) -> bool:
    """Check or create a store's manifest; True when stale contents had to go.

    Another schema or grid is refused.  Another algorithm or revision is stale:
    the data goes first, then the manifest is replaced, so a crash in between
    leaves an empty store and never old data under a new stamp.
    """
    record = f"{path}/manifest"
    stale = False
    if exists(spark, record):
        stored = json.loads(spark.read.text(record).first()["value"])
        if stored["schema"] != schema or stored["manifest"].get("grid") != manifest.get("grid"):
            raise ValueError(f"{path} holds another schema or grid")
        if stored["manifest"] == manifest:
            return False
        stale = True
        system, data = _file_system(spark, f"{path}/data")
        if system.exists(data):
            system.delete(data, True)
    text = json.dumps({"schema": schema, "manifest": manifest}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(record)
    return stale


def tiles(cells: DataFrame, rows: int, columns: int) -> DataFrame:
    """Tiles with an active cell, cropped to their active rows and columns."""
    return cells.groupBy(F.expr(f"fi div {rows}").alias("tile_row"), F.expr(f"fj div {columns}").alias("tile_column")).agg(
        F.min("fi").alias("first_row"), (F.max("fi") + 1).alias("end_row"),
        F.min("fj").alias("first_column"), (F.max("fj") + 1).alias("end_column"), F.count(F.lit(1)).alias("active_cells"))


def json_report(*columns: str) -> Column:
    """A JSON object with sorted keys."""
    return F.to_json(F.struct(*sorted(columns)))


def write_json(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.select(json_report(*df.columns).alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def discover(spark: SparkSession, root: str, variables: list[str], periods: dict[str, str]) -> list[dict]:
    """Model and scenario stores below ``root/model/scenario/period/variable``; layouts must be complete.

    ``periods`` maps a scenario to its period folder, for example historical to hist.
    """
    found = []
    for model in children(spark, root):
        for scenario in children(spark, f"{root}/{model}"):
            period = periods.get(scenario, "projection")
            stages = children(spark, f"{root}/{model}/{scenario}")
            if stages and period not in stages:
                raise ValueError(f"{model}/{scenario} has {stages}, expected {period}")
            stores = children(spark, f"{root}/{model}/{scenario}/{period}")
            missing = [v for v in variables if v not in stores]
            if missing:
                raise ValueError(f"{model}/{scenario} lacks {missing}")
            found.append({"model": model, "scenario": scenario, "path": f"{root}/{model}/{scenario}/{period}"})
    return found
