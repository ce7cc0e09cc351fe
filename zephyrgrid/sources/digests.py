"""Digests of stored tables by content, kept per file, and checks of what a store was made with.

A file's digest is the sum of its rows' hashes, so neither order nor partitioning
matters, and the digest of a table is the sum over its files.  Digests are kept beside a
cache with size and time of each file; only files that are new or changed are read
again.  A fit whose key holds such a digest is trained anew when data is rewritten at
the same path, and not when the same rows merely lie in other files.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.presets import settings
from ..session import cut_lineage, scalar_row
from .stores import _file_system, children, exists

_FILES = "file string, size bigint, modified timestamp"


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, modified) of all data files below ``path``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def _digested(spark: SparkSession, files: list[str], root: str) -> DataFrame:
    rows = spark.read.option("basePath", root).parquet(*files)
    columns = [F.col(f"`{c}`") for c in sorted(rows.columns)]
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("digest"), F.count(F.lit(1)).alias("rows"))


def table_digest(spark: SparkSession, path: str, cache: str) -> tuple[str, int]:
    """(digest of the rows below ``path``, how many files had to be read for it)."""
    files = cut_lineage(_listed(spark, path))
    kept = [n for n in children(spark, cache) if n.startswith("digests-")]
    known = spark.read.parquet(f"{cache}/{max(kept)}") if kept else spark.createDataFrame([], f"{_FILES}, digest decimal(38,0), rows bigint")
    held = files.join(known, ["file", "size", "modified"])
    fresh = [r["file"] for r in files.join(held.select("file"), "file", "left_anti").collect()]
    # Files without rows have no digest, but they are known then.
    added = files.where(F.col("file").isin(fresh)).join(_digested(spark, fresh, path), "file", "left") if fresh else known.where("false")
    whole = cut_lineage(held.select(*known.columns).unionByName(added.select(
        "file", "size", "modified", F.coalesce("digest", F.lit(0)).cast("decimal(38,0)").alias("digest"), F.coalesce("rows", F.lit(0)).alias("rows"))))
    if fresh or whole.count() != known.count():
        # A later name is written whole before earlier ones go, so a crash costs at most a second reading.
        number = int(max(kept).split("-")[1]) + 1 if kept else 1
        whole.coalesce(1).write.parquet(f"{cache}/digests-{number:09d}-{uuid.uuid4().hex}")
        for name in kept:
            system, old = _file_system(spark, f"{cache}/{name}")
            system.delete(old, True)
    total = scalar_row(whole.agg(F.coalesce(F.sum("digest"), F.lit(0)).alias("digest"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))
    schema = sorted((f.name, f.dataType.simpleString()) for f in spark.read.parquet(path).schema.fields)
    text = json.dumps([str(total["digest"]), total["rows"], schema])
    return hashlib.sha256(text.encode()).hexdigest(), len(fresh)


def require_current(spark: SparkSession, path: str, variable: str) -> int:
    """The preset revision a store was made with; an older one than the variable's present revision is refused."""
    wanted = settings(variable).revision
    stored = 1
    if exists(spark, f"{path}/manifest"):
        stored = json.loads(spark.read.text(f"{path}/manifest").first()["value"])["manifest"].get("revision", 1)
    if stored != wanted:
        raise ValueError(f"stale {variable} adjustment in {path}: preset revision {stored}, expected {wanted}")
    return stored


def history_root(spark: SparkSession, projection: str) -> str | None:
    """The historical store beside a projection (model/scenario/projection), or None."""
    parts = projection.rstrip("/").split("/")
    if len(parts) < 3 or parts[-1] != "projection":
        return None
    candidate = "/".join([*parts[:-2], "historical", "hist"])
    return candidate if exists(spark, candidate) else None
