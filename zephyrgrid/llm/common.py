"""Small helpers the text operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

SALTS = 16
CELL_ROWS = 50_000


def read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else; null stays null.

    ``lower`` is much faster than ``translate`` and equal to it on pure ASCII,
    which shows in the byte length.
    """
    plain = F.octet_length(column) == F.length(column)
    return F.when(plain, F.lower(column)).otherwise(
        F.translate(column, string.ascii_uppercase, string.ascii_lowercase))


def scattered(*columns: str | Column, parts: int) -> Column:
    """A stable number in [0, parts) from the values of ``columns``."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


def stretches(texts: list[str], characters: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Cut a list into runs [a, b) of about so many characters."""
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= characters:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join where one key may own a third of ``left`` and is unique, or nearly so, in ``right``.

    Rows of ``left`` are spread over ``salts`` parts by all their values and
    ``right`` is repeated once per part.  ``how``: inner, left, left_semi.
    """
    spread = left.withColumn("_salt", scattered(*[F.col(f"`{c}`") for c in left.columns], parts=salts))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def ranked(df: DataFrame, group: str, total: int) -> DataFrame:
    """Add ``rank``, gapless from 0 within ``group``, over all rows, repeated ones included.

    Equal rows collapse to a count first and the rest of a group is cut into
    cells by hash, so that neither a hot group nor a hot row lands in one task:
    rank = rows in earlier cells + rows before this one in its cell.  The order
    is by cell, then by the columns of ``df``; it depends on the data alone.
    """
    columns = df.columns
    cells = max(1, -(-total // CELL_ROWS))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn(
        "_cell", scattered(*columns, parts=cells))
    before = Window.partitionBy(group, "_cell").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    inner = counted.withColumn("_inner", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    earlier = Window.partitionBy("_group").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.groupBy(F.col(group).alias("_group"), "_cell").agg(F.sum("_copies").alias("_held")).select(
        "_group", "_cell", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_start"))
    placed = inner.join(starts, inner[group].eqNullSafe(starts["_group"]) & (inner["_cell"] == starts["_cell"]))
    return placed.select(*columns, F.explode(F.sequence(
        F.col("_start") + F.col("_inner"), F.col("_start") + F.col("_inner") + F.col("_copies") - 1)).alias("rank"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node of its component.

    Alternates the two star contractions: hang larger neighbours, then smaller
    ones, below the smallest node seen.  Both halves take a minimum (combined
    before the shuffle) and a salted join back, so a hub of any degree is split.
    Nodes must not be null.  Empty edges give no rows.
    """

    def pointed(pairs: DataFrame, lowest: DataFrame) -> DataFrame:
        joined = salted_join(pairs, lowest, ["u"])
        return joined

    edges = cut_lineage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = pointed(both.where("v > u"), lowest).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A node's own link to its smallest neighbour keeps the two connected.
        large = large.unionByName(lowest.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        large = cut_lineage(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = pointed(large, low).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == state:
            break
        state = seen
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
