"""Consistent hashing with virtual nodes and bounded loads, in DataFrame operations only.

Each shard owns many points on a ring of 65,536 ticks.  A row's key hashes to a
tick and first belongs to the owner of the next point clockwise.  A shard takes
rows up to its bound; what it can't take walks on clockwise to the next shard
that has room.  With ``slack`` 0 the bounds are the exact equal split, so row
counts differ by one at most; with more slack fewer rows move when shards are added.

Rows travel only as counts until their shard is known: rows per arc (at most
``shards * nodes`` of them) are folded once around the ring in a single row of
arrays, and what comes out is a small table of rank intervals per arc.  Its size
depends on the ring, never on the data, which is why it is broadcast.

Defined cases: a null key is a key like any other; a null text has no bytes and
the checksum of an empty text; equal keys start at the same point and overflow
like other rows; repeated rows each get a slot of their own.  An empty table
gives an empty result.  More shards than rows leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import ranked

TICK_BITS = 16
NODES = 128
OVERHEAD_BYTES = 16


def _tick(column: Column) -> Column:
    return F.shiftrightunsigned(column, 64 - TICK_BITS).cast("int")


def ring(spark: SparkSession, shards: int, nodes: int = NODES) -> DataFrame:
    """(arc, tick, shard) of the virtual nodes in clockwise order; of two on one tick the lower shard has it."""
    points = spark.range(0, shards * nodes, 1, 1).select(
        F.expr(f"cast(id div {nodes} as int)").alias("shard"), F.expr(f"id % {nodes}").alias("node"))
    owned = points.groupBy(_tick(F.xxhash64(F.lit("ring"), "shard", "node")).alias("tick")).agg(F.min("shard").alias("shard"))
    return owned.select((F.row_number().over(Window.orderBy("tick")) - 1).alias("arc"), "tick", "shard")


def _arc_of_tick(spark: SparkSession, arcs: DataFrame) -> DataFrame:
    ticks = spark.range(0, 1 << TICK_BITS, 1, 1).select(F.col("id").cast("int").alias("tick"))
    onward = Window.orderBy(F.desc("tick")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ticks.join(F.broadcast(arcs.select("tick", "arc")), "tick", "left").select(
        "tick", F.coalesce(F.last("arc", ignorenulls=True).over(onward), F.lit(0)).alias("arc"))


def _walk(steps: Column, room: Column) -> Column:
    """Carry overflow along ``steps`` (arc, shard, overflow); the rows taken at each step that takes any."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), room.alias("room"), F.lit(0).alias("step"),
                     F.array().cast("array<struct<step:int,shard:int,taken:bigint>>").alias("taken"))

    def step(state: Column, arc: Column) -> Column:
        carried = state["carry"] + arc["overflow"]
        taken = F.least(carried, F.get(state["room"], arc["shard"]))
        left = F.when(taken > 0, F.transform(
            state["room"], lambda r, i: F.when(i == arc["shard"], r - taken).otherwise(r))).otherwise(state["room"])
        more = F.when(taken > 0, F.concat(state["taken"], F.array(F.struct(
            state["step"].alias("step"), arc["shard"].alias("shard"), taken.alias("taken"))))).otherwise(state["taken"])
        return F.struct((carried - taken).alias("carry"), left.alias("room"), (state["step"] + 1).alias("step"), more.alias("taken"))

    return F.aggregate(steps, start, step, lambda state: state["taken"])


def intervals(arcs: DataFrame, demand: DataFrame, total: int, shards: int, slack: float) -> DataFrame:
    """(arc, low, high, shard, base): rows of ``arc`` with rank in [low, high) take slots of ``shard`` from ``base`` on."""
    if slack:
        bound = F.lit(int(-(-total * (1 + slack) // shards))).cast("bigint")
    else:
        bound = (F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)).cast("bigint")
    earlier = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    held = arcs.join(demand, "arc", "left").select(
        "arc", "shard", F.coalesce("rows", F.lit(0)).alias("rows"), bound.alias("bound")).withColumn(
        "before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).withColumn(
        "own", F.greatest(F.lit(0), F.least("rows", F.col("bound") - F.col("before")))).withColumn(
        "overflow", F.col("rows") - F.col("own"))
    held = cut_lineage(held)
    room = F.col("bound") - F.sum("own").over(Window.partitionBy("shard"))
    around = held.withColumn("room", room).agg(
        F.array_sort(F.collect_list(F.struct("arc", "shard", "overflow"))).alias("around"),
        F.array_sort(F.collect_set(F.struct("shard", "room"))).alias("free"))
    again = F.transform("around", lambda x: F.struct(
        x["arc"].alias("arc"), x["shard"].alias("shard"), F.lit(0).cast("bigint").alias("overflow")))
    taken = around.select(F.explode(_walk(
        F.concat("around", again), F.transform("free", lambda x: x["room"]))).alias("t")).select("t.*")
    # The overflow queue is first in, first out: cut it where an arc's rows or a shard's intake begins.
    order = Window.orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    entered = held.where("overflow > 0").select(
        F.coalesce(F.sum("overflow").over(order), F.lit(0)).alias("at"), "arc", "own", "overflow")
    served = taken.select(F.coalesce(F.sum("taken").over(
        Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("at"), "step", "shard", "taken")
    marks = entered.select("at", F.struct("arc", "own", "at", "overflow").alias("source"), F.lit(None).cast("struct<step:int,shard:int,at:bigint,taken:bigint>").alias("target")).unionByName(
        served.select("at", F.lit(None).cast("struct<arc:int,own:bigint,at:bigint,overflow:bigint>").alias("source"), F.struct("step", "shard", "at", "taken").alias("target")))
    so_far = Window.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = marks.select("at", F.last("source", True).over(so_far).alias("source"), F.last("target", True).over(so_far).alias("target")).dropDuplicates(["at"])
    cut = cut.withColumn("until", F.coalesce(F.lead("at").over(Window.orderBy("at")), F.col("source.at") + F.col("source.overflow")))
    walked = cut.select(
        "source.arc", (F.col("source.own") + F.col("at") - F.col("source.at")).alias("low"),
        (F.col("source.own") + F.col("until") - F.col("source.at")).alias("high"), "target.shard", (F.col("target.step") + 1).alias("turn"))
    stayed = held.where("own > 0").select("arc", F.lit(0).cast("bigint").alias("low"), F.col("own").alias("high"), "shard", F.lit(0).alias("turn"))
    slots = Window.partitionBy("shard").orderBy("turn", "arc", "low").rowsBetween(Window.unboundedPreceding, -1)
    return stayed.unionByName(walked).withColumn("base", F.coalesce(F.sum(F.col("high") - F.col("low")).over(slots), F.lit(0))).drop("turn")


def assign(rows: DataFrame, key: str, shards: int, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    spark = rows.sparkSession
    rows = cut_lineage(rows.withColumn("_tick", _tick(F.xxhash64(key))))
    total = rows.count()
    arcs = cut_lineage(ring(spark, shards, nodes))
    if arcs.select("shard").distinct().count() < shards:
        raise ValueError(f"{shards} shards don't all find a place on a ring of {1 << TICK_BITS} ticks")
    placed = rows.join(F.broadcast(_arc_of_tick(spark, arcs).withColumnsRenamed({"tick": "_tick", "arc": "_arc"})), "_tick").drop("_tick")
    demand = placed.groupBy(F.col("_arc").alias("arc")).agg(F.count(F.lit(1)).alias("rows"))
    pieces = intervals(arcs, demand, total, shards, slack).withColumnsRenamed({"arc": "_arc", "shard": "_shard"})
    numbered = ranked(placed, "_arc", total)
    fits = (numbered["_arc"] == pieces["_arc"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    return numbered.join(F.broadcast(pieces), fits).select(
        *[c for c in rows.columns if c != "_tick"], F.col("_shard").alias("shard"),
        (F.col("base") + F.col("rank") - F.col("low")).alias("slot"))


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32): what a document weighs and the checksum of its text."""
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return documents.select("doc_id", (F.octet_length(text) + OVERHEAD_BYTES).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
