"""Exact quantiles at positions (n-1)*p, for small groups and for whole tables.

Groups whose size the calendar bounds use Spark's ``percentile`` or sorted
arrays.  Whole-table quantiles never gather the values in one task: sketches
bracket each wanted rank, and one more scan counts what is inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BINS = 1024
SKETCH, MARGIN = 2048, 0.004  # size of a sketch, and the share of rows by which its ranks may be off
SMALL = 10_000  # groups of so few rows are counted in full
BROADCAST_BRACKETS = 50_000


def sorted_array_quantile(values: Column, p: Column) -> Column:
    """Linear quantile of a sorted array without nulls; NULL when it is empty."""
    position = (F.size(values) - 1) * p
    low = F.floor(position)
    below = F.element_at(values, (low + 1).cast("int"))
    above = F.element_at(values, (F.ceil(position) + 1).cast("int"))
    return F.when(F.size(values) > 0, below + (position - low) * (above - below))


def sorted_array_quantiles(values: Column, probabilities: list[float]) -> Column:
    """One array with a quantile per probability.

    Written out per probability rather than as a lambda, so it compiles with
    its stage; ``values`` should be a plain column.
    """
    entries = F.array(*[sorted_array_quantile(values, F.lit(float(p))) for p in probabilities])
    return F.when(F.size(values) > 0, entries)


def group_percentiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Quantile vector per group; for groups bounded by the calendar (cells, cell-months)."""
    return df.groupBy(*keys).agg(
        F.percentile(F.col(value), [float(p) for p in probabilities]).alias("quantiles"),
        F.count(value).alias("n"),
    )


def counted_quantiles(df: DataFrame, value: str, n: str, probabilities: list[float], by: str) -> DataFrame:
    """`exact_quantiles` of a table of counts: column ``n`` says how many rows have a value.

    Meant for few distinct values of many rows; nothing needs a sketch, as every
    value of a group lies in its bracket.
    """
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(v) & F.col(by).isNotNull()).select(
        F.col(by).cast("string").alias("g"), v.alias("v"), F.col(n).alias("n"))
    held = cut_lineage(rows.groupBy("g", "v").agg(F.sum("n").alias("n")))
    position = (F.col("n") - 1) * F.col("p")
    brackets = cut_lineage(held.groupBy("g").agg(F.sum("n").alias("n")).select(
        "g", "n", F.explode(F.array(*[F.lit(float(p)) for p in dict.fromkeys(probabilities)])).alias("p")).withColumns(
        {"low_rank": F.floor(position).cast("bigint"), "high_rank": F.ceil(position).cast("bigint")}))
    few = brackets.select("g", "p")
    if few.count() <= BROADCAST_BRACKETS:
        few = F.broadcast(few)
    return _interpolated(brackets, held.join(few, "g").select("g", "p", "v", "n"), by)


def exact_quantiles(
    df: DataFrame, value: str, probabilities: list[float], by: str | None = None
) -> DataFrame:
    """Exact quantiles of a whole column, optionally for each value of ``by``.

    Returns ``(by, p, n, quantile)``.  The data is scanned twice.  The first scan builds
    a mergeable KLL sketch per group, which brackets every wanted rank between two
    values less than a hundredth of the rows apart.  The second counts what lies below
    each bracket and, value by value, what lies inside; equal values are one row, so a
    value that holds a third of all rows is no burden.  Ranks are then settled among the
    rows inside, by histograms while a bracket has more than ``BINS`` values.
    A sketch that was wrong shows in the counts; its groups are counted again in full.
    Nothing but the number of brackets reaches the driver.

    NaN is a missing value.  Infinities keep their rank; between an infinity and
    a finite value the quantile is NaN.
    """
    label = F.lit("all") if by is None else F.col(by).cast("string")
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(v) & label.isNotNull()).select(label.alias("g"), v.alias("v"))
    brackets = cut_lineage(_brackets(rows, probabilities))
    held = cut_lineage(_counted(rows, brackets))
    missed = _missed(brackets, held)
    if not missed.isEmpty():
        missed = cut_lineage(missed)
        wide = brackets.join(missed, ["g", "p"]).withColumns({"a": F.col("lo"), "b": F.col("hi")})
        again = _counted(rows, wide)
        held = cut_lineage(held.join(missed, ["g", "p"], "left_anti").unionByName(again))
    return _interpolated(brackets, held, by or "g")


def _interpolated(brackets: DataFrame, held: DataFrame, by: str) -> DataFrame:
    """(by, p, n, quantile) between the values at both ranks of each bracket."""
    settled = _settled(brackets, held)
    low, high = (settled.select("g", "p", F.col("rank").alias(f"{side}_rank"), F.col("v").alias(side)) for side in ("low", "high"))
    found = brackets.join(low, ["g", "p", "low_rank"]).join(high, ["g", "p", "high_rank"])
    between = F.col("low") + ((F.col("n") - 1) * F.col("p") - F.col("low_rank")) * (F.col("high") - F.col("low"))
    return found.select(F.col("g").alias(by), "p", "n", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias("quantile"))


def _brackets(rows: DataFrame, probabilities: list[float]) -> DataFrame:
    """(g, p, n, lo, hi, a, b, low_rank, high_rank): from one scan, where each wanted rank should lie."""
    summary = rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.kll_sketch_agg_double("v", F.lit(SKETCH)).alias("sketch"))

    def end(share: float, extreme: str) -> Column:
        if not 0 < share < 1:
            return F.col(extreme)
        return F.when(F.col("n") <= SMALL, F.col(extreme)).otherwise(F.kll_sketch_get_quantile_double("sketch", F.lit(share)))

    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), end(p - MARGIN, "lo").alias("a"), end(p + MARGIN, "hi").alias("b")) for p in dict.fromkeys(probabilities)])
    position = (F.col("n") - 1) * F.col("p")
    return summary.select("g", "n", "lo", "hi", F.explode(wanted).alias("w")).select("g", "n", "lo", "hi", "w.*").withColumns(
        {"low_rank": F.floor(position).cast("bigint"), "high_rank": F.ceil(position).cast("bigint")})


def _counted(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """(g, p, v, n): rows per value inside each bracket; v is NULL for all rows below it."""
    few = brackets.select("g", "p", "a", "b")
    if few.count() <= BROADCAST_BRACKETS:
        few = F.broadcast(few)
    inside = rows.join(few, "g").where(F.col("v") <= F.col("b"))
    return inside.groupBy("g", "p", F.when(F.col("v") >= F.col("a"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))


def _missed(brackets: DataFrame, held: DataFrame) -> DataFrame:
    """(g, p) of brackets that do not hold their ranks."""
    sums = held.groupBy("g", "p").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("below"), F.sum("n").alias("reached"))
    outside = F.col("reached").isNull() | (F.col("low_rank") < F.col("below")) | (F.col("high_rank") >= F.col("reached"))
    return brackets.join(sums, ["g", "p"], "left").where(outside).select("g", "p")


def _settled(brackets: DataFrame, held: DataFrame) -> DataFrame:
    """(g, p, rank, v): the value at each wanted rank.

    The smallest and the largest value of a bracket always fall into different bins,
    infinities into bins of their own, so every round leaves fewer values.
    """
    keys = ["g", "p", "rank"]
    below = held.where("v IS NULL").select("g", "p", F.col("n").alias("below"))
    wanted = brackets.join(below, ["g", "p"], "left").select(
        "g", "p", F.explode(F.array_distinct(F.array("low_rank", "high_rank"))).alias("rank"), F.coalesce("below", F.lit(0)).alias("below"))
    left = held.where("v IS NOT NULL").join(wanted, ["g", "p"]).select(*keys, (F.col("rank") - F.col("below")).alias("want"), "v", "n")
    before = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    last = None
    while True:
        spans = left.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("k"))
        most = spans.agg(F.max("k").alias("k"), F.sum("k").alias("total")).first()
        # Values next to each other at the end of the number range may share a bin; by then there are only a few.
        if (most["k"] or 0) <= BINS or most["total"] == last:
            break
        last = most["total"]
        v, lo, hi, infinite = F.col("v"), F.col("lo"), F.col("hi"), F.lit(float("inf"))
        # Halves keep the span of any two finite values finite.
        share = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)
        open_ended = (lo == -infinite) | (hi == infinite)
        bin_of = (F.when(v == -infinite, -1.0).when(v == infinite, float(BINS)).when(open_ended, 0.0)
                  .otherwise(F.coalesce(F.floor(share * F.lit(BINS - 1)).cast("double"), F.lit(0.0))))
        bins = left.join(spans, keys).groupBy(*keys, "want", bin_of.alias("at")).agg(F.sum("n").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
        placed = bins.withColumn("passed", F.coalesce(F.sum("n").over(before), F.lit(0)))
        chosen = placed.where("passed <= want AND want < passed + n").select(*keys, (F.col("want") - F.col("passed")).alias("rest"), "first", "last")
        left = cut_lineage(left.join(chosen, keys).where("v BETWEEN first AND last").select(*keys, F.col("rest").alias("want"), "v", "n"))
    placed = left.withColumn("at", F.col("v")).withColumn("passed", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return placed.where("passed <= want AND want < passed + n").select(*keys, "v")


def circular_day_windows(
    df: DataFrame, keys: list[str], value: str, half_width: int, period: int = 365
) -> DataFrame:
    """For every (keys, doy) of the series: the sorted values of all days within ``half_width`` days.

    A day counts for a centre when the centre itself, ``half_width`` days or
    less away, lies inside the series, as a centred rolling window would have it.
    Days away from both ends of the series count for every centre in reach:
    they are gathered once per day of year and the windows slide over those
    arrays.  The few days near the ends are sent to their centres one by one.
    Rows are shuffled once, on ``keys``.
    """
    series = Window.partitionBy(*keys)
    rows = df.select(*keys, "doy", "ord", F.col(value).cast("double").alias("v")).withColumns(
        {"first": F.min("ord").over(series), "last": F.max("ord").over(series)})
    near_end = (F.col("ord") < F.col("first") + half_width) | (F.col("ord") > F.col("last") - half_width)
    centres = F.transform(
        F.sequence(F.greatest(F.col("ord") - half_width, F.col("first")), F.least(F.col("ord") + half_width, F.col("last"))),
        lambda c: F.struct((F.pmod(c, F.lit(period)) + 1).alias("at"), F.lit(True).alias("single"), (c == F.col("ord")).alias("own")))
    alone = F.array(F.struct(F.col("doy").alias("at"), F.lit(False).alias("single"), F.lit(True).alias("own")))
    sent = rows.select(*keys, "v", F.explode(F.when(near_end, centres).otherwise(alone)).alias("c"))
    # collect_list drops missing values itself: a filter on them would be pushed
    # below the projection and repeat the whole formula of the value.
    daily = sent.groupBy(*keys, F.col("c.at").alias("at")).agg(
        F.collect_list(F.when(~F.col("c.single"), F.col("v"))).alias("shared"),
        F.collect_list(F.when(F.col("c.single"), F.col("v"))).alias("singles"),
        F.max("c.own").alias("own"))
    # Repeat only the edges of the year, so the frame needs no wrap-around.
    copies = (
        F.when(F.col("at") <= half_width, F.array(F.lit(0), F.lit(period)))
        .when(F.col("at") > period - half_width, F.array(F.lit(0), F.lit(-period)))
        .otherwise(F.array(F.lit(0)))
    )
    unrolled = daily.withColumn("move", F.explode(copies)).withColumn("at", F.col("at") + F.col("move"))
    frame = Window.partitionBy(*keys).orderBy("at").rangeBetween(-half_width, half_width)
    gathered = unrolled.withColumn("near", F.collect_list("shared").over(frame)).where("move = 0 AND own")
    return gathered.select(
        *keys, F.col("at").alias("doy"), F.sort_array(F.concat(F.flatten("near"), F.col("singles"))).alias("values"))
