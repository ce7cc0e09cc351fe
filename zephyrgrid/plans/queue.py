"""What to run next: join the inventory of inputs with what is already published."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def plan_queue(inventory: DataFrame, published: DataFrame, history: DataFrame) -> DataFrame:
    """Status and order of every (model, scenario).

    ``inventory`` has one row per input store with ``ready``; ``published`` says
    which products are complete; ``history`` says whose historical product can
    be reused.  The result has one row per pathway, a few hundred at most.
    """
    state = inventory.groupBy("model", "scenario").agg(
        F.count_if(~F.coalesce("ready", F.lit(False))).alias("errors"))
    joined = state.join(published, ["model", "scenario"], "left").join(history, "model", "left")
    status = (
        F.when(F.coalesce("complete", F.lit(False)), "complete")
        .when(F.col("errors") == 0, "ready").otherwise("blocked"))
    planned = joined.select("model", "scenario", status.alias("status"),
                            F.coalesce("reusable", F.lit(False)).alias("history_reusable"), "errors")
    rank = F.when(F.col("status") == "ready", 0).when(F.col("status") == "complete", 1).otherwise(2)
    order = Window.orderBy(rank, ~F.col("history_reusable"), "model", "scenario")
    return planned.withColumn("position", F.row_number().over(order))
