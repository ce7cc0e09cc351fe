"""Append daily increments to a store as they arrive.

A micro-batch is written like any other segment: rows the store already holds
are left out, so a batch that is replayed after a failure adds nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import stores


def append_increments(
    spark: SparkSession, incoming: str, schema: str, store: str, checkpoint: str,
    keys: tuple[str, ...] = ("cell", "ord"), files_per_batch: int = 64,
) -> StreamingQuery:
    """Start appending Parquet files from ``incoming``; stops when all present files are in."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(incoming)

    def write(batch: DataFrame, _: int) -> None:
        stores.append_segment(batch.dropDuplicates(list(keys)), store, list(keys))

    return (source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
