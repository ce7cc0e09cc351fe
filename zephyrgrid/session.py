"""Session settings and the two safety helpers every operator shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a join on (cell, doy) reuse an existing hash partitioning on cell alone:
    # a cell's rows are bounded by the length of the calendar, so cells do not skew.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "65536",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # One native thread per task: Spark, not BLAS, owns the cores.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
}


def build_session(
    app_name: str = "zephyrgrid",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; on a cluster leave ``master`` unset and let spark-submit name it."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_directory(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="zephyrgrid-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_directory(spark))
    return df.checkpoint(eager=True)


def scalar_row(df: DataFrame):
    """Bring one aggregate row to the driver; refuses anything that is not one row."""
    rows = df.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected exactly one row, got {len(rows)} or more")
    return rows[0]


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row summary to every row of ``df`` as literals."""
    row = scalar_row(one_row)
    return df.withColumns(
        {f.name: F.lit(row[f.name]).cast(f.dataType) for f in one_row.schema.fields}
    )


def place_by(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows by ``keys`` into the session's number of shuffle partitions.

    A grouped Python call on the same keys reuses this placement.  Naming the
    number keeps adaptive execution from merging partitions whose few bytes
    stand for much computation.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *keys)
