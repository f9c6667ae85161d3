"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


SHUFFLE_BYTES = 256 << 20
MOST_PARTITIONS = 50_000


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for an input: about 256 MB each, two per core at least, 50 000 at most.

    Adaptive execution joins small ones again, so too many costs little and too few would spill.
    """
    return max(2 * cores, min(MOST_PARTITIONS, -(-input_bytes // SHUFFLE_BYTES)))


SMALL_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """What Spark expects the rows to take; nothing runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dealt_out(df: DataFrame) -> DataFrame:
    """A small table over all cores, for work that costs much more per row than moving the row; a large one as it is.

    A small table may be one file with one row group, so one task would do all the work. A table that Spark estimates at more than
    256 MB has enough splits of its own, and is not moved.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if estimated_bytes(df) <= SMALL_BYTES else df


def build_session(app: str = "tablecare", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs rely on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster
    a machine-local folder would vanish with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    named = tempfile.mkdtemp(prefix="tablecare-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor cannot change it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
