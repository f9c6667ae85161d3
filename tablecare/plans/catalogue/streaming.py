"""Streams over the event table; each runs to the end of its input and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.plans.catalogue.registry import query, run_folder
from tablecare.sources.tables import read_table
from tablecare.streaming import jobs


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a file stream, with instants as event time."""
    schema = read_table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    """
    SELECT date_trunc('hour', ts) + to_minutes(CAST(10 * (extract('minute' FROM ts) // 10) AS bigint)) AS window_start,
           event_type, count(*) AS n_slow, max(value) AS worst
    FROM events WHERE value >= 200 GROUP BY ALL
    """
)
def slow_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Slow events per 10 minutes and kind."""
    return jobs.slow_windows(read_table(spark, sf, "events"), "ts", "event_type", "value", at_least=200)


@query(
    """
    WITH w AS (
        SELECT date_trunc('hour', ts) + to_minutes(CAST(10 * (extract('minute' FROM ts) // 10) AS bigint)) AS s, event_type, value
        FROM events WHERE value >= 200)
    SELECT epoch_us(s) AS window_start, event_type, count(*) AS n_slow, max(value) AS worst FROM w
    WHERE s + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) GROUP BY ALL
    """
)
def stream_slow_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a stream: a window is written once the watermark has passed it."""
    folder = run_folder(spark)
    source = _stream(spark, sf)
    jobs.start_slow_monitor(
        source, f"{folder}/out", f"{folder}/state", "ts", "event_type", "value", "0 seconds", at_least=200
    ).awaitTermination()
    written = spark.read.parquet(f"{folder}/out")
    return written.withColumn("window_start", F.unix_micros("window_start"))


@query(
    """
    SELECT event_id, epoch_us(ts) AS micros, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """
)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The state an upsert stream reaches."""
    folder, keys = run_folder(spark), ["user_id", "event_type"]
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    jobs.start_upsert(_stream(spark, sf), folder, f"{folder}/state", keys, order).awaitTermination()
    state = jobs.current(spark, folder, keys, order)
    return state.select("event_id", F.unix_micros("ts").alias("micros"), "user_id", "event_type", "value")


@query(
    """
    SELECT event_id, epoch_us(ts) AS micros, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
    """
)
def stream_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """The first row of each key that a keep-first stream has let through."""
    folder, keys = run_folder(spark), ["user_id", "event_type"]
    order = ["ts", "event_id"]
    jobs.start_firsts(_stream(spark, sf), folder, f"{folder}/state", keys, "ts", order=order).awaitTermination()
    return jobs.firsts(spark, folder).select("event_id", F.unix_micros("ts").alias("micros"), *keys, "value", "props")


@query(
    """
    SELECT user_id, epoch_us(ts) AS micros, event_id, value FROM events WHERE event_type = 'error'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
    """
)
def stream_first_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    """Users with their first error, as a stream with a memory of 400 days has reported it."""
    folder = run_folder(spark)
    errors = _stream(spark, sf).where("event_type = 'error'")
    order = ["ts", "event_id"]
    jobs.start_firsts(errors, folder, f"{folder}/state", ["user_id"], "ts", "400 days", order).awaitTermination()
    return jobs.firsts(spark, folder).select("user_id", F.unix_micros("ts").alias("micros"), "event_id", "value")


@query(
    """
    SELECT event_id, epoch_us(ts) AS micros, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """
)
def stream_upsert_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert in six batches, folded after every second one."""
    folder, keys = run_folder(spark), ["user_id", "event_type"]
    arriving = read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    arriving.repartition(6, "event_id").write.parquet(f"{folder}/arriving")
    source = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/arriving")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    jobs.start_upsert(source, folder, f"{folder}/state", keys, order, fold_every=2).awaitTermination()
    state = jobs.current(spark, folder, keys, order)
    return state.select("event_id", F.unix_micros("ts").alias("micros"), "user_id", "event_type", "value")
