"""Streams of row changes: upsert, keep-first insert, slow-event monitor, first occurrences.

Every job takes its source as a DataFrame and its trigger as an argument (``{"availableNow": True}`` by default,
``{"processingTime": "1 minute"}`` for an endless stream), so a test can feed a folder and production a log. What must be known of earlier
batches lies in a :class:`~tablecare.streaming.log.BatchLog`.
"""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tablecare.operators.keys import any_null
from tablecare.operators.merging import one_per_key
from tablecare.streaming.log import BATCH, BatchLog

SLOW_AT = 500.0
ONCE: Mapping[str, Any] = {"availableNow": True}
FOLD_EVERY = 50
"""Batches after which a log is folded."""


def _started(writer: DataStreamWriter, checkpoint: str, trigger: Mapping[str, Any]) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _refuse(batch: DataFrame, folder: str, keys: list[str], number: int) -> DataFrame:
    """The rows with a full key; the others are written to ``folder/refused``, one folder per batch."""
    batch.where(any_null(keys)).write.mode("overwrite").parquet(f"{folder}/refused/{BATCH}={number}")
    return batch.where(~any_null(keys))


def refused(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that a stream has refused for want of a full key, with their batch."""
    return spark.read.parquet(f"{folder}/refused").withColumnRenamed(BATCH, "batch")


def start_upsert(
    source: DataFrame,
    folder: str,
    checkpoint: str,
    keys: list[str],
    order: list[Column | str],
    trigger: Mapping[str, Any] = ONCE,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Last-write-wins upsert of arriving rows.

    Each micro-batch is cut to one row per key and stored as a batch of the log, so the cost of a batch follows the batch and not
    the state; every ``fold_every`` batches the log is folded. Rows without a full key are kept apart (:func:`refused`).
    ``current`` reads the state.
    """

    def write(batch: DataFrame, number: int) -> None:
        log = BatchLog(batch.sparkSession, f"{folder}/log")
        log.write(one_per_key(_refuse(batch, folder, keys, number), keys, order), number)
        log.fold(lambda rows: _newest(rows, keys, order), fold_every)

    return _started(source.writeStream.foreachBatch(write), checkpoint, trigger)


def _newest(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key; of equal ones under ``order`` and all columns, that of the earliest batch."""
    return one_per_key(rows, keys, order)


def current(spark: SparkSession, folder: str, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The state an upsert stream has reached: the newest row of each key, late rows included."""
    rows = BatchLog(spark, f"{folder}/log").read()
    if rows is None:
        raise FileNotFoundError(folder)
    return _newest(rows, keys, order).drop(BATCH)


def fold(spark: SparkSession, folder: str, keys: list[str], order: list[Column | str]) -> bool:
    """Fold all batches of an upsert stream into a new base now; whether there were any."""
    return BatchLog(spark, f"{folder}/log").fold(lambda rows: _newest(rows, keys, order))


def keep_first_stream(source: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Arriving rows, one per key, by Spark's own state; of rows of one batch any may be the one.

    State is bounded by the watermark: a repeat later than ``delay`` after its key is passed on
    again. Rows without a full key are left out, as in the batch merge.
    """
    return source.where(~any_null(keys)).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def start_firsts(
    source: DataFrame,
    folder: str,
    checkpoint: str,
    keys: list[str],
    ts: str,
    ttl: str | None = None,
    order: list[Column | str] | None = None,
    trigger: Mapping[str, Any] = ONCE,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """The first row of each key that has not been seen before, whole, in ``folder/out`` (:func:`firsts`).

    The first of a batch is that of the smallest ``ts`` (or by ``order``); a row without a time comes last, and a key that has no
    other passes with it. Seen keys lie in a log with the event time at which they came. With ``ttl`` (an interval such as
    ``"40 days"``) a key is forgotten once events are that much newer, and passes again when it returns. A batch that is repeated
    gives the same rows again in place of its first ones. Rows without a full key are kept apart (:func:`refused`).

    Only key columns of the seen keys are read per batch; a batch is cut to one row per key in the map tasks before it meets them.
    """
    by = order or [F.col(ts).asc_nulls_last()]

    def live(rows: DataFrame, high: Column) -> Column:
        return F.lit(True) if ttl is None else F.col("_seen_at").isNull() | (F.col("_seen_at") + F.expr(f"INTERVAL {ttl}") >= high)

    def write(batch: DataFrame, number: int) -> None:
        log = BatchLog(batch.sparkSession, f"{folder}/log")
        if number < log.version().folded:
            return  # a later batch is folded, so this one has been passed on
        batch = batch.persist()
        try:
            first = one_per_key(_refuse(batch, folder, keys, number), keys, by)
            high = batch.agg(F.max(ts).alias("high"))
            seen = log.read(before=number)
            if seen is not None:
                high = seen.agg(F.max("_seen_at").alias("high")).unionAll(high).agg(F.max("high").alias("high"))
                known = seen.join(F.broadcast(high)).where(live(seen, F.col("high"))).select(*keys).distinct()
                first = first.join(known, keys, "left_anti")
            passed = first.select(*batch.columns)
            passed.write.mode("overwrite").parquet(f"{folder}/out/{BATCH}={number}")
            stored = batch.sparkSession.read.schema(passed.schema).parquet(f"{folder}/out/{BATCH}={number}")
            log.write(stored.join(F.broadcast(high)).select(*keys, F.coalesce(F.col(ts), F.col("high")).alias("_seen_at")), number)
        finally:
            batch.unpersist()
        log.fold(lambda rows: _still_live(rows, keys, live), fold_every)

    return _started(source.writeStream.foreachBatch(write), checkpoint, trigger)


def _still_live(rows: DataFrame, keys: list[str], live: Any) -> DataFrame:
    """The seen keys that a later batch may still ask for; the newest entry of each key."""
    high = rows.agg(F.max("_seen_at").alias("high"))
    alive = rows.join(F.broadcast(high)).where(live(rows, F.col("high"))).drop("high")
    return one_per_key(alive, keys, [F.col("_seen_at").desc_nulls_last(), F.col(BATCH).desc()])


def firsts(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that :func:`start_firsts` has passed on."""
    return spark.read.parquet(f"{folder}/out").drop(BATCH)


def _per_window(slow: DataFrame, ts: str, kind: str, ms: str, width: str) -> DataFrame:
    counted = slow.groupBy(F.window(ts, width).alias("_w"), kind).agg(
        F.count(F.lit(1)).alias("n_slow"), F.max(ms).alias("worst")
    )
    return counted.select(F.col("_w.start").alias("window_start"), kind, "n_slow", "worst")


def slow_windows(
    df: DataFrame, ts: str, kind: str, ms: str, at_least: float = SLOW_AT, width: str = "10 minutes"
) -> DataFrame:
    """Slow events per tumbling window and kind, of a batch."""
    return _per_window(df.where(F.col(ms) >= at_least), ts, kind, ms, width)


def start_slow_monitor(
    source: DataFrame,
    folder: str,
    checkpoint: str,
    ts: str,
    kind: str,
    ms: str,
    delay: str,
    at_least: float = SLOW_AT,
    width: str = "10 minutes",
    trigger: Mapping[str, Any] = ONCE,
) -> StreamingQuery:
    """``slow_windows`` of a stream, each window written once it is complete.

    The filter reads the event time, which keeps it above the watermark: fast events too move the
    watermark on, so a window does not wait for the next slow event.
    """
    timed = source.withWatermark(ts, delay)
    slow = timed.where(F.when(F.col(ts).isNotNull(), F.col(ms) >= at_least))
    windows = _per_window(slow, ts, kind, ms, width)
    return _started(windows.writeStream.format("parquet").option("path", folder).outputMode("append"), checkpoint, trigger)
