"""Sorted tops, pages, previews and samples."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql import types as T

from tablecare.operators.keys import number_rows, total_order
from tablecare.session import estimated_bytes, shuffle_partitions

TOP_LIMIT = 50
PREVIEW_LIMIT = 200
SHALLOW_ROWS = 5_000


def clamp(value: int, low: int, high: int) -> int:
    """``value`` moved into [low, high]."""
    return max(low, min(high, value))


def top(df: DataFrame, order: list[Column | str], limit: int = TOP_LIMIT) -> DataFrame:
    """The first ``limit`` rows under a total order, at least one (a per-task top, then a merge)."""
    return df.orderBy(*total_order(df, order)).limit(max(1, limit))


def worst(df: DataFrame, order: list[Column | str], cap: int) -> DataFrame:
    """A worst-first list with a fixed cap."""
    return df.orderBy(*total_order(df, order)).limit(cap)


def page(df: DataFrame, order: list[Column | str], size: int, number: int) -> DataFrame:
    """Page ``number`` (from 0) of ``size`` rows.

    Near the start this is a top-n. A deep page would drag all rows before it through one task, so
    it is cut out of rows numbered across tasks; if ``order`` consists of column names, only of the rows near it (:func:`near_rank`).
    """
    start = size * number
    if start + size <= SHALLOW_ROWS:
        return df.orderBy(*total_order(df, order)).offset(start).limit(size)
    before = 0
    if all(isinstance(o, str) for o in order) and order:
        df, before = near_rank(df, list(order), start, start + size)
    numbered = number_rows(df, order, "_row")
    first = start - before
    return numbered.where((F.col("_row") >= first) & (F.col("_row") < first + size)).drop("_row")


def near_rank(df: DataFrame, order: list[str], first: int, end: int) -> tuple[DataFrame, int]:
    """(rows, before): the rows in the ranges of ``order`` (ascending, NULLs first) that hold ranks ``first`` to ``end``, and how many rows come before them.

    Only the order columns are shuffled, by ranges; the driver gets the size and the smallest value of each range. The rows are then a
    filtered scan of the table, so neither a sort nor a copy touches the others. Equal values lie in one range.
    """
    value = F.struct(*order)
    laid = df.select(*order)
    ranges = shuffle_partitions(estimated_bytes(laid), df.sparkSession.sparkContext.defaultParallelism)
    laid = laid.repartitionByRange(ranges, *order)
    sizes = laid.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low")).orderBy("part").collect()
    before, low, high, passed = 0, None, None, 0
    for row in sizes:
        if passed + row["n"] <= first:
            before = passed + row["n"]
        elif passed >= end:
            high = row["low"]
            break
        elif low is None:
            low = row["low"]
        passed += row["n"]
    if low is None:
        return df.limit(0), before
    edges = df.sparkSession.createDataFrame([(low, high)], T.StructType([T.StructField(n, _all_nullable(laid.schema)) for n in ("_low", "_high")]))
    inside = (value >= F.col("_low")) & (F.col("_high").isNull() | (value < F.col("_high")))
    return df.join(F.broadcast(edges), inside).select(*df.columns), before


def _all_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


class Preview(NamedTuple):
    """Rows on the driver and whether there were more."""

    rows: list[Row]
    truncated: bool


def preview(df: DataFrame, limit: int = 50) -> Preview:
    """At most ``limit`` rows, with a flag that more exist; the driver holds them, so over 200 are refused."""
    if limit > PREVIEW_LIMIT:
        raise ValueError(f"a preview has at most {PREVIEW_LIMIT} rows")
    limit = max(1, limit)
    rows = df.limit(limit + 1).collect()
    return Preview(rows[:limit], len(rows) > limit)


def sample_rows(df: DataFrame, fraction: float = 0.3, seed: int | None = None) -> DataFrame:
    """A Bernoulli sample: one scan, no sort."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: str, percent: int = 30) -> DataFrame:
    """A repeatable sample: the same keys are in it on every run."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % 100
    return df.where(bucket < percent)
