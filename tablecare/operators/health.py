"""Data-health measures."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tablecare.functions.text import preview_text

# Thresholds the reports use unless told otherwise.
SLOW_MEAN_MS = 100.0
SLOW_WARN_MS = 500.0
SLOW_CALLS = 2
SLOW_LIST = 10
DEAD_ROWS = 1000
DEAD_RATIO = 0.20
DEAD_LIST = 20
REFRESH_ROWS = 1000
STALE_ROWS = 100
STALE_DAYS = 7


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table; parquet answers from its footers."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table"), "n_rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def estimate_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Total rows over several tables (exact, because counts are cheap)."""
    return row_counts(tables).agg(F.sum("n_rows").alias("n_rows"))


def high_water_drift(marks: DataFrame, tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Recorded last values that trail the data: a next key would collide.

    ``marks`` has (table, last_value); ``tables`` maps a name to its frame and key column.
    """
    tops = [
        df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("max_value")).select(
            F.lit(name).alias("table"), F.lit(key).alias("column"), "max_value"
        )
        for name, (df, key) in tables.items()
    ]
    joined = reduce(DataFrame.unionByName, tops).join(marks, "table")
    return joined.where(F.col("last_value") < F.col("max_value")).select("table", "column", "last_value", "max_value")


def slow_report(
    log: DataFrame,
    key: str,
    ms: str,
    mean_over: float = SLOW_MEAN_MS,
    calls_over: int = SLOW_CALLS,
    warn_at: float = SLOW_WARN_MS,
    limit: int = SLOW_LIST,
    rows: str | None = None,
    hits: str | None = None,
    reads: str | None = None,
) -> DataFrame:
    """The slowest statements of a raw timing log, worst first.

    ``rows`` names returned rows, ``hits`` and ``reads`` the blocks found in memory and read. Times
    are summed as decimals, so the result does not depend on the order of the rows. A text key stays whole, with its
    beginning as ``preview`` beside it, so two long statements never become one.
    """
    exact = F.col(ms).cast("decimal(28,6)")
    columns: dict[str, Column] = {
        "calls": F.count(F.lit(1)),
        "total_ms": F.sum(exact).cast("double"),
        "mean_ms": F.sum(exact).cast("double") / F.count(F.lit(1)),
    }
    if rows:
        columns["avg_rows"] = F.round(F.sum(rows) / F.count(F.lit(1)), 1)
    if hits and reads:
        touched = F.nullif(F.sum(hits) + F.sum(reads), F.lit(0))
        columns["hit_pct"] = F.round(F.sum(hits) * 100.0 / touched, 1)
    grouped = log.groupBy(key).agg(*[value.alias(name) for name, value in columns.items()])
    slow = grouped.where((F.col("mean_ms") > mean_over) & (F.col("calls") > calls_over))
    labelled = slow.withColumn("severity", F.when(F.col("mean_ms") >= warn_at, "warn").otherwise("ok"))
    if dict(log.dtypes)[key] == "string":
        labelled = labelled.withColumn("preview", preview_text(F.col(key)))
    return labelled.orderBy(F.col("mean_ms").desc(), key).limit(limit)


def dead_ratio(
    log: DataFrame,
    keys: list[str],
    group: str,
    dead_over: int = DEAD_ROWS,
    ratio: float = DEAD_RATIO,
    limit: int = DEAD_LIST,
) -> DataFrame:
    """Groups with many superseded versions: all but one row of each key is dead, whatever the order.

    Versions are counted per key first and then per group, both combined map-side.
    """
    versions = log.groupBy(group, *[k for k in keys if k != group]).agg(F.count(F.lit(1)).alias("_n"))
    per_group = versions.groupBy(group).agg(
        F.count(F.lit(1)).alias("live"), (F.sum("_n") - F.count(F.lit(1))).alias("dead")
    )
    share = F.col("dead") / (F.col("live") + F.col("dead"))
    flagged = per_group.where((F.col("dead") > dead_over) & (share >= ratio))
    flagged = flagged.withColumn("dead_pct", F.round(share * 100.0, 1))
    return flagged.orderBy(F.col("dead_pct").desc(), group).limit(limit)


def refresh_policy(stats: DataFrame, minimum: int = REFRESH_ROWS) -> DataFrame:
    """Which tables need a refresh or a compaction, from (n_rows, changed, dead)."""
    rows = F.greatest(F.col("n_rows"), F.lit(0))
    tenth, fifth = F.floor(rows / 10).cast("bigint"), F.floor(rows / 5).cast("bigint")
    return stats.withColumns(
        {
            "needs_refresh": F.col("changed") >= F.greatest(F.lit(minimum), tenth),
            "needs_compaction": F.col("dead") >= F.greatest(F.lit(minimum), fifth),
        }
    )


def stale_groups(
    df: DataFrame,
    group: list[str],
    ts: str,
    as_of: datetime | str,
    min_rows: int = STALE_ROWS,
    days: int = STALE_DAYS,
) -> DataFrame:
    """Groups with enough rows and no activity in the last ``days`` before ``as_of``."""
    grouped = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), F.max(ts).alias("last_seen"))
    cutoff = F.lit(as_of).cast(df.schema[ts].dataType) - F.make_dt_interval(F.lit(days))
    return grouped.where((F.col("n_rows") >= min_rows) & (F.col("last_seen").isNull() | (F.col("last_seen") < cutoff)))


def uuid_bounds(df: DataFrame, key: str, group: list[str] = ()) -> DataFrame:
    """Smallest and largest canonical UUID, per group if one is given."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("min_id"), F.max(key).alias("max_id")
    )


def status_rollup(df: DataFrame, area: str, outcome: str, failed: str, skipped: str) -> DataFrame:
    """Per area the numbers of checks, passed, failed and skipped, and a state: failed, skipped, partial or passed."""
    grouped = df.groupBy(area).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(outcome) == failed).alias("failed"),
        F.count_if(F.col(outcome) == skipped).alias("skipped"),
    )
    counted = grouped.withColumn("passed", F.col("total") - F.col("failed") - F.col("skipped"))
    partial = F.when(F.col("skipped") > 0, "partial").otherwise("passed")
    none = F.when(F.col("passed") == 0, "skipped").otherwise(partial)
    return counted.withColumn("state", F.when(F.col("failed") > 0, "failed").otherwise(none))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct combinations of ``columns``."""
    return df.select(*columns).distinct()
