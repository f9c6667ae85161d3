"""Ranked and ordered lists per group."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablecare.operators.keys import (
    HOT_ROWS,
    HOT_SHARE,
    first_per_key,
    hot_keys,
    number_rows,
    null_safe,
    row_hash,
    split_by,
    total_order,
)


def latest_per_group(df: DataFrame, group: list[str], ts: str, row_id: str, n: int) -> DataFrame:
    """The newest ``n`` rows of each group, NULL dates last, smallest id on ties."""
    return first_per_key(df, group, [F.col(ts).desc_nulls_last(), F.col(row_id)], n)


def resume_list(state: DataFrame, user: str, position: str, ts: str, row_id: str, n: int) -> DataFrame:
    """Rows in progress, the newest ``n`` per user."""
    return latest_per_group(state.where(F.col(position) > 0), [user], ts, row_id, n)


def favourites(state: DataFrame, user: str, flag: Column, ts: str) -> DataFrame:
    """How many favourites each user has, and the latest."""
    return state.where(flag).groupBy(user).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("latest"))


def retention_plan(
    df: DataFrame,
    group: list[str],
    ts: str,
    row_id: str,
    days: int,
    keep: int,
    as_of: datetime | str,
    name: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Rows to remove: older than ``days`` at ``as_of`` and not among the newest ``keep`` of their group.

    ``days`` of 0 or less removes nothing. With ``pattern``, only rows whose ``name`` matches take part.
    The newest rows are few (``keep`` per group), so they are found first and excluded by id.
    """
    if days <= 0:
        return df.limit(0)
    own = df.where(F.col(name).rlike(pattern)) if pattern else df
    old = own.where(F.col(ts) < F.lit(as_of).cast(df.schema[ts].dataType) - F.make_dt_interval(F.lit(days)))
    if keep <= 0:
        return old
    newest = first_per_key(own.select(*group, ts, row_id), group, [F.col(ts).desc(), F.col(row_id)], keep)
    newest = newest.select(*[F.col(c).alias(f"_kept_{c}") for c in [*group, row_id]])
    same = null_safe(old, newest, [(c, f"_kept_{c}") for c in [*group, row_id]])
    return old.join(newest, same, "left_anti").select(*df.columns)


def first_occurrence(df: DataFrame, keys: list[str], order: list[str], name: str = "is_first") -> DataFrame:
    """Each row with a flag: the first of its key in ``order``, or a repeat.

    Rows with equal ``order`` are told apart by a hash of the row; only rows that are equal throughout share the flag. The
    join is on key, order and hash together, so the rows of a hot key spread over the tasks.
    """
    marked = df.withColumn("_print", row_hash(df, df.columns, 1))
    columns = [*keys, *order, "_print"]
    firsts = first_per_key(marked.select(*columns), keys, [*order, "_print"])
    firsts = firsts.select(*[F.col(c).alias(f"_first_{c}") for c in columns], F.lit(True).alias("_is"))
    joined = marked.join(firsts, null_safe(marked, firsts, [(c, f"_first_{c}") for c in columns]), "left")
    return joined.select(*df.columns, F.coalesce("_is", F.lit(False)).alias(name))


def next_in_sequence(
    df: DataFrame,
    group: list[str],
    order: list[str],
    nexts: dict[str, str],
    position: str = "position",
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    fraction: float = 0.1,
) -> DataFrame:
    """Each row with its place in its group and columns of the row after it.

    ``nexts`` maps new names to columns. Ordinary groups take one window. A hot group would be one
    endless task, so hot groups are numbered across tasks and joined to themselves one place on.
    """
    window = Window.partitionBy(*group).orderBy(*total_order(df, list(order)))

    def windowed(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                position: F.row_number().over(window).cast("bigint"),
                **{new: F.lead(old).over(window) for new, old in nexts.items()},
            }
        )

    hot = hot_keys(df, group, share, min_rows, fraction)
    if hot is None:
        return windowed(df)
    large, rest = split_by(df, group, hot)
    placed = number_rows(large, [*group, *order], "_row")
    starts = placed.groupBy(*group).agg(F.min("_row").alias("_start"))
    starts = F.broadcast(starts.select(*[F.col(g).alias(f"_hot_{g}") for g in group], "_start"))
    placed = placed.join(starts, null_safe(placed, starts, [(g, f"_hot_{g}") for g in group]))
    placed = placed.withColumn(position, F.col("_row") - F.col("_start") + 1).select(*df.columns, "_row", position)
    after = placed.where(F.col(position) > 1).select(
        (F.col("_row") - 1).alias("_before"), *[F.col(old).alias(new) for new, old in nexts.items()]
    )
    joined = placed.join(after, F.col("_row") == F.col("_before"), "left").drop("_row", "_before")
    return windowed(rest).unionByName(joined)
