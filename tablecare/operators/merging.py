"""Merges as functions (stored, incoming) -> new stored.

``stored`` has one row per key. Incoming rows are cut to one per key before they meet it, and
only the key columns of ``stored`` take part in the anti-joins. Rows without a full key are
refused, as a primary key would refuse them; ``merge_report`` counts them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tablecare.operators.keys import (
    any_null,
    attach_group,
    attach_values,
    first_per_key,
    group_stats,
    null_safe,
    number_rows,
)


def one_per_key(incoming: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first incoming row of each complete key."""
    return first_per_key(incoming.where(~any_null(keys)), keys, order)


def new_rows(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The rows a keep-first merge would add.

    The stored keys are first cut to those that arrive. When few rows arrive that is a broadcast
    filter, so a large stored table is scanned (key columns only) and never shuffled.
    """
    fresh = one_per_key(incoming, keys, order)
    held = stored.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    return fresh.join(held, keys, "left_anti").select(*incoming.columns)


def merge_keep_first(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Insert what is absent; a stored row is never changed."""
    return stored.unionByName(new_rows(stored, incoming, keys, order), allowMissingColumns=True)


def merge_last_wins(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Insert or replace; ``order`` sorts incoming rows newest first."""
    latest = one_per_key(incoming, keys, order)
    untouched = stored.join(latest.select(*keys), keys, "left_anti").select(*stored.columns)
    return untouched.unionByName(latest, allowMissingColumns=True)


def merge_full_row(
    stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column | str], required: list[str] = ()
) -> DataFrame:
    """Last-write-wins for full rows; rows that have vanished are created again.

    A patch with only some columns could not become a row, so all of ``required`` (every stored
    column by default) must be there.
    """
    there = {c.lower() for c in incoming.columns}
    absent = [c for c in (required or stored.columns) if c.lower() not in there]
    if absent:
        raise ValueError(f"a full-row merge needs the columns {', '.join(absent)}")
    return merge_last_wins(stored, incoming, keys, order)


def update_matched(stored: DataFrame, patch: DataFrame, keys: list[str], order: list[Column | str] = ()) -> DataFrame:
    """Change matched rows only; a NULL in the patch lands as NULL. ``order`` picks one patch per key.

    Names match without case; a patch column that is not stored is an error.
    """
    own = {c.lower(): c for c in stored.columns}
    unknown = [c for c in patch.columns if c.lower() not in own]
    if unknown:
        raise ValueError(f"not stored: {', '.join(unknown)}")
    given = {k.lower() for k in keys}
    changes = [own[c.lower()] for c in patch.columns if c.lower() not in given]
    latest = one_per_key(patch, keys, list(order)).toDF(*[own[c.lower()] for c in patch.columns])
    latest = latest.select(*keys, F.struct(*changes).alias("_patch"), F.lit(True).alias("_hit"))
    joined = stored.join(latest, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_patch.{c}")).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in stored.columns
        ]
    )


class Reused(NamedTuple):
    """New dimension rows, the repointed bridge, and the ids that were replaced."""

    dim: DataFrame
    bridge: DataFrame
    remap: DataFrame


def repoint_bridge(bridge: DataFrame, remap: DataFrame, bridge_id: str) -> DataFrame:
    """Bridge rows under their new ids, equal rows once. ``remap`` has one (old_id, new_id) per old id."""
    joined = bridge.join(remap, bridge[bridge_id] == remap["old_id"], "left")
    moved = joined.withColumn(bridge_id, F.coalesce("new_id", bridge_id))
    return moved.select(*bridge.columns).distinct()


def reuse_values(
    pending: DataFrame, bridge: DataFrame, stored: DataFrame, dim_id: str, keys: list[str], bridge_id: str
) -> Reused:
    """Replace pending values that are stored already, and pending copies, by one id.

    The stored id wins; among pending copies of a new value the smallest id wins. Every pairing in
    the bridge survives under the winning id.
    """
    held = stored.groupBy(*[F.col(k).alias(f"_held_{k}") for k in keys]).agg(F.min(dim_id).alias("_held"))
    wanted = group_stats(pending, keys, {"_first": F.min(dim_id)})
    target = wanted.join(held, null_safe(wanted, held, [(k, f"_held_{k}") for k in keys]), "left")
    target = target.withColumn("new_id", F.coalesce("_held", "_first"))
    fresh = target.where(F.col("_held").isNull()).select(F.col("_first").alias("_keep"))
    dim = pending.join(fresh, pending[dim_id] == fresh["_keep"], "left_semi")

    won = attach_values(pending.select(dim_id, *keys), keys, target, ["new_id"])
    remap = won.where(F.col(dim_id) != F.col("new_id")).select(F.col(dim_id).alias("old_id"), "new_id")
    return Reused(dim, repoint_bridge(bridge, remap, bridge_id), remap)


def keep_id(df: DataFrame, dim_id: str, keys: list[str]) -> DataFrame:
    """Each row with the smallest id of its key, as ``keep_id``."""
    return attach_group(df, keys, {"keep_id": F.min(dim_id)})


def consolidate(dim: DataFrame, bridge: DataFrame, dim_id: str, keys: list[str], bridge_id: str) -> Reused:
    """One dimension row per key, the smallest id; the bridge follows, equal rows once."""
    remap = keep_id(dim.select(dim_id, *keys), dim_id, keys).where(F.col(dim_id) != F.col("keep_id"))
    remap = remap.select(F.col(dim_id).alias("old_id"), F.col("keep_id").alias("new_id"))
    survivors = first_per_key(dim, keys, [dim_id])
    return Reused(survivors, repoint_bridge(bridge, remap, bridge_id), remap)


def merge_report(stored: DataFrame, incoming: DataFrame, keys: list[str], mode: str, table: str) -> DataFrame:
    """How many incoming rows are read, inserted, updated, skipped and refused.

    The rows are grouped by key before the join: a key with n incoming rows is inserted or updated
    once, and the other n - 1 rows are skipped.
    """
    if mode not in ("keep_first", "last_wins"):
        raise ValueError("mode must be 'keep_first' or 'last_wins'")
    counts = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    held = stored.select(*[F.col(k).alias(f"_held_{k}") for k in keys], F.lit(True).alias("_held"))
    on = [counts[k] == held[f"_held_{k}"] for k in keys]
    joined = counts.join(held, on, "left")
    refused, known = any_null(keys), F.col("_held").isNotNull()
    zero = F.lit(0).cast("bigint")

    def rows(test: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, value)), zero)

    one = F.lit(1).cast("bigint")
    updated = rows(~refused & known, one) if mode == "last_wins" else zero
    left_over = F.when(known, F.col("_n")).otherwise(F.col("_n") - 1) if mode == "keep_first" else F.col("_n") - 1
    return joined.agg(
        F.coalesce(F.sum("_n"), zero).alias("read"),
        rows(~refused & ~known, one).alias("inserted"),
        updated.alias("updated"),
        rows(~refused, left_over).alias("skipped"),
        rows(refused, F.col("_n")).alias("refused"),
    ).select(F.lit(table).alias("table"), "read", "inserted", "updated", "skipped", "refused")


def assign_keys(stored: DataFrame, incoming: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """Incoming rows with keys numbered on from the largest stored one, in ``order``."""
    top = stored.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("top")).first()["top"]
    numbered = number_rows(incoming, order, "_row")
    return numbered.withColumn(key, F.col("_row") + F.lit(top + 1)).drop("_row")


