"""Referential work: orphans, placeholders, guarded children, audits.

Child-to-parent joins stay plain equi-joins on two raw inputs: Spark broadcasts the parent
when its measured size allows, and otherwise splits skewed child partitions at run time.
Where only counts are wanted, the child side is grouped first.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tablecare.operators.keys import any_null
from tablecare.spec import TableSpec


def _names(columns: str | list[str] | tuple[str, ...]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _parent_keys(parent: DataFrame, columns: list[str]) -> DataFrame:
    return parent.select(*[F.col(c).alias(f"_parent_{i}") for i, c in enumerate(columns)])


def _matches(child: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(c) == F.col(f"_parent_{i}") for i, c in enumerate(child)])


def drop_orphans(
    child: DataFrame, parent: DataFrame, child_key: str | list[str], parent_key: str | list[str], nulls: str = "keep"
) -> DataFrame:
    """Child rows whose parent exists. ``nulls`` says what happens to rows without a key.

    With ``keep``, NULL keys are judged ahead of the join, so they never meet in one task.
    """
    ck, pk = _names(child_key), _names(parent_key)
    keys = _parent_keys(parent, pk)
    if nulls == "drop":
        return child.join(keys, _matches(ck), "left_semi")
    if nulls != "keep":
        raise ValueError("nulls must be 'keep' or 'drop'")
    kept = child.where(~any_null(ck)).join(keys, _matches(ck), "left_semi")
    return kept.unionByName(child.where(any_null(ck)))


def orphans(
    child: DataFrame, parent: DataFrame, child_key: str | list[str], parent_key: str | list[str], nulls: str = "keep"
) -> DataFrame:
    """The rows ``drop_orphans`` leaves out."""
    ck, pk = _names(child_key), _names(parent_key)
    gone = child.where(~any_null(ck)).join(_parent_keys(parent, pk), _matches(ck), "left_anti")
    return gone if nulls == "keep" else gone.unionByName(child.where(any_null(ck)))


def guard_children(
    pending: DataFrame, parent: DataFrame, child_key: str | list[str], parent_key: str | list[str]
) -> DataFrame:
    """Pending rows that may be inserted because their parent exists."""
    return drop_orphans(pending, parent, child_key, parent_key, nulls="drop")


def repoint_orphans(
    df: DataFrame, key: str, parent_key: str, placeholder: object, parent: DataFrame | None = None
) -> DataFrame:
    """Keys without a parent point at ``placeholder``; keys that already did become NULL first.

    Without ``parent`` the table is its own parent. ``parent_key`` is the parent's primary key.
    """
    keys = (df if parent is None else parent).select(F.col(parent_key).alias("_parent"))
    keys = keys.withColumn("_known", F.lit(True))
    fresh = df.withColumn(key, F.when(F.col(key) != F.lit(placeholder), F.col(key)))
    joined = fresh.join(keys, fresh[key] == keys["_parent"], "left")
    lost = F.col(key).isNotNull() & F.col("_known").isNull()
    repointed = joined.withColumn(key, F.when(lost, F.lit(placeholder).cast(df.schema[key].dataType)).otherwise(F.col(key)))
    return repointed.select(*df.columns)


def lookup_pairs(pending: DataFrame, stored: DataFrame, keys: list[str], take: dict[str, str]) -> DataFrame:
    """Pending rows that match a stored row on all ``keys``, exactly and with case.

    ``take`` maps new column names to stored columns.
    """
    right = stored.select(
        *[F.col(k).alias(f"_parent_{i}") for i, k in enumerate(keys)], *[F.col(c).alias(n) for n, c in take.items()]
    )
    joined = pending.join(right, _matches(keys), "inner")
    return joined.select(*pending.columns, *take)


def missing(requested: DataFrame, present: DataFrame, column: str) -> DataFrame:
    """Names asked for that are not there."""
    return requested.select(column).distinct().join(present.select(column), column, "left_anti")


def unreferenced(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str) -> DataFrame:
    """Dimension rows no fact row uses."""
    used = fact.select(F.col(fact_key).alias("_used")).distinct()
    return dim.join(used, F.col(dim_key) == F.col("_used"), "left_anti")


def with_child_count(df: DataFrame, child: DataFrame, key: str, child_key: str, name: str = "n_children") -> DataFrame:
    """Each row with the number of its children; children are counted before the join."""
    counts = child.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias(name))
    joined = df.join(counts, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def registry_report(
    registry: DataFrame, members: DataFrame, key: str, member_key: str, size: str
) -> DataFrame:
    """Each registry row with the number and total size of its members (0 where it has none)."""
    totals = members.groupBy(F.col(member_key).alias("_key")).agg(
        F.count(F.lit(1)).alias("n_members"), F.sum(size).alias("total_size")
    )
    joined = registry.join(totals, F.col(key) == F.col("_key"), "left").drop("_key")
    zero = {n: F.coalesce(F.col(n), F.lit(0).cast(joined.schema[n].dataType)) for n in ("n_members", "total_size")}
    return joined.withColumns(zero)


def audit_references(tables: Mapping[str, DataFrame], specs: list[TableSpec]) -> DataFrame:
    """One row per foreign key: child rows, rows without a key, orphans. Self-references are left out."""
    parts = []
    for spec in specs:
        for edge in spec.foreign_keys:
            if edge.parent == spec.name:
                continue
            child = list(edge.columns)
            counts = tables[spec.name].groupBy(*child).agg(F.count(F.lit(1)).alias("_n"))
            parent = _parent_keys(tables[edge.parent], list(edge.parent_columns)).distinct()
            joined = counts.join(parent.withColumn("_known", F.lit(True)), _matches(child), "left")
            blank = any_null(child)
            parts.append(
                joined.agg(
                    F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
                    F.coalesce(F.sum(F.when(blank, F.col("_n"))), F.lit(0)).alias("null_keys"),
                    F.coalesce(F.sum(F.when(~blank & F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias("orphans"),
                ).select(
                    F.lit(spec.name).alias("child"),
                    F.lit(",".join(child)).alias("child_key"),
                    F.lit(edge.parent).alias("parent"),
                    "child_rows",
                    "null_keys",
                    "orphans",
                )
            )
    if not parts:
        raise ValueError("no foreign keys to audit")
    return reduce(DataFrame.unionByName, parts)
