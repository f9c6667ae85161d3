"""Comparison of a table with its copy."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame, functions as F

from tablecare.functions.text import fingerprint
from tablecare.operators.health import row_counts
from tablecare.operators.keys import low_half, null_safe, row_hash
from tablecare.operators.sets import balance
from tablecare.session import cut_lineage


def reconcile_counts(source: Mapping[str, DataFrame], copy: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table on both sides and the difference; a table absent on one side counts 0."""
    left = row_counts(source).withColumnRenamed("n_rows", "source_rows")
    right = row_counts(copy).withColumnRenamed("n_rows", "copy_rows")
    joined = left.join(right, "table", "full").na.fill(0)
    return joined.withColumn("difference", F.col("copy_rows") - F.col("source_rows"))


def reconcile_rows(source: DataFrame, copy: DataFrame, keys: list[str], by: str = "values") -> DataFrame:
    """Keys that differ: (keys, status) with ``missing``, ``extra`` or ``changed``. Keys are unique.

    ``by='fingerprint'`` shuffles a SHA-256 of each row in place of its values: less data for wide rows.
    """
    if by not in ("values", "fingerprint"):
        raise ValueError("by must be 'values' or 'fingerprint'")
    values = [c for c in source.columns if c not in keys]
    content = fingerprint(F.to_json(F.struct(*values))) if by == "fingerprint" else F.struct(*values)
    left = source.select(*keys, content.alias("_left"), F.lit(True).alias("_in_left"))
    right = copy.select(
        *[F.col(k).alias(f"_copy_{k}") for k in keys], content.alias("_right"), F.lit(True).alias("_in_right")
    )
    joined = left.join(right, null_safe(left, right, [(k, f"_copy_{k}") for k in keys]), "full")
    status = (
        F.when(F.col("_in_right").isNull(), "missing")
        .when(F.col("_in_left").isNull(), "extra")
        .when(~F.col("_left").eqNullSafe(F.col("_right")), "changed")
    )
    named = [F.when(F.col("_in_left"), F.col(k)).otherwise(F.col(f"_copy_{k}")).alias(k) for k in keys]
    return joined.select(*named, status.alias("status")).where(F.col("status").isNotNull())


BUCKETS = 1024
"""Buckets of keys on the first level, and parts of each that differs on the next."""


def _fingerprints(df: DataFrame, at: list[str], side: str) -> DataFrame:
    """Per bucket the number of rows and sums and xors of their hashes: equal for equal rows in any order."""
    facts = [F.count(F.lit(1)), F.sum(low_half(F.col("_one"))), F.bit_xor("_one"), F.sum(low_half(F.col("_two"))), F.bit_xor("_two")]
    return df.groupBy(*at).agg(F.struct(*[f.alias(f"f{i}") for i, f in enumerate(facts)]).alias(side))


def differing_buckets(source: DataFrame, copy: DataFrame, at: list[str]) -> DataFrame:
    """The buckets whose fingerprints differ, or that one side lacks; one row per bucket travels, not the rows."""
    both = _fingerprints(source, at, "_left").join(_fingerprints(copy, at, "_right"), at, "full")
    return both.where(~F.col("_left").eqNullSafe(F.col("_right"))).select(*at)


def suspects(source: DataFrame, copy: DataFrame, keys: list[str], buckets: int = BUCKETS, levels: int = 2) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in buckets of keys that differ, level by level.

    Each level cuts the buckets that differ into ``buckets`` parts and compares their fingerprints. Equal buckets are left out of every
    later level. Where a few rows differ, ``rows / buckets ** levels`` rows for each of them remain.
    """
    copy = copy.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in source.schema.fields])
    sides = []
    for df in (source, copy):
        marked = df.withColumn("_place", row_hash(df, keys, 3)).withColumns({"_one": row_hash(df, df.columns, 1), "_two": row_hash(df, df.columns, 2)})
        place = F.col("_place")
        for level in range(levels):
            marked = marked.withColumn(f"_at_{level}", F.pmod(place, F.lit(buckets)).cast("int"))
            place = F.expr(f"_place div {buckets ** (level + 1)}")
        sides.append(marked)
    at: list[str] = []
    for level in range(levels):
        at.append(f"_at_{level}")
        different = cut_lineage(differing_buckets(*sides, at))
        small = different.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        sides = [side.join(F.broadcast(different) if small else different, at, "left_semi") for side in sides]
    left, right = [side.select(*source.columns) for side in sides]
    return left, right


MOST_BROADCAST = 1_000_000
"""Numbers of differing buckets that are broadcast at most; of more, rows and numbers are shuffled."""


def reconcile_by_bucket(source: DataFrame, copy: DataFrame, keys: list[str], buckets: int = BUCKETS, levels: int = 2) -> DataFrame:
    """:func:`reconcile_rows` for large tables that are mostly equal: only rows in buckets that differ meet in the join.

    A bucket is a range of hashes of the key. Its fingerprint (row count, sums and xors of two 64-bit hashes of the rows) is
    added up in the map tasks, so the tables are scanned once per level but hardly shuffled. A difference could only hide if all sums and
    xors agreed by chance.
    """
    return reconcile_rows(*suspects(source, copy, keys, buckets, levels), keys)


def reconcile_multiset(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Distinct rows that one side has more often: ``missing`` or ``extra``, and how many copies."""
    uneven = balance(source, copy.select(*source.columns), "copies")
    status = F.when(F.col("copies") > 0, "missing").otherwise("extra")
    return uneven.withColumn("status", status).withColumn("copies", F.abs("copies"))


def reconcile(
    source: Mapping[str, DataFrame], copy: Mapping[str, DataFrame], keys: Mapping[str, list[str]]
) -> DataFrame:
    """Per table the counts and the number of missing, extra and changed rows."""
    parts = []
    for name, key in keys.items():
        found = reconcile_rows(source[name], copy[name], key).agg(
            *[F.count_if(F.col("status") == s).alias(s) for s in ("missing", "extra", "changed")]
        )
        parts.append(found.withColumn("table", F.lit(name)))
    return reconcile_counts(source, copy).join(reduce(DataFrame.unionByName, parts), "table", "left")
