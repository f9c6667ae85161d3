"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

COPIES = 10_000
"""A row with more copies than this is repeated by several tasks."""


def append_all(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts; columns match by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def difference(left: DataFrame, *others: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are in none of ``others``."""
    return reduce(DataFrame.subtract, others, left)


def balance(left: DataFrame, right: DataFrame, name: str = "n") -> DataFrame:
    """Each distinct row with its copies in ``left`` minus those in ``right``, where they differ.

    Both sides are counted in one aggregation, map-side first, so copies cost one row per task.
    """
    signed = left.withColumn(name, F.lit(1).cast("bigint")).unionByName(right.withColumn(name, F.lit(-1).cast("bigint")))
    return signed.groupBy(*left.columns).agg(F.sum(name).alias(name)).where(F.col(name) != 0)


def multiset_difference(left: DataFrame, right: DataFrame, copies: int = COPIES) -> DataFrame:
    """Rows of ``left`` without those of ``right``, counting repeats.

    A row that is left over very often is cut into chunks of copies, and the chunks are spread
    before they are written out.
    """
    rest = balance(left, right, "_n").where(F.col("_n") > 0)
    few = rest.where(F.col("_n") <= copies)
    many = rest.where(F.col("_n") > copies)
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / copies)))
    many = many.withColumn("_chunk", chunk)
    many = many.withColumn("_n", F.least(F.lit(copies).cast("bigint"), F.col("_n") - F.col("_chunk") * copies))
    many = many.repartition(*left.columns, "_chunk").drop("_chunk")
    repeated = few.unionByName(many).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    return repeated.select(*left.columns)
