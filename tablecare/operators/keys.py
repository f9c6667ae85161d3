"""Helpers for keyed work that must hold when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tablecare.session import cut_lineage

HOT_SHARE = 1 / 5_000
"""A key is hot when it owns this share of the rows, so there are never more than 5 000 hot keys."""

HOT_ROWS = 1_000_000
"""Below this many rows a key is never hot: one task sorts or joins them easily."""

HOT_SPLITS = 64

GROUP_LIMIT = 1000
"""The default of ``spark.sql.optimizer.windowGroupLimitThreshold``."""


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality over several columns that lets NULL match NULL."""
    return reduce(Column.__and__, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def any_null(columns: list[str]) -> Column:
    """Whether one of the columns is NULL."""
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def _sortable(field: T.StructField) -> Column | None:
    if isinstance(field.dataType, (T.MapType, T.VariantType)):
        return F.to_json(F.col(field.name))
    return F.col(field.name)


def row_hash(df: DataFrame, columns: list[str], seed: int) -> Column:
    """64 bits of the values of a row, equal for equal rows; NULL is a value of its own, maps and variants count by their JSON."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    plain = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kinds[c].simpleString() or isinstance(kinds[c], T.VariantType) else F.col(f"`{c}`") for c in columns]
    nulls = F.concat(F.lit("_"), *[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *plain)


def low_half(hashed: Column) -> Column:
    """The lower 32 bits of a hash: those of 2**31 rows add up to a bigint."""
    return hashed.bitwiseAND(F.lit((1 << 32) - 1))


def total_order(df: DataFrame, order: list[Column | str], given: list[str] = ()) -> list[Column]:
    """``order`` followed by every other column, so that only equal rows can tie.

    Columns in ``given`` are equal anyway where the order is used.
    """
    named = [F.col(o) if isinstance(o, str) else o for o in order]
    used = {o for o in order if isinstance(o, str)} | set(given)
    return named + [_sortable(f) for f in df.schema.fields if f.name not in used]


def _salt(df: DataFrame) -> Column:
    """A number from 0 that spreads different rows, the same on every run."""
    return F.pmod(F.xxhash64(*[_sortable(f) for f in df.schema.fields]), F.lit(HOT_SPLITS)).cast("int")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark keeps at most ``n`` rows per key in each map task before it shuffles (window
    group limit), so a hot key sends ``n`` rows per task and not its whole group. It does so up to
    ``GROUP_LIMIT`` rows; a longer list is first cut within salted parts of each group.
    """
    columns = total_order(df, order, keys) or [F.col(k) for k in keys]

    def cut(rows: DataFrame, parts: list[str]) -> DataFrame:
        window = Window.partitionBy(*parts).orderBy(*columns)
        return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")

    if n <= GROUP_LIMIT:
        return cut(df, keys)
    return cut(cut(df.withColumn("_part", _salt(df)), [*keys, "_part"]).drop("_part"), keys)


def attach_group(
    df: DataFrame,
    keys: list[str],
    aggregates: dict[str, Column],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each row with the aggregates of its key, without a window over the whole group."""
    return attach_values(df, keys, group_stats(df, keys, aggregates), list(aggregates), share, min_rows)


def group_stats(df: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """One row per key: the aggregates, and ``_rows`` for ``attach_values``. Combined map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[a.alias(n) for n, a in aggregates.items()])


def attach_values(
    df: DataFrame,
    keys: list[str],
    stats: DataFrame,
    names: list[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each row with the columns ``names`` of the ``stats`` row of its key.

    ``stats`` has every key of ``df`` once, with its row count ``_rows``. The values of hot keys
    come from a broadcast of at most ``1 / share`` rows; their rows get a salt no partner has, so
    the shuffled join that serves the other keys spreads them over its tasks.
    """
    value = F.struct(*names)
    total = stats.agg(F.sum("_rows").alias("n")).scalar()
    hot = stats.where((F.col("_rows") >= min_rows) & (F.col("_rows") >= total * F.lit(share)))
    hot = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], value.alias("_hot")))
    # Always 0, but not a constant for the optimizer: a constant would leave the join keys and
    # become a filter, and the salt would spread nothing.
    partner = F.least(F.col("_rows"), F.lit(0)).cast("int")
    cold = stats.select(*[F.col(k).alias(f"_cold_{k}") for k in keys], value.alias("_cold"), partner.alias("_partner"))
    marked = df.join(hot, null_safe(df, hot, [(k, f"_hot_{k}") for k in keys]), "left")
    marked = marked.withColumn("_salt", F.when(F.col("_hot").isNull(), 0).otherwise(_salt(df) + 1))
    on = null_safe(marked, cold, [(k, f"_cold_{k}") for k in keys]) & (marked["_salt"] == cold["_partner"])
    joined = marked.join(cold, on, "left").withColumn("_value", F.coalesce("_hot", "_cold"))
    return joined.select(*[F.col(c) for c in df.columns], *[F.col(f"_value.{n}").alias(n) for n in names])


def hot_keys(
    df: DataFrame,
    keys: list[str],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    fraction: float = 0.1,
) -> DataFrame | None:
    """The hot keys of a sample, at most ``1 / share`` rows; ``None`` if there are none.

    A missed or extra key costs time only: callers treat both kinds exactly.
    """
    counts = df.select(*keys).sample(fraction, seed=11).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("n")).scalar()
    heavy = (F.col("_rows") >= min_rows * fraction) & (F.col("_rows") >= total * F.lit(share))
    found = counts.where(heavy).drop("_rows")
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def split_by(df: DataFrame, keys: list[str], chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is in the small table ``chosen``, and the others."""
    small = F.broadcast(chosen.select(*[F.col(k).alias(f"_hot_{k}") for k in keys]))
    on = null_safe(df, small, [(k, f"_hot_{k}") for k in keys])
    return df.join(small, on, "left_semi"), df.join(small, on, "left_anti")


def number_rows(df: DataFrame, order: list[Column | str], name: str = "row_no") -> DataFrame:
    """Rows numbered from 0 under a total order, without a single-task window.

    The rows are range-partitioned and sorted, then written to the shared folder: row ids
    come from the layout, so the layout must survive the loss of an executor. The partition
    sizes (one number per partition) turn the position inside a partition into a global one.
    """
    columns = total_order(df, order)
    laid = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    laid = cut_lineage(laid.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = laid.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    starts, seen = [], 0
    for row in sizes:
        starts.append((row["_part"], seen))
        seen += row["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    numbered = laid.withColumn("_part", part).join(F.broadcast(offsets), "_part", "left")
    return numbered.withColumn(name, F.col("_start") + place).drop("_at", "_part", "_start")
