"""What tables hold: column inventory, profiles, sizes."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablecare.sources.tables import exists, list_tables, read_table

COMPLEX = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)
FIXED = (T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _bound(kind, field: T.StructField) -> Column:
    if isinstance(field.dataType, COMPLEX):
        return F.lit(None).cast("string")
    return kind(field.name).cast("string")


def _as_text(field: T.StructField) -> Column:
    """A value as text, different texts for different values."""
    column = F.col(field.name)
    if isinstance(field.dataType, (T.MapType, T.VariantType, T.StructType, T.ArrayType)):
        return F.to_json(F.struct(column))
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are one value
    return column.cast("string")


def _hashable(field: T.StructField) -> Column:
    """A value of a type that can be hashed; equal values stay equal."""
    column = F.col(field.name)
    return F.to_json(F.struct(column)) if isinstance(field.dataType, (T.MapType, T.VariantType, T.StructType, T.ArrayType)) else column


def _value_key(field: T.StructField) -> list[Column]:
    """What names a value in a distinct count: a value of fixed width is its own name, others have 128 bits of hash."""
    if isinstance(field.dataType, FIXED):
        return [F.col(field.name).alias("a")]
    return [F.xxhash64(F.lit(seed), _hashable(field)).alias(h) for seed, h in ((1, "a"), (2, "b"))]


def _distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct values per column position, each column by a scan of its own.

    A task holds the values of one column of its split, not of all columns, and a cell costs 16 bytes of shuffle at most, however
    long it is; equal ones of a task are one before that.
    """
    counts = []
    for i, field in enumerate(df.schema.fields):
        values = df.where(F.col(field.name).isNotNull()).select(*_value_key(field)).distinct()
        counts.append(values.agg(F.count(F.lit(1)).alias("distinct_values")).select(F.lit(i + 1).alias("position"), "distinct_values"))
    return reduce(DataFrame.unionAll, counts)


def column_profile(df: DataFrame, table: str, distinct: str = "exact") -> DataFrame:
    """One row per column: type, position, nullability, NULLs, distinct values, bounds, longest text.

    One aggregation serves all columns. Exact distinct counts take one more per column, over its values or their hashes;
    ``distinct='approx'`` stays with the first.
    """
    if distinct not in ("exact", "approx"):
        raise ValueError("distinct must be 'exact' or 'approx'")
    aggregates, lines = [], []
    for i, field in enumerate(df.schema.fields):
        column = F.col(field.name)
        longest = F.max(F.char_length(column)) if isinstance(field.dataType, T.StringType) else F.lit(None)
        aggregates += [
            F.count_if(column.isNull()).alias(f"_nulls_{i}"),
            _bound(F.min, field).alias(f"_min_{i}"),
            _bound(F.max, field).alias(f"_max_{i}"),
            longest.cast("int").alias(f"_longest_{i}"),
        ]
        if distinct == "approx":
            aggregates.append(F.approx_count_distinct(_as_text(field)).alias(f"_distinct_{i}"))
        lines.append(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.lit(field.nullable).alias("nullable"),
                F.col(f"_nulls_{i}").alias("nulls"),
                F.col(f"_min_{i}").alias("min_value"),
                F.col(f"_max_{i}").alias("max_value"),
                F.col(f"_longest_{i}").alias("longest"),
                (F.col(f"_distinct_{i}") if distinct == "approx" else F.lit(None).cast("bigint")).alias("distinct_values"),
            )
        )
    profiled = df.agg(*aggregates).select(F.inline(F.array(*lines)))
    if distinct == "exact":
        joined = profiled.drop("distinct_values").join(_distinct_counts(df), "position", "left")
        profiled = joined.withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0).cast("bigint")))
    order = "table position column type nullable nulls distinct_values min_value max_value longest".split()
    return profiled.select(*order)


BOUND = "struct<first:decimal(38,18),second:double,third:string,shown:string>"

SKETCH_BITS = 14
"""Logarithm of the counters of a sketch: 16 384 of them are off by about 0.8 %, at 12 to 16 KB a sketch."""


def _order(column: Column, kind: T.DataType) -> list[Column]:
    """What puts the values of a column in order, as parts of one type for all columns: exact number, floating number, text."""
    exact, number, text = F.lit(None).cast("decimal(38,18)"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, T.BooleanType):
        exact = column.cast("int").cast("decimal(38,18)")
    elif isinstance(kind, T.DecimalType):
        exact, number = column.try_cast("decimal(38,18)"), column.cast("double")
    elif isinstance(kind, T.IntegralType):
        exact = column.cast("decimal(38,18)")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        number = column.cast("double")
    elif isinstance(kind, T.TimestampType):
        exact = F.unix_micros(column).cast("decimal(38,18)")
    elif isinstance(kind, T.TimestampNTZType):
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:
        text = column.cast("string")
    return [number, exact, text] if isinstance(kind, T.DecimalType) else [exact, number, text]


def _extreme(field: T.StructField, smallest: bool) -> Column:
    """The smallest or largest value of a column, in its own type where that orders values as :func:`_order` does."""
    column, pick = F.col(field.name), F.min if smallest else F.max
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        # -0.0 and 0.0 are equal, so a flag puts -0.0 first.
        plus = F.when(column == 0, column.cast("string") != "-0.0").otherwise(F.lit(True))
        return pick(F.when(column.isNotNull(), F.struct(column.alias("value"), plus.alias("plus")))).getField("value")
    native = isinstance(field.dataType, (T.BooleanType, T.IntegralType, T.TimestampType, T.TimestampNTZType))
    if native or isinstance(field.dataType, T.StringType):
        return pick(column if native else column.cast("string"))
    ordered = [o.alias(n) for o, n in zip(_order(column, field.dataType), ("first", "second", "third"))]
    return pick(F.when(column.isNotNull(), F.struct(*ordered, column.cast("string").alias("shown"), column.alias("value")))).getField("value")


def _bound_of(value: Column, kind: T.DataType) -> Column:
    """A value as a bound that compares with those of other parts."""
    parts = [o.alias(n) for o, n in zip(_order(value, kind), ("first", "second", "third"))]
    return F.when(value.isNotNull(), F.struct(*parts, value.cast("string").alias("shown"))).cast(BOUND)


def profile_parts(df: DataFrame, table: str, part: Column | None = None) -> DataFrame:
    """One row per part and column that :func:`merged_profile` can add up: counts, bounds, longest text, and a sketch of the values.

    ``part`` names the part of each row, such as a day or a file; without it the table is one part. A sketch has a fixed size, whatever
    the number of values.
    """
    aggregates, lines = [F.count(F.lit(1)).alias("_rows")], []
    for i, field in enumerate(df.schema.fields):
        column, plain = F.col(field.name), not isinstance(field.dataType, COMPLEX)
        low, high = [_extreme(field, smallest) if plain else F.lit(None) for smallest in (True, False)]
        longest = F.max(F.char_length(column)) if isinstance(field.dataType, T.StringType) else F.lit(None)
        aggregates += [F.count(column).alias(f"_known_{i}"), low.alias(f"_low_{i}"), high.alias(f"_high_{i}"), longest.cast("int").alias(f"_longest_{i}")]
        aggregates.append(F.hll_sketch_agg(_as_text(field), F.lit(SKETCH_BITS)).alias(f"_sketch_{i}"))
        about = [F.lit(v).alias(n) for n, v in (("table", table), ("position", i + 1), ("column", field.name), ("type", field.dataType.simpleString()), ("nullable", field.nullable))]
        bounds = [(_bound_of(F.col(f"_{n}_{i}"), field.dataType) if plain else F.lit(None).cast(BOUND)).alias(n) for n in ("low", "high")]
        lines.append(F.struct("part", *about, F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_known_{i}")).alias("nulls"), *bounds, *[F.col(f"_{n}_{i}").alias(n) for n in ("longest", "sketch")]))
    name = (F.lit("") if part is None else part.cast("string")).alias("part")
    return df.groupBy(name).agg(*aggregates).select(F.inline(F.array(*lines)))


def merged_profile(parts: DataFrame) -> DataFrame:
    """The profile of all ``parts`` of :func:`profile_parts` together, as :func:`column_profile` with estimated distinct counts.

    Only the parts are read, not the data.
    """
    merged = parts.groupBy("table", "position", "column", "type").agg(
        F.max("nullable").alias("nullable"), F.sum("nulls").alias("nulls"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
        F.min("low").getField("shown").alias("min_value"), F.max("high").getField("shown").alias("max_value"), F.max("longest").alias("longest"),
    )
    return merged.select(*"table position column type nullable nulls distinct_values min_value max_value longest".split())


def refresh_profile(spark: SparkSession, data: str, table: str, parts: str) -> DataFrame:
    """The merged profile of the files at ``data``, with the parts of files that are new since the last call appended at ``parts``.

    A file is a part. Files that are known by path, size and time are not read again (the driver gets the paths of new ones, as it
    does for any scan); parts of files that are gone or were rewritten stay in the store but do not count.
    """
    df = spark.read.parquet(data)
    stamp = F.concat_ws("|", F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.unix_micros(F.col("_metadata.file_modification_time")))
    now = df.select(stamp.alias("part")).distinct()
    if exists(spark, parts):
        old = spark.read.parquet(parts).select("part").distinct()
        new = [unquote(r["part"].rpartition("|")[0].rpartition("|")[0]) for r in now.join(old, "part", "left_anti").collect()]
        unread = spark.read.schema(df.schema).parquet(*new) if new else None
    else:
        unread = df
    if unread is not None:
        profile_parts(unread, table, stamp).write.mode("append").parquet(parts)
    return merged_profile(spark.read.parquet(parts).join(F.broadcast(now), "part", "left_semi"))


def inventory(spark: SparkSession, folder: str, names: list[str] | None = None, distinct: str = "exact") -> DataFrame:
    """``column_profile`` of every table in a folder."""
    chosen = names or list_tables(spark, folder)
    return reduce(
        DataFrame.unionByName, [column_profile(read_table(spark, folder, n), n, distinct) for n in chosen]
    )


def profile(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """Rows and bytes of every table, largest first. Files are grouped before they are summed."""
    parts = []
    for name in names or list_tables(spark, folder):
        df = read_table(spark, folder, name)
        files = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size")
        )
        totals = files.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
        )
        parts.append(totals.select(F.lit(name).alias("table"), "n_rows", "bytes"))
    return reduce(DataFrame.unionByName, parts).orderBy(F.col("bytes").desc(), "table")


