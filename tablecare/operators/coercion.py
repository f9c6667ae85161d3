"""Typed conversion with a record of every value and row that did not fit."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tablecare.functions import values
from tablecare.operators.keys import any_null
from tablecare.operators.projection import common_columns
from tablecare.session import dealt_out
from tablecare.spec import ColumnSpec, TableSpec

NARROW = (T.ByteType, T.ShortType, T.IntegerType)

BAD_VALUE = "bad value"
OUT_OF_RANGE = "out of range"
MISSING = "missing value"

class Coerced(NamedTuple):
    """``clean`` rows and one ``rejects`` row per value that was lost or that refused its row; both are cuts of ``marked``.

    ``marked`` has every source row once: its converted columns, ``_refused`` (whether the row is not clean), ``_key`` (the identity
    of the row as JSON) and ``_problems`` (column, raw, reason of each value that was lost; NULL if none). A job that needs both cuts
    writes ``marked`` once and reads it back through :func:`cut`.
    """

    clean: DataFrame
    rejects: DataFrame
    marked: DataFrame


def _narrowed(source: T.DataType, column: ColumnSpec) -> bool:
    """Whether a whole number may be too wide for the column."""
    return isinstance(column.dtype, NARROW) and source != column.dtype


def coerce(df: DataFrame, spec: TableSpec, carry: list[str] | None = None) -> Coerced:
    """Convert ``df`` to the types of ``spec``.

    A value that cannot be read becomes NULL and is reported. A number too wide for its column
    or a NULL in a required column refuses the whole row. ``carry`` names the source columns
    that identify a row in ``rejects`` (the key of the spec by default). Every value is converted once.
    """
    shared = common_columns(df, spec)
    if shared is None:
        raise ValueError(f"{spec.name}: no common column")
    shared = shared.withColumns({c: F.expr(e) for c, e in spec.derived_for(shared.columns).items()})
    columns = [(spec.column(f.name), f) for f in shared.schema.fields]

    def converted(column: ColumnSpec, source: T.StructField) -> Column:
        target = T.LongType() if _narrowed(source.dataType, column) else column.dtype
        return values.convert(F.col(source.name), source.dataType, target, column.max_length)

    # Rows pass through a generator: a filter on what it makes cannot move below it, where it would convert again.
    made = [F.struct(F.col(f.name).alias("raw"), converted(c, f).alias("read")).alias(f"_{i}") for i, (c, f) in enumerate(columns)]
    once = dealt_out(shared).select(F.inline(F.array(F.struct(*made))))

    refusals, problems, final = [], [], []
    for i, (column, source) in enumerate(columns):
        raw, read = F.col(f"_{i}.raw"), F.col(f"_{i}.read")
        value = read.try_cast(column.dtype) if _narrowed(source.dataType, column) else read
        final.append(value.alias(column.name))
        tests = []
        if _narrowed(source.dataType, column):
            tests.append((read.isNotNull() & value.isNull(), OUT_OF_RANGE))
        if not column.nullable:
            tests.append((value.isNull(), MISSING))
        refusals += [test for test, _ in tests]
        if source.dataType != column.dtype and not isinstance(column.dtype, T.StringType):
            tests.append((raw.isNotNull() & read.isNull(), BAD_VALUE))
        if tests:
            reason = F.coalesce(*[F.when(test, F.lit(label)) for test, label in tests])
            problem = F.struct(F.lit(column.name).alias("column"), raw.cast("string").alias("raw"), reason.alias("reason"))
            problems.append((reduce(Column.__or__, [test for test, _ in tests]), problem))

    position = {f.name: i for i, (_, f) in enumerate(columns)}
    identity = carry if carry is not None else [k for k in spec.key if k in shared.columns]
    key = F.to_json(F.struct(*[F.col(f"_{position[k]}.raw").cast("string").alias(k) for k in identity])) if identity else F.lit(None).cast("string")
    lost = reduce(Column.__or__, [test for test, _ in problems]) if problems else F.lit(False)
    listed = F.filter(F.array(*[p for _, p in problems]), lambda p: p["reason"].isNotNull()) if problems else F.lit(None).cast(PROBLEMS)
    marked = once.select(
        *final,
        (reduce(Column.__or__, refusals) if refusals else F.lit(False)).alias("_refused"),
        F.when(lost, key).alias("_key"),
        F.when(lost, listed).alias("_problems"),
    )
    return cut(marked, spec.name)


PROBLEMS = "array<struct<column:string,raw:string,reason:string>>"


def cut(marked: DataFrame, table: str) -> Coerced:
    """The two cuts of ``marked`` rows."""
    clean = marked.where(~F.col("_refused")).drop("_refused", "_key", "_problems")
    lost = marked.where(F.col("_problems").isNotNull()).select(F.lit(table).alias("table"), F.col("_key").alias("row_key"), F.inline("_problems"))
    return Coerced(clean, lost.select("table", "row_key", "column", "raw", "reason"), marked)


def validate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Broken rules as rows (table, rule, column, rows): absent column, NULL, length, duplicate key.

    NULL and length rules take one pass; each key takes one grouped count.
    """
    spark = df.sparkSession
    present = {n.lower(): n for n in df.columns}
    required = [c for c in spec.columns if not c.nullable]
    absent = [c.name for c in required if c.name.lower() not in present and c.default is None]
    schema = "table string, rule string, column string, rows bigint"
    parts = []
    if absent:
        parts.append(spark.createDataFrame([(spec.name, "missing column", a, None) for a in absent], schema))

    checks = [("null value", c.name, F.col(present[c.name.lower()]).isNull()) for c in required
              if c.name.lower() in present]
    checks += [
        ("too long", c.name, F.char_length(F.col(present[c.name.lower()])) > c.max_length)
        for c in spec.columns
        if c.max_length and c.name.lower() in present
    ]
    if checks:
        counted = df.agg(*[F.count_if(test).alias(f"_{i}") for i, (_, _, test) in enumerate(checks)])
        lines = [
            F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("column"), F.col(f"_{i}").alias("rows"))
            for i, (rule, name, _) in enumerate(checks)
        ]
        parts.append(
            counted.select(F.explode(F.array(*lines)).alias("c"))
            .select(F.lit(spec.name).alias("table"), "c.*")
            .where(F.col("rows") > 0)
        )
    for key in filter(None, (spec.key, *spec.unique)):
        names = [present[k.lower()] for k in key if k.lower() in present]
        if len(names) == len(key):
            repeated = duplicate_keys(df, names).agg(F.sum(F.col("n") - 1).alias("rows"))
            parts.append(
                repeated.where(F.col("rows") > 0).select(
                    F.lit(spec.name).alias("table"),
                    F.lit("duplicate key").alias("rule"),
                    F.lit(",".join(key)).alias("column"),
                    "rows",
                )
            )
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def require_columns(df: DataFrame, spec: TableSpec) -> None:
    """Raise before any write when a required column is absent."""
    present = {n.lower() for n in df.columns}
    absent = [c.name for c in spec.columns if not c.nullable and c.default is None and c.name.lower() not in present]
    if absent:
        raise ValueError(f"{spec.name}: required columns are missing: {', '.join(absent)}")


def require_valid(df: DataFrame, spec: TableSpec) -> None:
    """Raise when any rule of ``validate`` is broken (at most a line per rule reaches the driver)."""
    broken = validate(df, spec).collect()
    if broken:
        lines = "; ".join(f"{r['rule']} {r['column']} ({r['rows']})" for r in broken)
        raise ValueError(f"{spec.name}: {lines}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row. A key with a NULL part never counts as a repeat."""
    return df.where(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
