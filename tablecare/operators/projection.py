"""Projections, filters and column repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tablecare.functions import json_text, text, values
from tablecare.spec import TableSpec


def common_columns(df: DataFrame, spec: TableSpec) -> DataFrame | None:
    """The columns both sides have, in source order under the target's names; ``None`` if there are none."""
    pairs = [(name, spec.column(name)) for name in df.columns]
    shared = [F.col(name).alias(target.name) for name, target in pairs if target]
    return df.select(*shared) if shared else None


def contains_any(df: DataFrame, term: str, columns: list[str]) -> DataFrame:
    """Rows where one of ``columns`` holds ``term``, ignoring case."""
    return df.where(text.contains_in_any([F.col(c) for c in columns], F.lit(term)))


def in_list(df: DataFrame, column: str, wanted: str | None) -> DataFrame:
    """Rows whose ``column`` is in a comma list; an empty list filters nothing."""
    parts = text.split_list(wanted)
    return df.where(F.col(column).isin(*parts)) if parts else df


def repair_timestamps(df: DataFrame, columns: list[str], sentinel: str = values.EPOCH) -> DataFrame:
    """Sentinel instants, also inside arrays, become ``sentinel``."""
    repaired = {}
    for name in columns:
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.ArrayType):
            repaired[name] = F.transform(name, lambda x: values.repair_instant(x.cast("timestamp"), sentinel))
        else:
            repaired[name] = values.repair_instant(F.col(name).cast("timestamp"), sentinel)
    return df.withColumns(repaired)


def to_utc(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zone-less timestamps, also inside arrays, read as UTC instants (session zone UTC)."""
    changed = {}
    for name in columns:
        if isinstance(df.schema[name].dataType, T.ArrayType):
            changed[name] = F.col(name).cast("array<timestamp>")
        else:
            changed[name] = F.col(name).cast("timestamp")
    return df.withColumns(changed)


def canonical_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key text columns in canonical UUID form."""
    return df.withColumns({c: values.canonical_uuid(F.col(c)) for c in columns})


def strip_json_keys(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """JSON objects without ``keys``; all other rows stay byte for byte."""
    return df.withColumn(column, json_text.without_keys(F.col(column), keys))


def null_where(df: DataFrame, target: str, condition: Column) -> tuple[DataFrame, DataFrame]:
    """``target`` set to NULL where ``condition`` holds, and the rows this changes.

    Rows that are NULL already are not changed, so a caller can skip the write when there are none.
    """
    hit = F.coalesce(condition, F.lit(False)) & F.col(target).isNotNull()
    return df.withColumn(target, F.when(~hit, F.col(target))), df.where(hit)


def is_blank(column: str) -> Column:
    """NULL or the empty text."""
    return F.col(column).isNull() | (F.col(column) == "")


def fill_derived(df: DataFrame, column: str, expression: Column | str) -> DataFrame:
    """NULLs of ``column`` filled from other columns."""
    value = F.expr(expression) if isinstance(expression, str) else expression
    return df.withColumn(column, F.coalesce(F.col(column), value))


def fill_upper(df: DataFrame, column: str, source: str) -> DataFrame:
    """NULLs of ``column`` filled with ``source`` in upper case (a NULL source counts as empty)."""
    return fill_derived(df, column, F.upper(F.coalesce(F.col(source), F.lit(""))))


def fill_const(df: DataFrame, column: str, value: object) -> DataFrame:
    """NULLs of ``column`` filled with a constant, ahead of a not-null rule."""
    return fill_derived(df, column, F.lit(value))


def reshape(df: DataFrame, drop: list[str] = (), add: dict[str, tuple[str, object]] | None = None) -> DataFrame:
    """Drop columns, then add columns as name -> (type, default); a default of ``None`` is NULL.

    Dropping comes first, so an added column never takes over the values of one it replaces.
    """
    kept = df.drop(*drop)
    clash = [n for n in (add or {}) if n in kept.columns]
    if clash:
        raise ValueError(f"columns exist already: {', '.join(clash)}")
    return kept.withColumns({n: F.lit(value).cast(kind) for n, (kind, value) in (add or {}).items()})


def drop_where(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that stay and rows that go; a NULL condition keeps the row."""
    gone = F.coalesce(condition, F.lit(False))
    return df.where(~gone), df.where(gone)
