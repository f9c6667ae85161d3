"""Text expressions: literal matching, lists, sizes, previews."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def contains_text(column: Column, term: Column) -> Column:
    """Whether ``column`` holds ``term``, ignoring case. ``%``, ``_`` and ``\\`` are plain characters.

    A literal substring test needs no pattern and so no escaping.
    """
    return F.contains(F.lower(column), F.lower(term))


def contains_in_any(columns: list[Column], term: Column) -> Column:
    """Whether any of ``columns`` holds ``term``; NULL columns count as no."""
    found = F.lit(False)
    for column in columns:
        found = found | F.coalesce(contains_text(column, term), F.lit(False))
    return found


def split_list(text: str | None) -> list[str]:
    """``'a, b,,c'`` -> ``['a', 'b', 'c']``: blanks are dropped."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def byte_size(column: Column) -> Column:
    """A byte count as text, in steps of 1024 with one decimal."""
    size = column.cast("double")
    kib, mib, gib = 1024.0, 1024.0**2, 1024.0**3
    return (
        F.when(column >= gib, F.format_string("%.1f GB", size / gib))
        .when(column >= mib, F.format_string("%.1f MB", size / mib))
        .when(column >= kib, F.format_string("%.1f KB", size / kib))
        .otherwise(F.format_string("%d B", column.cast("bigint")))
    )


def preview_text(column: Column, length: int = 120) -> Column:
    """The first ``length`` characters, with an ellipsis where something was cut."""
    cut = F.concat(F.substring(column, 1, length), F.lit("…"))
    return F.when(F.char_length(column) > length, cut).otherwise(column)


def console_text(column: Column, dtype: T.DataType) -> Column:
    """A value as the read-only console shows it."""
    if isinstance(dtype, T.BinaryType):
        return F.when(column.isNotNull(), F.format_string("byte[%d]", F.octet_length(column)))
    if isinstance(dtype, T.ArrayType):
        return F.when(column.isNotNull(), F.format_string("[%d items]", F.size(column)))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
    if isinstance(dtype, (T.StructType, T.MapType, T.VariantType)):
        return F.to_json(column)
    return column.cast("string")


def fingerprint(*columns: Column) -> Column:
    """SHA-256 of the values; NULL and the empty text differ."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)
