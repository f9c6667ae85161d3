"""Canonical export: every column in a form any reader understands."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablecare.functions.values import portable

FORMATS = ("parquet", "json", "csv")


def canonical_export(df: DataFrame, key_columns: list[str] = (), uuid_columns: list[str] = ()) -> DataFrame:
    """Booleans as 0/1, instants as ISO text, arrays as JSON text, NaN and infinities as NULL.

    UUID texts are upper-cased, but text in ``key_columns`` stays as it is: two keys may differ
    only in case. ``uuid_columns`` are true UUIDs and always upper-cased.
    """
    keys = {k.lower() for k in key_columns}
    ids = {c.lower() for c in uuid_columns}
    return df.select(
        *[
            (
                F.upper(f.name)
                if f.name.lower() in ids
                else portable(F.col(f.name), f.dataType, f.name.lower() in keys)
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )


def export_table(
    df: DataFrame, path: str, fmt: str = "parquet", key_columns: list[str] = (), uuid_columns: list[str] = ()
) -> None:
    """Write the canonical form as parquet, JSON lines or CSV with a header.

    Nothing is trimmed or left out: JSON shows every NULL field, and CSV writes a NULL as ``\\N`` (read it with
    ``nullValue``), so it differs from an empty text.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {', '.join(FORMATS)}")
    writer = canonical_export(df, key_columns, uuid_columns).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue="\\N")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)
