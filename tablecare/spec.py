"""Descriptions of target tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    """One target column. ``default`` is a constant used when the column is added to old data."""

    name: str
    dtype: T.DataType
    nullable: bool = True
    max_length: int | None = None
    default: Any = None


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` of this table point at ``parent_columns`` of ``parent``."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    """Columns, keys and defaults of a target table."""

    name: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    derived: dict[str, str] = field(default_factory=dict)
    """Column -> SQL expression that fills it where it is NULL."""

    def column(self, name: str) -> ColumnSpec | None:
        """The column of that name, compared without case."""
        return next((c for c in self.columns if c.name.lower() == name.lower()), None)

    def derived_for(self, present: list[str]) -> dict[str, str]:
        """Fill expressions for the columns in ``present``: they apply only where a value is NULL."""
        return {c: f"coalesce(`{c}`, {e})" for c, e in self.derived.items() if c in present}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    @classmethod
    def of(cls, name: str, schema: T.StructType, key: tuple[str, ...] = (), **kwargs: Any) -> "TableSpec":
        """A spec with the columns of an existing schema."""
        columns = tuple(ColumnSpec(f.name, f.dataType, f.nullable) for f in schema.fields)
        return cls(name, columns, key, **kwargs)
