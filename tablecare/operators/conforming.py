"""Schema conformance: bring data to a target schema when nothing can be lost by it."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablecare.operators.coercion import validate
from tablecare.sources.tables import exists
from tablecare.spec import TableSpec

MODES = ("heal", "report", "off")


class Operation(NamedTuple):
    """One difference between data and target, and whether it can be applied safely."""

    table: str
    kind: str
    column: str
    safe: bool
    rows: int = 0
    """Rows that stand in the way, where the data was looked at."""


class Conformed(NamedTuple):
    """The data, the differences, and ``in_sync``, ``already_healed``, ``healed``, ``detected``, ``blocked``
    or ``disabled``."""

    df: DataFrame
    operations: list[Operation]
    outcome: str


def differences(schema: T.StructType, spec: TableSpec) -> list[Operation]:
    """What separates ``schema`` from ``spec``.

    Safe: a new column that may be NULL or has a constant default. Not safe: a required column
    without default, a dropped column, another type, another case of a name (a rename).
    """
    held = {f.name: f for f in schema.fields}
    folded = {n.lower(): n for n in held}
    found = []
    for column in spec.columns:
        if column.name in held:
            if held[column.name].dataType != column.dtype:
                found.append(Operation(spec.name, "retype column", column.name, False))
        elif column.name.lower() in folded:
            found.append(Operation(spec.name, "rename column", column.name, False))
        else:
            found.append(Operation(spec.name, "add column", column.name, column.nullable or column.default is not None))
    wanted = {c.name.lower() for c in spec.columns}
    found += [Operation(spec.name, "drop column", n, False) for n in held if n.lower() not in wanted]
    return found


def tightened(df: DataFrame, spec: TableSpec) -> list[Operation]:
    """What the data breaks of rules that types do not show: NULLs in required columns, texts over their length, repeated keys.

    NULLs and lengths take one aggregate over the table, each key a grouped count. A rule that no row breaks is no difference.
    """
    found = [(r["rule"], r["column"], r["rows"]) for r in validate(df, spec).collect() if r["rule"] != "missing column"]
    return [Operation(spec.name, f"tighten: {rule}", column, False, rows) for rule, column, rows in sorted(found)]


def key_differences(old: TableSpec, new: TableSpec) -> list[Operation]:
    """Keys the new spec adds; the data may break them, so they are never safe."""
    found = [Operation(new.name, "add unique key", ",".join(u), False) for u in new.unique if u not in old.unique]
    found += [
        Operation(new.name, "add foreign key", ",".join(f.columns), False)
        for f in new.foreign_keys
        if f not in old.foreign_keys
    ]
    if new.key != old.key:
        found.append(Operation(new.name, "change key", ",".join(new.key), False))
    return found


def add_missing(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of the spec in its order, new ones with their default (a metadata-only projection)."""
    return df.select(
        *[
            F.col(c.name) if c.name in df.columns else F.lit(c.default).cast(c.dtype).alias(c.name)
            for c in spec.columns
        ]
    )


def outcome_of(operations: list[Operation], mode: str) -> str:
    """One unsafe operation blocks the whole plan."""
    if mode == "off":
        return "disabled"
    if not operations:
        return "in_sync"
    if not all(o.safe for o in operations):
        return "blocked"
    return "healed" if mode == "heal" else "detected"


def conform(
    df: DataFrame,
    spec: TableSpec,
    mode: str = "heal",
    extra: list[Operation] = (),
    baseline: TableSpec | None = None,
    probe: bool = False,
) -> Conformed:
    """``df`` in the target schema if every difference is safe, else ``df`` untouched.

    With ``probe`` the data is looked at too (:func:`tightened`). ``extra`` carries differences a schema cannot show, such as ``key_differences``. ``baseline`` is
    the schema the data was first made for: data that has moved on from it to ``spec`` was healed before.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    operations = [] if mode == "off" else [*differences(df.schema, spec), *extra, *(tightened(df, spec) if probe else [])]
    outcome = outcome_of(operations, mode)
    if outcome == "in_sync" and baseline is not None and differences(baseline.schema, spec):
        outcome = "already_healed"
    return Conformed(add_missing(df, spec) if outcome == "healed" else df, operations, outcome)


LEDGER = "table string, kind string, column string, applied_at timestamp"


def applied(spark: SparkSession, ledger: str) -> DataFrame:
    """The operations that have been applied, each once with its first time."""
    if not exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(ledger)
    return rows.groupBy("table", "kind", "column").agg(F.min("applied_at").alias("applied_at"))


def conform_recorded(df: DataFrame, spec: TableSpec, ledger: str, at: datetime, mode: str = "heal", probe: bool = True) -> Conformed:
    """:func:`conform` with a ledger of what has been applied, a small parquet table at ``ledger``.

    Stored data is not rewritten, so its differences show on every read. If the ledger has all of them the outcome is ``already_healed``
    and the data comes in the target schema; if some are new they are recorded and it is ``healed``. A plan that is blocked,
    detected or disabled records nothing. Operations are recorded before the data is used; a record that is written twice counts once.
    """
    made = conform(df, spec, mode, probe=probe)
    if made.outcome != "healed":
        return made
    spark = df.sparkSession
    known = {(r["table"], r["kind"], r["column"]) for r in applied(spark, ledger).where(F.col("table") == spec.name).collect()}
    new = [o for o in made.operations if (o.table, o.kind, o.column) not in known]
    if not new:
        return made._replace(outcome="already_healed")
    rows = [(o.table, o.kind, o.column, at) for o in new]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return made


def conform_tables(
    tables: dict[str, DataFrame], specs: list[TableSpec], mode: str = "heal"
) -> tuple[dict[str, DataFrame], list[Operation], str]:
    """``conform`` over a dataset: absent tables are added empty; one unsafe difference stops them all."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    operations: list[Operation] = []
    if mode != "off":
        for spec in specs:
            if spec.name in tables:
                operations += differences(tables[spec.name].schema, spec)
            else:
                operations.append(Operation(spec.name, "add table", "", True))
    outcome = outcome_of(operations, mode)
    if outcome != "healed":
        return dict(tables), operations, outcome
    spark = next(iter(tables.values())).sparkSession
    healed = dict(tables)
    for spec in specs:
        healed[spec.name] = (
            add_missing(tables[spec.name], spec) if spec.name in tables else spark.createDataFrame([], spec.schema)
        )
    return healed, operations, outcome
