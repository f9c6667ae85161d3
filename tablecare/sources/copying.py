"""Copy of whole datasets with typed conversion, guards, merging and a report."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablecare.operators.coercion import coerce, cut, require_columns
from tablecare.operators.keys import any_null
from tablecare.operators.merging import one_per_key
from tablecare.operators.references import drop_orphans
from tablecare.sources.tables import delete, exists, list_files, list_tables, read_table, read_text, replace_table, staged, table_path, write_table, write_text_once
from tablecare.spec import TableSpec

COUNTS = ("read", "rejected", "refused", "null_keys", "orphaned", "repeated", "stored", "written", "skipped")
REPORT = "table string, status string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", message string"


class CopyFailed(RuntimeError):
    """Some tables failed; ``report`` has a row for each table."""

    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__(f"tables not copied: {', '.join(failed)}")
        self.report = report


def source_mark(spark: SparkSession, path: str) -> str:
    """A digest of the files of a table (name, size, time): the same as long as nobody wrote to it. No data is read."""
    return hashlib.sha256(json.dumps(list_files(spark, path)).encode()).hexdigest()


def _mark(spark: SparkSession, source: str, spec: TableSpec, mode: str, order: list, marks: Mapping[str, str]) -> str:
    """What the copy of a table depends on: its files, its spec, the mode, the order, and the same of its parents."""
    parents = [marks.get(edge.parent, "") for edge in spec.foreign_keys if edge.parent != spec.name]
    depends = [source_mark(spark, table_path(source, spec.name)), repr(spec), mode, [str(o) for o in order], parents]
    return hashlib.sha256(json.dumps(depends).encode()).hexdigest()


def _copy_one(spark: SparkSession, source: str, target: str, spec: TableSpec, mode: str, order: list[Column | str]) -> dict:
    """Copy a table; the source is read and converted once, and all counts come from what was written."""
    try:
        made = coerce(read_table(spark, source, spec.name), spec)
    except ValueError as error:
        return {"status": "skipped", "message": str(error)}
    found: dict = {"status": "copied"}
    with staged(made.marked) as marked:
        made = cut(marked, spec.name)
        rejects_path = f"{target.rstrip('/')}/rejects/{spec.name}"
        made.rejects.write.mode("overwrite").parquet(rejects_path)
        keyless = any_null(list(spec.key)) if spec.key else F.lit(False)
        lost = F.coalesce(F.sum(F.when(F.col("_problems").isNotNull(), F.size("_problems"))), F.lit(0))
        totals = marked.agg(F.count(F.lit(1)).alias("read"), F.count_if("_refused").alias("refused"), F.count_if(~F.col("_refused") & keyless).alias("null_keys"), lost.alias("rejected"))
        found.update(totals.first().asDict())
        rows, left = made.clean.where(~keyless), found["read"] - found["refused"] - found["null_keys"]
        parents = [e for e in spec.foreign_keys if e.parent != spec.name and exists(spark, table_path(target, e.parent))]
        for edge in parents:
            rows = drop_orphans(rows, spark.read.parquet(table_path(target, edge.parent)), list(edge.columns), list(edge.parent_columns))
        if parents:
            kept = rows.count()
            found["orphaned"], left = left - kept, kept
        path = table_path(target, spec.name)
        held = spark.read.parquet(path).count() if mode == "keep" and exists(spark, path) else 0
        if mode == "reload":
            replace_table(one_per_key(rows, list(spec.key), order) if spec.key else rows, path)
        elif spec.key:
            write_table(rows, path, "keep", list(spec.key), order)
        else:
            rows.write.mode("append").parquet(path)
        found["written"] = spark.read.parquet(path).count() - held
        if spec.key:
            different = rows.select(*spec.key).distinct().count() if mode == "keep" else found["written"]
            found["repeated"], found["stored"] = left - different, different - found["written"]
    found["skipped"] = found["read"] - found["written"]
    return found


def copy_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    specs: list[TableSpec],
    mode: str = "reload",
    *,
    order: Mapping[str, list[Column | str]],
    resume: bool = False,
) -> DataFrame:
    """Copy the tables of ``specs``; parents come before their children in the list.

    Required columns are checked for every table before anything is written. A table that fails is
    recorded and the others go on; then ``CopyFailed`` carries the report. ``reload`` replaces the
    targets, ``keep`` adds rows whose key is not stored. ``order`` says for every table with a key which row of a key comes first and
    stays, by target columns; equal rows under it go by all their columns, so an empty list is an order too.

    The report counts rows read, values rejected, and rows refused by a value, without a full key, orphaned, repeated, stored before and
    written. ``target/ledger`` remembers what each copied table was made from; with ``resume`` a table whose source files, spec, mode, order and
    parents are unchanged is not read again and reported as ``unchanged`` with its old counts.
    """
    if mode not in ("reload", "keep"):
        raise ValueError("mode must be 'reload' or 'keep'")
    unordered = [s.name for s in specs if s.key and s.name not in order]
    if unordered:
        raise ValueError(f"an order is needed for {', '.join(unordered)}")
    present = set(list_tables(spark, source))
    chosen = [s for s in specs if s.name in present]
    if not chosen:
        raise ValueError(f"no table of the specs is in {source}")
    for spec in chosen:
        require_columns(read_table(spark, source, spec.name), spec)
    lines, failed, marks = [], [], {}
    for spec in specs:
        if spec.name not in present:
            lines.append({"table": spec.name, "status": "absent", "message": "not in the source"})
            continue
        by, ledger = list(order.get(spec.name, [])), f"{target.rstrip('/')}/ledger/{spec.name}.json"
        mark = marks[spec.name] = _mark(spark, source, spec, mode, by, marks)
        known = json.loads(read_text(spark, ledger)) if exists(spark, ledger) else {}
        if resume and known.get("mark") == mark and exists(spark, table_path(target, spec.name)):
            lines.append({**known["line"], "table": spec.name, "status": "unchanged"})
            continue
        try:
            line = _copy_one(spark, source, target, spec, mode, by)
            delete(spark, ledger)
            if line["status"] == "copied":
                write_text_once(spark, ledger, json.dumps({"mark": mark, "line": line}))
            lines.append({"table": spec.name, **line})
        except Exception as error:  # noqa: BLE001 - one table must not stop the others
            failed.append(spec.name)
            delete(spark, ledger)
            marks[spec.name] = f"failed {uuid.uuid4().hex}"
            lines.append({"table": spec.name, "status": "failed", "message": str(error)})
    rows = [(x["table"], x["status"], *[x.get(c, 0) for c in COUNTS], x.get("message")) for x in lines]
    report = spark.createDataFrame(rows, REPORT)
    if failed:
        raise CopyFailed(report, failed)
    return report
