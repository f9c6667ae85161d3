"""Tables as parquet folders: scans, staged writes, purges, snapshots."""

from __future__ import annotations

import re
import time
import uuid
from contextlib import contextmanager
from datetime import datetime
from typing import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablecare.operators.health import row_counts
from tablecare.operators.merging import merge_last_wins, new_rows, one_per_key
from tablecare.session import shared_dir

SUFFIX = ".parquet"

# Fixed value: a snapshot folder is <name>_<yyyyMMdd>_<HHmmss>.
SNAPSHOT = re.compile(r"^.+_\d{8}_\d{6}$")


def _filesystem(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored at ``path``."""
    system, target = _filesystem(spark, path)
    return system.exists(target)


def list_names(spark: SparkSession, folder: str, hidden: bool = False) -> list[str]:
    """Names in a folder, sorted; hidden ones are left out unless asked for."""
    system, target = _filesystem(spark, folder)
    names = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(n for n in names if hidden or not n.startswith((".", "_")))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    system, target = _filesystem(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, target = _filesystem(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet: aside, then renamed, so it is never seen in part.

    Of two writers one gets an error.
    """
    system, target = _filesystem(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{uuid.uuid4().hex}")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(target) or not system.rename(aside, target):
        system.delete(aside, False)
        raise FileExistsError(path)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time in ms) of the data files at ``path`` and below, sorted."""
    system, target = _filesystem(spark, path)
    files, found = system.listFiles(target, True), []
    while files.hasNext():
        status = files.next()
        name = status.getPath().getName()
        if not name.startswith((".", "_")):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def list_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables in a folder."""
    return [n[: -len(SUFFIX)] for n in list_names(spark, folder) if n.endswith(SUFFIX)]


def table_path(folder: str, name: str) -> str:
    """Where a table lives."""
    return f"{folder.rstrip('/')}/{name}{SUFFIX}"


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A table, or only the named columns of it (the scan reads no others)."""
    df = spark.read.parquet(table_path(folder, name))
    return df.select(*columns) if columns else df


def replace_table(df: DataFrame, path: str) -> None:
    """Write next to ``path``, then swap. ``df`` may read from ``path``.

    The old table stays until the new one is complete; each task's files are committed by Spark. What an earlier job that
    died has left beside ``path`` is set right first (:func:`recover`).
    """
    spark = df.sparkSession
    recover(spark, path)
    mark = uuid.uuid4().hex
    staged, retired = f"{path}.new-{mark}", f"{path}.old-{mark}"
    df.write.mode("errorifexists").parquet(staged)
    system, target = _filesystem(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    had = system.exists(target)
    if had and not system.rename(target, path_of(retired)):
        raise OSError(f"cannot set {path} aside")
    if not system.rename(path_of(staged), target):
        if had:
            system.rename(path_of(retired), target)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        system.delete(path_of(retired), True)
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo swaps at ``path`` that a job died in.

    A table that was set aside and not replaced comes back. One that was replaced loses its old copy. New
    copies that were never swapped in stay for an hour, as their job may be at work, and are removed then.
    """
    system, target = _filesystem(spark, path)
    beside = target.getParent()
    if beside is None or not system.exists(beside):
        return
    name = target.getName()
    for status in system.listStatus(beside):
        found = status.getPath().getName()
        if found.startswith(f"{name}.old-"):
            if system.exists(target) or not system.rename(status.getPath(), target):
                system.delete(status.getPath(), True)
        elif found.startswith(f"{name}.new-") and time.time() * 1000 - status.getModificationTime() > ABANDONED_MS:
            system.delete(status.getPath(), True)


ABANDONED_MS = 3_600_000


def working_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder; it is removed when the session's process ends, if not before."""
    path = f"{shared_dir(spark).rstrip('/')}/tablecare-{uuid.uuid4().hex}"
    system, target = _filesystem(spark, path)
    system.mkdirs(target)
    system.deleteOnExit(target)
    return path


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back: later plans know its size, and it is made once. The copy goes with the block."""
    path = working_folder(df.sparkSession)
    try:
        df.write.parquet(f"{path}/rows")
        yield df.sparkSession.read.parquet(f"{path}/rows")
    finally:
        delete(df.sparkSession, path)


def write_table(
    df: DataFrame, path: str, mode: str = "reload", keys: list[str] = (), order: list[Column | str] = ()
) -> None:
    """``reload`` replaces the table, ``keep`` adds the rows whose key is not stored yet, ``upsert``
    lets incoming rows win (``order`` sorts them newest first).

    ``keep`` appends new files only: stored data is read (key columns) but never rewritten. The
    incoming rows are staged, one per key, so their size decides how they meet the stored ones.
    """
    spark = df.sparkSession
    recover(spark, path)
    if mode in ("keep", "upsert") and exists(spark, path):
        stored = spark.read.parquet(path)
        with staged(one_per_key(df.select(*stored.columns), list(keys), list(order))) as latest:
            if mode == "upsert":
                replace_table(merge_last_wins(stored, latest, list(keys), list(order)), path)
            else:
                new_rows(stored, latest, list(keys), list(order)).write.mode("append").parquet(path)
                spark.catalog.refreshByPath(path)
    elif mode in ("keep", "upsert"):
        replace_table(one_per_key(df, list(keys), list(order)), path)
    elif mode == "reload":
        replace_table(df, path)
    else:
        raise ValueError("mode must be 'reload', 'keep' or 'upsert'")


def purge(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Empty the named tables, keeping their schemas; returns (table, rows_before)."""
    counts = row_counts({n: read_table(spark, folder, n) for n in names}).collect()
    for name in names:
        replace_table(read_table(spark, folder, name).limit(0), table_path(folder, name))
    rows = [(r["table"], r["n_rows"]) for r in counts]
    return spark.createDataFrame(rows, "table string, rows_before bigint")


def snapshot(spark: SparkSession, folder: str, root: str, name: str, at: datetime) -> str:
    """Copy all tables to ``root/<name>_<yyyyMMdd_HHmmss>``; returns that folder.

    The tables go to a hidden folder first, so a dated folder is always complete.
    """
    target = f"{root.rstrip('/')}/{name}_{at:%Y%m%d_%H%M%S}"
    if exists(spark, target):
        raise FileExistsError(target)
    working = f"{root.rstrip('/')}/.{uuid.uuid4().hex}"
    for table in list_tables(spark, folder):
        read_table(spark, folder, table).write.parquet(table_path(working, table))
    system, path = _filesystem(spark, working)
    if not system.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {working} to {target}")
    return target


def list_snapshots(spark: SparkSession, root: str) -> list[str]:
    """Snapshot folders in ``root``, oldest first by their dates."""
    return sorted((n for n in list_names(spark, root) if SNAPSHOT.match(n)), key=lambda n: n[-15:])


def restore(spark: SparkSession, taken: str, folder: str) -> list[str]:
    """Replace the tables in ``folder`` by those of a snapshot; other tables stay."""
    names = list_tables(spark, taken)
    if not names:
        raise FileNotFoundError(f"no tables in {taken}")
    for name in names:
        replace_table(read_table(spark, taken, name), table_path(folder, name))
    return names
