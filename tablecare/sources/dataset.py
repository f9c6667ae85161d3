"""A dataset of many tables that changes as a whole.

::

    folder/manifest/00000003.json    {"tables": {"orders": ["data/orders-00000001-…", "data/orders-00000003-…"]}}
    folder/snapshots/nightly_20240201_123000.json
    folder/data/orders-00000003-…/   parquet

The newest manifest names the folders of every table. A write, purge or restore of any number of tables first writes new folders and then one
manifest, under the next number, by a rename that only one writer can win. So readers see all of a change or nothing of it, a
frame that was read before goes on seeing what it saw, and a job that dies leaves only folders that nobody reads; ``clean`` removes them.
A snapshot is a copy of a manifest: it costs no data, and its folders stay until it is dropped.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablecare.operators.health import row_counts
from tablecare.operators.keys import low_half, row_hash
from tablecare.operators.merging import merge_last_wins, new_rows, one_per_key
from tablecare.sources.tables import SNAPSHOT, delete, exists, list_names, read_text, write_text_once


class Conflict(RuntimeError):
    """Another writer has committed since this one looked; nothing of this one's work counts."""


@dataclass(frozen=True)
class Manifest:
    """Which folders each table consists of, under the manifest's number (0 before the first)."""

    number: int
    tables: Mapping[str, list[str]]


class Dataset:
    """The dataset at ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder.rstrip("/")

    def _numbers(self) -> list[int]:
        path = f"{self._folder}/manifest"
        names = list_names(self._spark, path) if exists(self._spark, path) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _load(self, path: str) -> dict[str, list[str]]:
        return json.loads(read_text(self._spark, f"{self._folder}/{path}"))["tables"]

    def head(self) -> Manifest:
        """The newest manifest."""
        numbers = self._numbers()
        return Manifest(numbers[-1], self._load(f"manifest/{numbers[-1]:08d}.json")) if numbers else Manifest(0, {})

    def names(self) -> list[str]:
        """The tables."""
        return sorted(self.head().tables)

    def read(self, name: str, columns: list[str] | None = None, at: Manifest | None = None) -> DataFrame:
        """A table, or the named columns of it, as the newest manifest (or ``at``) has it."""
        found = (at or self.head()).tables.get(name)
        if found is None:
            raise KeyError(name)
        df = self._spark.read.parquet(*[f"{self._folder}/{f}" for f in found])
        return df.select(*columns) if columns else df

    def write(
        self,
        frames: Mapping[str, DataFrame],
        mode: str = "reload",
        keys: Mapping[str, list[str]] | None = None,
        order: Mapping[str, list[Column | str]] | None = None,
    ) -> Manifest:
        """Write several tables, all or none.

        ``reload`` replaces a table, ``keep`` adds the rows whose key is not stored yet (as a further folder, nothing is rewritten),
        ``upsert`` lets incoming rows win, and ``append`` adds all rows. Tables that are not named stay as they are.
        """
        if mode not in ("reload", "keep", "upsert", "append"):
            raise ValueError("mode must be 'reload', 'keep', 'upsert' or 'append'")
        head = self.head()
        tables, made = dict(head.tables), []
        try:
            for name, df in frames.items():
                key, by = (keys or {}).get(name, []), (order or {}).get(name, [])
                stored = self.read(name, at=head) if name in tables and mode != "reload" else None
                rows = df if stored is None else df.select(*stored.columns)
                if mode == "keep":
                    rows = one_per_key(rows, key, by) if stored is None else new_rows(stored, rows, key, by)
                elif mode == "upsert":
                    rows = one_per_key(rows, key, by) if stored is None else merge_last_wins(stored, rows, key, by)
                folder = f"data/{name}-{head.number + 1:08d}-{uuid.uuid4().hex}"
                made.append(folder)
                rows.write.parquet(f"{self._folder}/{folder}")
                added = stored is not None and mode in ("keep", "append")
                tables[name] = [*tables[name], folder] if added else [folder]
            return self._commit(head, tables)
        except Exception:
            for folder in made:
                delete(self._spark, f"{self._folder}/{folder}")
            raise

    def _commit(self, head: Manifest, tables: Mapping[str, list[str]]) -> Manifest:
        number = head.number + 1
        try:
            write_text_once(self._spark, f"{self._folder}/manifest/{number:08d}.json", json.dumps({"tables": dict(tables)}))
        except FileExistsError as error:
            raise Conflict(f"manifest {number} is there already") from error
        return Manifest(number, tables)

    def purge(self, names: list[str]) -> DataFrame:
        """Empty the named tables, all or none, keeping their schemas; returns (table, rows_before)."""
        head = self.head()
        counts = row_counts({n: self.read(n, at=head) for n in names}).collect()
        self.write({n: self.read(n, at=head).limit(0) for n in names})
        return self._spark.createDataFrame([(r["table"], r["n_rows"]) for r in counts], "table string, rows_before bigint")

    def drop(self, names: list[str]) -> Manifest:
        """Take tables out of the dataset."""
        head = self.head()
        return self._commit(head, {n: f for n, f in head.tables.items() if n not in names})

    def snapshot(self, name: str, at: datetime) -> str:
        """Keep the dataset as it is now under ``<name>_<yyyyMMdd_HHmmss>``; a name is given once."""
        taken = f"{name}_{at:%Y%m%d_%H%M%S}"
        write_text_once(self._spark, f"{self._folder}/snapshots/{taken}.json", json.dumps({"tables": dict(self.head().tables)}))
        return taken

    def snapshots(self) -> list[str]:
        """The snapshots, oldest first by their dates."""
        path = f"{self._folder}/snapshots"
        names = list_names(self._spark, path) if exists(self._spark, path) else []
        taken = [n.removesuffix(".json") for n in names if n.endswith(".json")]
        return sorted((n for n in taken if SNAPSHOT.match(n)), key=lambda n: n[-15:])

    def drop_snapshot(self, taken: str) -> None:
        """Forget a snapshot; ``clean`` then removes what only it needed."""
        delete(self._spark, f"{self._folder}/snapshots/{taken}.json")

    def restore(self, taken: str, names: list[str] | None = None) -> Manifest:
        """Bring back all tables of a snapshot, or the named ones, at once; tables it does not have stay. No data is copied."""
        head, saved = self.head(), self._load(f"snapshots/{taken}.json")
        missing = sorted(set(names or []) - set(saved))
        if missing or not saved:
            raise KeyError(", ".join(missing) or taken)
        return self._commit(head, {**head.tables, **{n: f for n, f in saved.items() if names is None or n in names}})

    def compact(self, names: list[str] | None = None, most_folders: int = 1) -> Manifest:
        """Rewrite tables that consist of more than ``most_folders`` folders as one."""
        head = self.head()
        chosen = [n for n in names or head.tables if len(head.tables[n]) > most_folders]
        return self.write({n: self.read(n, at=head) for n in chosen}) if chosen else head

    def clean(self, keep: int = 2) -> list[str]:
        """Remove manifests before the last ``keep``, and folders that neither these nor a snapshot name; returns the folders.

        Folders of writers that are still at work carry a later number than the newest manifest and stay.
        """
        numbers = self._numbers()
        if not numbers:
            return []
        held = [self._load(f"manifest/{n:08d}.json") for n in numbers[-keep:]] + [self._load(f"snapshots/{s}.json") for s in self.snapshots()]
        needed = {folder for tables in held for folders in tables.values() for folder in folders}
        gone = []
        for name in list_names(self._spark, f"{self._folder}/data"):
            if f"data/{name}" not in needed and int(name.rsplit("-", 2)[1]) <= numbers[-1]:
                delete(self._spark, f"{self._folder}/data/{name}")
                gone.append(name)
        for number in numbers[:-keep]:
            delete(self._spark, f"{self._folder}/manifest/{number:08d}.json")
        return gone


def content(df: DataFrame) -> DataFrame:
    """(n_rows, fingerprint) of a table, whatever the order of its rows."""
    hashes = [row_hash(df, df.columns, seed) for seed in (1, 2)]
    marks = [mark.cast("string") for h in hashes for mark in (F.sum(low_half(h)), F.bit_xor(h))]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", *marks).alias("fingerprint"))
