"""A keyed table that a stream writes batch by batch: a versioned base, the batches since, and a manifest.

::

    folder/manifest/00000007.json   {"base": "base-00000007", "folded": 41}
    folder/base-00000007/           the rows of batches 0 to 41, folded
    folder/changes/_batch=42/       the rows of later batches

The newest manifest says what counts. A batch that is repeated overwrites its folder, or is left out if it is folded already, so a replay
changes nothing. Folding writes a new base, then the manifest (a file that is written aside and renamed), then removes what no manifest but
the last two needs; a job that dies in between leaves folders that nobody reads and that the next fold removes. So the number of
folders that a reader opens is bounded by how often the log is folded.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.sources.tables import delete, exists, list_names, read_text, write_text_once

BATCH = "_batch"


@dataclass(frozen=True)
class Version:
    """A manifest: its number, the folder of the base (None before the first fold), and the last batch folded (-1 for none)."""

    number: int = 0
    base: str | None = None
    folded: int = -1


class BatchLog:
    """The log at ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder.rstrip("/")

    def _numbers(self) -> list[int]:
        manifests = f"{self._folder}/manifest"
        names = list_names(self._spark, manifests) if exists(self._spark, manifests) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self) -> Version:
        """The newest manifest."""
        numbers = self._numbers()
        if not numbers:
            return Version()
        found = json.loads(read_text(self._spark, f"{self._folder}/manifest/{numbers[-1]:08d}.json"))
        return Version(numbers[-1], found["base"], found["folded"])

    def batches(self) -> list[int]:
        """The batches that lie in folders of their own and are not folded."""
        changes, folded = f"{self._folder}/changes", self.version().folded
        names = list_names(self._spark, changes, hidden=True) if exists(self._spark, changes) else []
        return sorted(n for n in (int(name.partition("=")[2]) for name in names if name.startswith(f"{BATCH}=")) if n > folded)

    def write(self, rows: DataFrame, number: int) -> None:
        """Store the rows of a batch; one that is folded already is left as it is."""
        if number > self.version().folded:
            rows.drop(BATCH).write.mode("overwrite").parquet(self._change(number))

    def read(self, before: int | None = None) -> DataFrame | None:
        """All rows with the number of their batch as ``_batch``, or those of batches under ``before``; None if nothing is stored."""
        version = self.version()
        parts = [self._spark.read.parquet(f"{self._folder}/{version.base}")] if version.base else []
        parts += [self._spark.read.parquet(self._change(n)).withColumn(BATCH, F.lit(n).cast("long")) for n in self.batches() if before is None or n < before]
        if not parts:
            return None
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows if before is None else rows.where(F.col(BATCH) < before)

    def fold(self, reduce: Callable[[DataFrame], DataFrame], every: int = 1) -> bool:
        """Make one base of all that is stored, cut to ``reduce`` of it, if ``every`` batches or more have come since; whether it did."""
        waiting, version = self.batches(), self.version()
        if not waiting or len(waiting) < every:
            return False
        base = f"base-{version.number + 1:08d}"
        reduce(self.read()).write.mode("overwrite").parquet(f"{self._folder}/{base}")
        write_text_once(self._spark, f"{self._folder}/manifest/{version.number + 1:08d}.json", json.dumps({"base": base, "folded": waiting[-1]}))
        self._clean()
        return True

    def _clean(self) -> None:
        """Remove folded batches, and bases and manifests before the last two: a reader of the last base but one can finish."""
        folded, numbers = self.version().folded, self._numbers()
        for number in numbers[:-2]:
            delete(self._spark, f"{self._folder}/manifest/{number:08d}.json")
        kept = {f"base-{n:08d}" for n in numbers[-2:]}
        for name in list_names(self._spark, self._folder):
            if name.startswith("base-") and name not in kept:
                delete(self._spark, f"{self._folder}/{name}")
        for name in list_names(self._spark, f"{self._folder}/changes", hidden=True):
            if name.startswith(f"{BATCH}=") and int(name.partition("=")[2]) <= folded:
                delete(self._spark, f"{self._folder}/changes/{name}")

    def _change(self, number: int) -> str:
        return f"{self._folder}/changes/{BATCH}={number}"
