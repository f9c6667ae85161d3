"""Brings this library to the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Let every executor import the library, once per Spark context; Spark copies the file to them."""
    context = spark.sparkContext
    if getattr(context, "_tablecare_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="tablecare-")) / "tablecare.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted(_ROOT.glob("tablecare/**/*.py")):
            file.write(path, path.relative_to(_ROOT))
    context.addPyFile(str(archive))
    context._tablecare_shipped = True
