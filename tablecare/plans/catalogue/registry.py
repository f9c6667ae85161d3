"""Registration of queries and their oracles."""

from __future__ import annotations

from functools import wraps
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tablecare.sources.tables import working_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        @wraps(function)
        def in_utc(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf)

        QUERIES[function.__name__] = in_utc
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def run_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder for what a query writes; it goes when the session's process ends."""
    return working_folder(spark)
