"""Repair of what the health checks find: dead rows and key marks that trail the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablecare.operators.health import dead_ratio, high_water_drift
from tablecare.operators.keys import any_null
from tablecare.operators.merging import one_per_key
from tablecare.sources.tables import read_table, replace_table, table_path

RESULT = "action string, target string, ok boolean, detail string"


def compact(log: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The newest row of each key; ``order`` sorts newest first. Rows without a full key have no newer version and stay."""
    return one_per_key(log, keys, order).unionByName(log.where(any_null(keys)))


def repair(
    spark: SparkSession,
    folder: str,
    logs: dict[str, tuple[list[str], list[Column | str]]],
    marks: str,
    marked: dict[str, str],
    dead_over: int = 1000,
    ratio: float = 0.20,
) -> DataFrame:
    """Detect again, then compact logs and move marks; one result row per action.

    ``logs`` maps a table to its keys and newest-first order; ``marks`` names the table of
    (table, last_value); ``marked`` maps a table to its key column. A failed action is recorded.
    """
    results = []
    for name, (keys, order) in logs.items():
        try:
            log = read_table(spark, folder, name)
            whole = log.withColumn("_table", F.lit(name))
            found = dead_ratio(whole, keys, "_table", dead_over, ratio).first()
            if found:
                before = log.count()
                replace_table(compact(log, keys, order), table_path(folder, name))
                removed = before - read_table(spark, folder, name).count()
                results.append(("compact", name, True, f"{removed} rows removed"))
        except Exception as error:  # noqa: BLE001 - one repair must not stop the others
            results.append(("compact", name, False, str(error)))
    try:
        held = read_table(spark, folder, marks)
        tables = {n: (read_table(spark, folder, n, [k]), k) for n, k in marked.items()}
        behind = high_water_drift(held, tables).collect() if tables else []
        if behind:
            moved = spark.createDataFrame([(r["table"], r["max_value"]) for r in behind], "table string, _top bigint")
            fixed = held.join(F.broadcast(moved), "table", "left")
            fixed = fixed.withColumn("last_value", F.coalesce("_top", "last_value")).select(*held.columns)
            replace_table(fixed, table_path(folder, marks))
        results += [("move mark", r["table"], True, f"{r['last_value']} -> {r['max_value']}") for r in behind]
    except Exception as error:  # noqa: BLE001
        results.append(("move mark", marks, False, str(error)))
    return spark.createDataFrame(results, RESULT)
