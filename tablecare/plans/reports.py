"""Health reports: findings of many checks in one table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Mapping

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablecare.operators.sets import append_all
from tablecare.session import cut_lineage

FINDING = "check string, severity string, message string, detail string, repairable boolean"
AT_ONCE = 4
SEVERITIES = ("ok", "warn", "error")


def finding(
    df: DataFrame, check: str, severity: Column | str, message: Column, detail: Column, repairable: bool = False
) -> DataFrame:
    """Rows of ``df`` as findings."""
    level = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(
        F.lit(check).alias("check"),
        level.alias("severity"),
        message.cast("string").alias("message"),
        detail.cast("string").alias("detail"),
        F.lit(repairable).alias("repairable"),
    )


def health_report(spark: SparkSession, checks: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """The findings of all checks. A check that fails becomes one error row; the rest still report.

    Each check is run to its end here (its findings go to the shared folder), because a failure
    would otherwise only show when the report is read. The checks share the cluster.
    """

    def run(name: str) -> DataFrame:
        try:
            return cut_lineage(checks[name]())
        except Exception as error:  # noqa: BLE001 - the report must survive any check
            row = (name, "error", f"check '{name}' could not run: {error}", type(error).__name__, False)
            return spark.createDataFrame([row], FINDING)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        parts = list(pool.map(inheritable_thread_target(spark)(run), checks))
    return append_all(parts) if parts else spark.createDataFrame([], FINDING)


def severity_rank(column: Column) -> Column:
    """0 for ok, 1 for warn, 2 for error."""
    return F.when(column == "error", 2).when(column == "warn", 1).otherwise(0)


def summarise(findings: DataFrame) -> DataFrame:
    """Findings per severity and the worst one (``ok`` when there are none)."""
    levels = F.array(*[F.lit(s) for s in SEVERITIES])
    worst = F.coalesce(F.max(severity_rank(F.col("severity"))), F.lit(0))
    return findings.agg(
        F.count(F.lit(1)).alias("findings"),
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warn").alias("warnings"),
        F.count_if(F.col("severity") == "ok").alias("notes"),
        F.element_at(levels, worst + 1).alias("worst"),
    )
