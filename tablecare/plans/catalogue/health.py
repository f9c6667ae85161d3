"""Health measures. Thresholds are arguments; some are set low because this data is small."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.operators import coercion, health as h
from tablecare.plans.catalogue.registry import query
from tablecare.plans.reports import finding, health_report as run_report, summarise
from tablecare.sources.tables import read_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
AS_OF = "2024-02-01 00:00:00"


@query(" UNION ALL ".join(f"""SELECT '{n}' AS "table", count(*) AS n_rows FROM {n}""" for n in TABLES))
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every table."""
    return h.row_counts({n: read_table(spark, sf, n) for n in TABLES})


@query("SELECT " + " + ".join(f"(SELECT count(*) FROM {n})" for n in TABLES) + " AS n_rows")
def estimate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of all tables together."""
    return h.estimate_rows({n: read_table(spark, sf, n) for n in TABLES})


@query(
    """
    SELECT 'orders' AS "table", 'o_orderkey' AS "column",
           (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01') AS last_value,
           (SELECT max(o_orderkey) FROM orders) AS max_value
    WHERE last_value < max_value
    """
)
def high_water(spark: SparkSession, sf: str) -> DataFrame:
    """Marks taken from old orders and from all customers: the first trails its table."""
    orders, customers = read_table(spark, sf, "orders"), read_table(spark, sf, "customer")
    old = orders.where("o_orderdate < TIMESTAMP_NTZ '1996-01-01'")
    marks = old.agg(F.max("o_orderkey").alias("last_value")).select(F.lit("orders").alias("table"), "last_value")
    marks = marks.unionByName(
        customers.agg(F.max("c_custkey").alias("last_value")).select(F.lit("customer").alias("table"), "last_value")
    )
    return h.high_water_drift(marks, {"orders": (orders, "o_orderkey"), "customer": (customers, "c_custkey")})


SLOW = """
    SELECT user_id, count(*) AS calls, CAST(sum(CAST(value AS decimal(28,6))) AS double) AS total_ms,
           CAST(sum(CAST(value AS decimal(28,6))) AS double) / count(*) AS mean_ms,
           CASE WHEN CAST(sum(CAST(value AS decimal(28,6))) AS double) / count(*) >= 65 THEN 'warn' ELSE 'ok' END AS severity
    FROM events GROUP BY user_id
    HAVING CAST(sum(CAST(value AS decimal(28,6))) AS double) / count(*) > 55 AND count(*) > 2
    ORDER BY mean_ms DESC, user_id LIMIT 10
"""


@query(SLOW)
def slow_report(spark: SparkSession, sf: str) -> DataFrame:
    """The 10 users with the slowest events."""
    return h.slow_report(read_table(spark, sf, "events"), "user_id", "value", mean_over=55, warn_at=65)


DEAD = """
    SELECT event_type, live, dead, round(CAST(dead AS double) / (live + dead) * 100.0, 1) AS dead_pct FROM (
        SELECT event_type, count(DISTINCT user_id) AS live, count(*) - count(DISTINCT user_id) AS dead
        FROM events GROUP BY event_type)
    WHERE dead > 1000 AND CAST(dead AS double) / (live + dead) >= 0.2
"""


@query(DEAD)
def dead_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Kinds of event where most rows per user are superseded."""
    return h.dead_ratio(read_table(spark, sf, "events"), ["user_id", "event_type"], "event_type")


@query(
    """
    SELECT o_orderpriority, n_rows, changed, dead, changed >= greatest(1000, n_rows // 10) AS needs_refresh,
           dead >= greatest(1000, n_rows // 5) AS needs_compaction
    FROM (SELECT o_orderpriority, count(*) AS n_rows, CAST(count_if(o_orderstatus = 'P') AS bigint) AS changed,
                 CAST(count_if(o_totalprice < 50000) AS bigint) AS dead FROM orders GROUP BY o_orderpriority)
    """
)
def refresh_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Which priorities need a refresh or a compaction, pending and cheap orders standing for changes."""
    stats = read_table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("o_orderstatus") == "P").alias("changed"),
        F.count_if(F.col("o_totalprice") < 50000).alias("dead"),
    )
    return h.refresh_policy(stats)


STALE = f"""
    SELECT user_id, event_type, count(*) AS n_rows, max(ts) AS last_seen FROM events GROUP BY ALL
    HAVING count(*) >= 10 AND max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
"""


@query(STALE)
def stale_groups(spark: SparkSession, sf: str) -> DataFrame:
    """(user, kind) with 10 events or more and none in the last 7 days."""
    return h.stale_groups(read_table(spark, sf, "events"), ["user_id", "event_type"], "ts", AS_OF, min_rows=10)


@query(
    """
    SELECT c_nationkey AS area, count(*) AS total, CAST(count_if(f) AS bigint) AS failed, CAST(count_if(s) AS bigint) AS skipped,
           CAST(count_if(NOT f AND NOT s) AS bigint) AS passed,
           CASE WHEN bool_or(f) THEN 'failed' WHEN bool_and(s) THEN 'skipped' WHEN bool_or(s) THEN 'partial' ELSE 'passed' END AS state
    FROM (SELECT c_nationkey, c_acctbal < -980 AS f, c_acctbal >= -980 AND c_mktsegment = 'FURNITURE' AS s FROM customer)
    GROUP BY c_nationkey
    """
)
def status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation the checks that failed (deep debt), were skipped (a segment) and the state."""
    outcome = F.when(F.col("c_acctbal") < -980, "failed").when(F.col("c_mktsegment") == "FURNITURE", "skipped")
    customers = read_table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("area"), outcome.otherwise("passed").alias("outcome")
    )
    return h.status_rollup(customers, "area", "outcome", "failed", "skipped")


@query(
    """
    SELECT c_nationkey, count(*) AS n_rows, min(id) AS min_id, max(id) AS max_id FROM (
        SELECT c_nationkey, k[1:8] || '-' || k[9:12] || '-' || k[13:16] || '-' || k[17:20] || '-' || k[21:32] AS id
        FROM (SELECT c_nationkey, md5(CAST(c_custkey AS varchar)) AS k FROM customer))
    GROUP BY c_nationkey
    """
)
def uuid_min_max(spark: SparkSession, sf: str) -> DataFrame:
    """Smallest and largest UUID per nation."""
    from tablecare.functions.values import canonical_uuid

    key = canonical_uuid(F.md5(F.col("c_custkey").cast("string").cast("binary")))
    return h.uuid_bounds(read_table(spark, sf, "customer").select("c_nationkey", key.alias("id")), "id", ["c_nationkey"])


def _checks(spark: SparkSession, sf: str) -> dict:
    events = read_table(spark, sf, "events")

    def repeats() -> DataFrame:
        keys = coercion.duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
        total = keys.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        return finding(total, "duplicate_keys", "error", F.lit("lineitem has repeated keys"), F.col("n"))

    def slow() -> DataFrame:
        rows = h.slow_report(events, "user_id", "value", mean_over=55, warn_at=65)
        return finding(rows, "slow", F.col("severity"), F.lit("slow user"), F.col("user_id"))

    def dead() -> DataFrame:
        rows = h.dead_ratio(events, ["user_id", "event_type"], "event_type")
        return finding(rows, "dead_rows", "warn", F.lit("superseded rows"), F.col("event_type"), repairable=True)

    def stale() -> DataFrame:
        rows = h.stale_groups(events, ["user_id", "event_type"], "ts", AS_OF, min_rows=10)
        return finding(rows, "stale", "ok", F.lit("no recent events"), F.format_string("%d/%s", "user_id", "event_type"))

    def drift() -> DataFrame:
        return finding(high_water(spark, sf), "high_water", "error", F.lit("mark trails the data"), F.col("table"), True)

    return {"duplicate_keys": repeats, "slow": slow, "dead_rows": dead, "stale": stale, "high_water": drift}


FINDINGS = f"""
    SELECT 'duplicate_keys' AS "check", 'error' AS severity, 'lineitem has repeated keys' AS message,
           CAST(count(*) AS varchar) AS detail, false AS repairable
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) HAVING count(*) > 0
    UNION ALL SELECT 'slow', severity, 'slow user', CAST(user_id AS varchar), false FROM ({SLOW})
    UNION ALL SELECT 'dead_rows', 'warn', 'superseded rows', event_type, true FROM ({DEAD})
    UNION ALL SELECT 'stale', 'ok', 'no recent events', user_id || '/' || event_type, false FROM ({STALE})
    UNION ALL SELECT 'high_water', 'error', 'mark trails the data', 'orders', true
"""


@query(FINDINGS)
def health_report(spark: SparkSession, sf: str) -> DataFrame:
    """The findings of five checks."""
    return run_report(spark, _checks(spark, sf))


@query(
    f"""
    SELECT count(*) + 1 AS findings, CAST(count_if(severity = 'error') + 1 AS bigint) AS errors,
           CAST(count_if(severity = 'warn') AS bigint) AS warnings, CAST(count_if(severity = 'ok') AS bigint) AS notes,
           'error' AS worst
    FROM ({FINDINGS})
    """
)
def health_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Findings by severity; a check on a column that is not there fails and becomes one error."""

    def broken() -> DataFrame:
        return h.stale_groups(read_table(spark, sf, "orders"), ["o_custkey"], "o_absent", AS_OF)

    return summarise(run_report(spark, {**_checks(spark, sf), "broken": broken}))
