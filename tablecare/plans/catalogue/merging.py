"""Merges and consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.operators import merging as m
from tablecare.plans.catalogue.registry import query
from tablecare.sources.tables import read_table

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)


@query(
    """
    WITH keep AS (
        SELECT p_partkey, p_type, p_name,
               first_value(p_partkey) OVER (PARTITION BY p_type, p_name ORDER BY p_partkey) AS keep_id
        FROM part)
    SELECT k.keep_id, k.p_type, k.p_name, count(*) AS n_lines,
           CAST(sum(CAST(l.l_extendedprice AS decimal(12,2)) * (1 - CAST(l.l_discount AS decimal(4,2)))) AS double)
               AS revenue
    FROM lineitem l JOIN keep k ON l.l_partkey = k.p_partkey
    GROUP BY k.keep_id, k.p_type, k.p_name
    """
)
def consolidated_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue per surviving part: duplicates are consolidated and their lines follow.

    Lines are summed per part before they meet the parts, so a part with a third of all lines
    costs one row per task.
    """
    parts = m.keep_id(read_table(spark, sf, "part", ["p_partkey", "p_type", "p_name"]), "p_partkey", ["p_type", "p_name"])
    lines = read_table(spark, sf, "lineitem", ["l_partkey", "l_extendedprice", "l_discount"])
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    per_part = lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("amount"))
    joined = per_part.join(parts, per_part["l_partkey"] == parts["p_partkey"])
    return joined.groupBy("keep_id", "p_type", "p_name").agg(
        F.sum("n").alias("n_lines"), F.sum("amount").cast("double").alias("revenue")
    )


def _consolidated(spark: SparkSession, sf: str) -> m.Reused:
    bridge = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
    return m.consolidate(read_table(spark, sf, "part"), bridge, "p_partkey", ["p_type", "p_name"], "l_partkey")


@query(
    """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
    WHERE p_partkey IN (SELECT min(p_partkey) FROM part GROUP BY p_type, p_name)
    """
)
def consolidate_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The surviving row of each (type, name)."""
    return _consolidated(spark, sf).dim


@query(
    """
    SELECT DISTINCT l.l_orderkey, k.keep_id AS l_partkey
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    JOIN (SELECT p_type, p_name, min(p_partkey) AS keep_id FROM part GROUP BY ALL) k
      ON k.p_type = p.p_type AND k.p_name = p.p_name
    """
)
def consolidate_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """(order, part) pairs on the surviving parts, each once."""
    return _consolidated(spark, sf).bridge


@query(
    """
    SELECT p_partkey, first_value(p_partkey) OVER (PARTITION BY p_type, p_name ORDER BY p_partkey) AS keep_id FROM part
    """
)
def keep_id(spark: SparkSession, sf: str) -> DataFrame:
    """Each part with the smallest id of its (type, name)."""
    parts = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_name"])
    return m.keep_id(parts, "p_partkey", ["p_type", "p_name"]).select("p_partkey", "keep_id")


@query(
    f"""
    WITH stored AS (
        SELECT {LINE_COLUMNS} FROM lineitem WHERE l_returnflag = 'R'
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) = 1),
    incoming AS (
        SELECT {LINE_COLUMNS} FROM lineitem WHERE l_returnflag <> 'R'
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) = 1)
    SELECT * FROM stored
    UNION ALL
    SELECT * FROM incoming i WHERE NOT EXISTS (
        SELECT 1 FROM stored s WHERE s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber)
    """
)
def merge_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """Returned lines are stored; the other lines are added where their key is free."""
    lines = read_table(spark, sf, "lineitem")
    stored = m.one_per_key(lines.where("l_returnflag = 'R'"), LINE_KEY, ["l_shipdate"])
    return m.merge_keep_first(stored, lines.where("l_returnflag <> 'R'"), LINE_KEY, ["l_shipdate"])


@query(
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """
)
def merge_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """State per (user, kind): the first half of the month is stored, the second half arrives."""
    events = read_table(spark, sf, "events")
    keys, order = ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()]
    stored = m.one_per_key(events.where("ts < TIMESTAMP_NTZ '2024-01-16'"), keys, order)
    return m.merge_last_wins(stored, events.where("ts >= TIMESTAMP_NTZ '2024-01-16'"), keys, order)


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, 'SEEN'
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """
)
def merge_full_row(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders are written in full; those of status F had vanished and come back."""
    orders = read_table(spark, sf, "orders")
    urgent = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    urgent = urgent.withColumn("o_orderpriority", F.lit("SEEN"))
    return m.merge_full_row(orders.where("o_orderstatus <> 'F'"), urgent, ["o_orderkey"], [])


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderpriority <> '5-LOW'
    """
)
def update_matched(spark: SparkSession, sf: str) -> DataFrame:
    """A patch for status P; patched rows that are not stored (low priority) are not inserted."""
    orders = read_table(spark, sf, "orders")
    patch = orders.where("o_orderstatus = 'P'").select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderpriority")
    )
    return m.update_matched(orders.where("o_orderpriority <> '5-LOW'"), patch, ["o_orderkey"])


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders
    """
)
def update_matched_other_case(spark: SparkSession, sf: str) -> DataFrame:
    """A patch whose column names are in upper case."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    patch = orders.where("o_orderstatus = 'P'").select("o_orderkey", F.lit(None).cast("string").alias("O_ORDERPRIORITY"))
    return m.update_matched(orders, patch, ["o_orderkey"])


REUSE = """
    WITH held AS (SELECT p_brand, p_name, min(p_partkey) AS id FROM part WHERE p_size <= 25 GROUP BY ALL),
    pend AS (SELECT p_brand, p_name, min(p_partkey) AS id FROM part WHERE p_size > 25 GROUP BY ALL),
    remap AS (
        SELECT p.p_partkey AS old_id, coalesce(h.id, f.id) AS new_id
        FROM part p JOIN pend f ON f.p_brand = p.p_brand AND f.p_name = p.p_name
        LEFT JOIN held h ON h.p_brand = p.p_brand AND h.p_name = p.p_name
        WHERE p.p_size > 25)
"""


def _reused(spark: SparkSession, sf: str) -> m.Reused:
    parts = read_table(spark, sf, "part")
    bridge = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey"])
    return m.reuse_values(
        parts.where("p_size > 25"), bridge, parts.where("p_size <= 25"), "p_partkey", ["p_brand", "p_name"], "l_partkey"
    )


@query(
    REUSE
    + """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
    WHERE p_partkey IN (SELECT new_id FROM remap) AND p_size > 25
    """
)
def reuse_values(spark: SparkSession, sf: str) -> DataFrame:
    """Large parts arrive, small ones are stored: the (brand, name) pairs that are really new."""
    return _reused(spark, sf).dim


@query(
    REUSE
    + """
    SELECT DISTINCT l.l_orderkey, coalesce(r.new_id, l.l_partkey) AS l_partkey
    FROM lineitem l LEFT JOIN remap r ON r.old_id = l.l_partkey
    """
)
def reuse_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """The (order, part) pairs after that."""
    return _reused(spark, sf).bridge


@query(REUSE + "SELECT old_id, new_id FROM remap WHERE old_id <> new_id")
def reuse_remap(spark: SparkSession, sf: str) -> DataFrame:
    """The ids that were replaced."""
    return _reused(spark, sf).remap


@query(
    """
    WITH s AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'),
    i AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
    e AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    j AS (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS user_id, event_type, count(*) AS n
          FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL)
    SELECT 'lineitem' AS "table", CAST(sum(i.n) AS bigint) AS read,
           count(*) FILTER (s.l_orderkey IS NULL) AS inserted, CAST(0 AS bigint) AS updated,
           CAST(sum(i.n) - count(*) FILTER (s.l_orderkey IS NULL) AS bigint) AS skipped, CAST(0 AS bigint) AS refused
    FROM i LEFT JOIN s ON s.l_orderkey = i.l_orderkey AND s.l_linenumber = i.l_linenumber
    UNION ALL
    SELECT 'events', CAST(sum(j.n) AS bigint),
           count(*) FILTER (j.user_id IS NOT NULL AND e.user_id IS NULL), count(*) FILTER (e.user_id IS NOT NULL),
           CAST(coalesce(sum(j.n - 1) FILTER (j.user_id IS NOT NULL), 0) AS bigint),
           CAST(coalesce(sum(j.n) FILTER (j.user_id IS NULL), 0) AS bigint)
    FROM j LEFT JOIN e ON e.user_id = j.user_id AND e.event_type = j.event_type
    """
)
def merge_report(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by outcome of both merges; sign-up events lose their user to show refused rows."""
    lines = read_table(spark, sf, "lineitem", [*LINE_KEY, "l_returnflag"])
    stored = lines.where("l_returnflag = 'R'").select(*LINE_KEY).distinct()
    first = m.merge_report(stored, lines.where("l_returnflag <> 'R'"), LINE_KEY, "keep_first", "lineitem")
    events = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    held = events.where("ts < TIMESTAMP_NTZ '2024-01-16'").select("user_id", "event_type").distinct()
    arriving = events.where("ts >= TIMESTAMP_NTZ '2024-01-16'")
    arriving = arriving.withColumn("user_id", F.when(F.col("event_type") != "signup", F.col("user_id")))
    return first.unionByName(m.merge_report(held, arriving, ["user_id", "event_type"], "last_wins", "events"))


@query(
    """
    SELECT o_orderkey AS old_key, o_custkey,
           (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')
               + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS o_orderkey
    FROM orders WHERE o_orderstatus <> 'F'
    """
)
def assign_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders that are not of status F get keys after the largest F key, by date."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])
    incoming = orders.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("old_key"), "o_custkey", "o_orderdate")
    keyed = m.assign_keys(orders.where("o_orderstatus = 'F'"), incoming, "o_orderkey", ["o_orderdate", "old_key"])
    return keyed.select("old_key", "o_custkey", "o_orderkey")
