"""Lists per group, tops, pages, samples and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.functions.text import console_text
from tablecare.operators import paging, ranking as r, sets
from tablecare.plans.catalogue.registry import query
from tablecare.sources.tables import read_table


@query(
    """
    WITH old AS (
        SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events)
    SELECT event_id, user_id FROM old WHERE n > 5 AND ts < TIMESTAMP '2024-02-01' - INTERVAL 10 DAY
    """
)
def retention_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Events older than 10 days, except the newest 5 of each user."""
    events = read_table(spark, sf, "events", ["event_id", "user_id", "ts"])
    return r.retention_plan(events, ["user_id"], "ts", "event_id", 10, 5, "2024-02-01 00:00:00").select("event_id", "user_id")


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 3
    """
)
def latest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 3 orders of each customer that are not pending."""
    orders = read_table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    orders = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return r.latest_per_group(orders, ["o_custkey"], "o_orderdate", "o_orderkey", 3)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
           row_number() OVER w AS position, coalesce(lead(l_partkey) OVER w, -1) AS next_part
    FROM lineitem
    WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey)
    """
)
def next_in_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Each line with its place in the order and the part of the next line, -1 after the last."""
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"])
    order = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]
    return r.next_in_sequence(lines, ["l_orderkey"], order, {"next_part": "l_partkey"}).na.fill(-1, ["next_part"])


@query(
    """
    SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view' AND value > 20
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 4
    """
)
def resume_list(spark: SparkSession, sf: str) -> DataFrame:
    """The last 4 things each user has begun to view (a position over 20)."""
    views = read_table(spark, sf, "events").where("event_type = 'view'").select(
        "event_id", "user_id", "ts", (F.col("value") - 20).alias("position")
    )
    found = r.resume_list(views, "user_id", "position", "ts", "event_id", 4)
    whole = read_table(spark, sf, "events", ["event_id", "value"])
    return found.drop("position").join(whole, "event_id").select("event_id", "user_id", "ts", "value")


@query(
    """
    SELECT user_id, count(*) AS n, max(ts) AS latest FROM events WHERE event_type = 'purchase' GROUP BY user_id
    """
)
def favourites(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases per user and the latest one."""
    events = read_table(spark, sf, "events", ["user_id", "event_type", "ts"])
    return r.favourites(events, "user_id", F.col("event_type") == "purchase", "ts")


@query(
    """
    SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS is_first
    FROM events WHERE event_type = 'error'
    """
)
def first_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    """Errors with a flag: the user's first, or a repeat."""
    errors = read_table(spark, sf, "events").where("event_type = 'error'").select("event_id", "user_id", "ts")
    return r.first_occurrence(errors, ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "is_first")


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 500
    """
)
def top(spark: SparkSession, sf: str) -> DataFrame:
    """The 500 dearest orders."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return paging.top(orders, [F.col("o_totalprice").desc_nulls_last(), "o_orderkey"], 500)


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_name, c_custkey LIMIT 100 OFFSET 100")
def page(spark: SparkSession, sf: str) -> DataFrame:
    """The second page of 100 customers by name."""
    return paging.page(read_table(spark, sf, "customer", ["c_custkey", "c_name"]), ["c_name", "c_custkey"], 100, 1)


@query(
    """
    SELECT * FROM lineitem ORDER BY l_shipdate, l_partkey, l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
    LIMIT 1000 OFFSET 40000
    """
)
def page_deep(spark: SparkSession, sf: str) -> DataFrame:
    """The 41st page of 1000 order lines by date and part, whole rows."""
    return paging.page(read_table(spark, sf, "lineitem"), ["l_shipdate", "l_partkey"], 1000, 40)


@query(
    """
    SELECT count(*) AS n_rows, least(count(*), 200) AS shown, count(*) > 200 AS truncated,
           (SELECT CAST(sum(o_orderkey) AS bigint) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 200)) AS keys
    FROM orders
    """
)
def preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first 200 orders as a preview shows them, and whether there are more."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    shown = paging.preview(orders.orderBy("o_orderdate", "o_orderkey"), 200)
    facts = [(len(shown.rows), shown.truncated, sum(r["o_orderkey"] for r in shown.rows))]
    made = spark.createDataFrame(facts, "shown bigint, truncated boolean, keys bigint")
    return made.join(orders.agg(F.count(F.lit(1)).alias("n_rows")))


@query(
    """
    SELECT CAST(event_id AS varchar) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, event_type, '[2 items]' AS pair,
           'byte[' || octet_length(encode(event_type)) || ']' AS raw, '{"user_id":' || user_id || '}' AS owner FROM events
    """
)
def console_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events with nested and binary values, as the console shows them."""
    events = read_table(spark, sf, "events", ["event_id", "ts", "event_type", "user_id"])
    nested = events.select(
        "event_id", "ts", "event_type", F.array("event_id", "user_id").alias("pair"), F.col("event_type").cast("binary").alias("raw"), F.struct("user_id").alias("owner")
    )
    return nested.select(*[console_text(F.col(f.name), f.dataType).alias(f.name) for f in nested.schema.fields])


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE CAST('0x' || md5(CAST(o_orderkey AS varchar))[1:8] AS bigint) % 100 < 30
    """
)
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A repeatable sample of 30 %."""
    return paging.hash_sample(read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"]), "o_orderkey", 30)


@query()
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A random sample of 30 %."""
    return paging.sample_rows(read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"]), 0.3, seed=7)


@query(
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
    """
)
def append_all(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers in one list; a column only one side has is NULL for the other."""
    customers = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return sets.append_all([customers, suppliers])


@query(
    """
    SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND value > 150
    EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 150
    EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 150
    """
)
def difference(spark: SparkSession, sf: str) -> DataFrame:
    """Users with a large view and neither a large purchase nor a large error."""
    large = read_table(spark, sf, "events", ["user_id", "event_type", "value"]).where("value > 150")
    parts = [large.where(F.col("event_type") == kind).select("user_id") for kind in ("view", "purchase", "error")]
    return sets.difference(*parts)


@query(
    """
    SELECT l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'
    EXCEPT ALL SELECT l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'A'
    """
)
def multiset_difference(spark: SparkSession, sf: str) -> DataFrame:
    """(part, quantity) of R lines that A lines do not balance, repeats counted."""
    lines = read_table(spark, sf, "lineitem", ["l_partkey", "l_quantity", "l_returnflag"])
    sides = [lines.where(F.col("l_returnflag") == flag).drop("l_returnflag") for flag in ("R", "A")]
    return sets.multiset_difference(*sides)


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (supplier, flag, status)."""
    from tablecare.operators.health import distinct_values as distinct

    return distinct(read_table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"])
