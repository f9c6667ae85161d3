"""Referential clean-up. The given tables have no orphans, so parents are filtered or keys blanked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.operators import references as r
from tablecare.plans.catalogue.registry import query
from tablecare.sources.tables import read_table
from tablecare.spec import ForeignKey, TableSpec

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem", LINE)


def _blanked(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"])
    return lines.withColumn("l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")))


def _final_orders(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus"]).where("o_orderstatus = 'F'")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """
)
def drop_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of orders of status F."""
    return r.drop_orphans(_lines(spark, sf), _final_orders(spark, sf), "l_orderkey", "o_orderkey")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
    """
)
def dropped_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """The lines that goes without."""
    return r.orphans(_lines(spark, sf), _final_orders(spark, sf), "l_orderkey", "o_orderkey")


@query(
    """
    SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey ELSE -1 END AS l_orderkey, l_linenumber, l_returnflag FROM lineitem
    WHERE l_returnflag = 'N' OR l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """
)
def drop_orphans_keep_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the lines have no key; they stay (shown as -1)."""
    kept = r.drop_orphans(_blanked(spark, sf), _final_orders(spark, sf), "l_orderkey", "o_orderkey", nulls="keep")
    return kept.na.fill(-1, ["l_orderkey"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    WHERE l_returnflag <> 'N' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """
)
def drop_orphans_drop_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the lines have no key; they go."""
    return r.drop_orphans(_blanked(spark, sf), _final_orders(spark, sf), "l_orderkey", "o_orderkey", nulls="drop")


@query(
    """
    SELECT c_custkey, c_name, CASE
        WHEN c_nationkey = 1 THEN -1
        WHEN c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 2) THEN 1
        ELSE c_nationkey END AS c_nationkey
    FROM customer
    """
)
def repoint_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of nations outside regions 0 to 2 move to the placeholder nation 1; stale ones (NULL) show as -1."""
    customers = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"])
    nations = read_table(spark, sf, "nation").where("n_regionkey <= 2")
    return r.repoint_orphans(customers, "c_nationkey", "n_nationkey", 1, nations).na.fill(-1, ["c_nationkey"])


@query(
    """
    SELECT l.doc_id, l.quality, l.toxic FROM labels l
    WHERE EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id AND d.lang = 'en')
    """
)
def guard_children(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that may be stored because their document is there."""
    english = read_table(spark, sf, "documents", ["doc_id", "lang"]).where("lang = 'en'")
    return r.guard_children(read_table(spark, sf, "labels"), english, "doc_id", "doc_id")


@query(
    """
    SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
    """
)
def unreferenced(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without an open order."""
    opened = read_table(spark, sf, "orders", ["o_custkey", "o_orderstatus"]).where("o_orderstatus = 'O'")
    customers = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return r.unreferenced(customers, opened, "c_custkey", "o_custkey")


@query(
    """
    SELECT c_custkey, c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders FROM customer
    """
)
def child_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per customer, 0 included."""
    customers = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    orders = read_table(spark, sf, "orders", ["o_custkey"])
    return r.with_child_count(customers, orders, "c_custkey", "o_custkey", "n_orders")


@query(
    """
    SELECT n_nationkey, n_name, count(p.p_partkey) AS n_members, CAST(coalesce(sum(p.p_size), 0) AS bigint) AS total_size
    FROM nation LEFT JOIN (
        SELECT DISTINCT l_partkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) x
      ON x.s_nationkey = n_nationkey LEFT JOIN part p ON p.p_partkey = x.l_partkey
    GROUP BY n_nationkey, n_name
    """
)
def registry_report(spark: SparkSession, sf: str) -> DataFrame:
    """Nations with the number and total size of the parts their suppliers ship."""
    suppliers = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    shipped = read_table(spark, sf, "lineitem", ["l_partkey", "l_suppkey"]).distinct()
    pairs = shipped.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select("l_partkey", "s_nationkey").distinct()
    parts = read_table(spark, sf, "part", ["p_partkey", "p_size"])
    members = pairs.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    nations = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    return r.registry_report(nations, members, "n_nationkey", "s_nationkey", "p_size")


@query(
    """
    SELECT p.p_partkey, p.p_brand, p.p_name, h.id AS stored_id
    FROM part p JOIN (SELECT p_brand, p_name, min(p_partkey) AS id FROM part WHERE p_size <= 25 GROUP BY ALL) h
      ON h.p_brand = p.p_brand AND h.p_name = p.p_name
    WHERE p.p_size > 25
    """
)
def lookup_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Large parts whose (brand, name) a small part already has."""
    parts = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_name", "p_size"])
    stored = parts.where("p_size <= 25").groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("id"))
    pending = parts.where("p_size > 25").drop("p_size")
    return r.lookup_pairs(pending, stored, ["p_brand", "p_name"], {"stored_id": "id"})


@query(
    """
    SELECT DISTINCT p_name FROM part WHERE p_type = 'ECONOMY'
    EXCEPT SELECT p_name FROM part WHERE p_type = 'PROMO' AND p_size > 25
    """
)
def missing_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of economy parts that no large promo part has."""
    parts = read_table(spark, sf, "part", ["p_name", "p_type", "p_size"])
    present = parts.where("p_type = 'PROMO' AND p_size > 25")
    return r.missing(parts.where("p_type = 'ECONOMY'"), present, "p_name")


@query(
    """
    WITH f AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    SELECT 'lineitem' AS child, 'l_orderkey' AS child_key, 'orders' AS parent, count(*) AS child_rows,
           count(*) FILTER (l_returnflag = 'N') AS null_keys,
           count(*) FILTER (l_returnflag <> 'N' AND l_orderkey NOT IN (FROM f)) AS orphans FROM lineitem
    UNION ALL
    SELECT 'lineitem', 'l_partkey', 'part', count(*), 0,
           count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)) FROM lineitem
    UNION ALL
    SELECT 'orders', 'o_custkey', 'customer', count(*), 0, 0 FROM orders WHERE o_orderstatus = 'F'
    """
)
def reference_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every foreign key of a dataset with blanked keys and filtered parents."""
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag"])
    tables = {
        "lineitem": lines.withColumn("l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_orderkey"))),
        "orders": read_table(spark, sf, "orders").where("o_orderstatus = 'F'"),
        "part": read_table(spark, sf, "part").where("p_size <= 25"),
        "customer": read_table(spark, sf, "customer"),
    }
    specs = [
        TableSpec.of(
            "lineitem",
            tables["lineitem"].schema,
            foreign_keys=(
                ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
                ForeignKey(("l_partkey",), "part", ("p_partkey",)),
            ),
        ),
        TableSpec.of(
            "orders", tables["orders"].schema, foreign_keys=(ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)
        ),
    ]
    return r.audit_references(tables, specs)
