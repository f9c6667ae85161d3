"""Batch search. The terms are the words of the part names, with their first one and two letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.operators import searching as s
from tablecare.plans.catalogue.registry import query
from tablecare.sources.tables import read_table

TERMS = """
    WITH words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part),
    terms AS (SELECT w AS term FROM words UNION SELECT w[1:2] FROM words UNION SELECT upper(w[1:1]) FROM words)
"""

# Word similarity by its definition: every run of the text's trigrams is tried.
SIMILARITY = (
    TERMS
    + """,
    names AS (SELECT DISTINCT p_name FROM part),
    pairs AS (SELECT term, p_name FROM terms, names WHERE contains(lower(p_name), lower(term))),
    grams AS (
        SELECT term, p_name,
               list_distinct(list_transform(range(1, length(term) + 2), lambda i: substr('  ' || lower(term) || ' ', i, 3))) AS a,
               flatten(list_transform(string_split(lower(p_name), ' '),
                   lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))) AS e
        FROM pairs),
    starts AS (SELECT term, p_name, a, e, unnest(range(1, len(e) + 1)) AS i FROM grams),
    runs AS (SELECT term, p_name, a, list_slice(e, i, j) AS run
             FROM (SELECT *, unnest(range(i, len(e) + 1)) AS j FROM starts)),
    scored AS (
        SELECT term, p_name,
               max(CAST(len(list_intersect(list_distinct(run), a)) AS double) / len(list_distinct(run || a))) AS relevance
        FROM runs GROUP BY term, p_name)
    """
)


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    words = read_table(spark, sf, "part", ["p_name"]).select(F.explode(F.split("p_name", " ")).alias("w"))
    forms = F.array("w", F.substring("w", 1, 2), F.upper(F.substring("w", 1, 1)))
    return words.select(F.explode(forms).alias("term")).distinct().withColumn("query_id", F.col("term"))


@query(
    TERMS
    + """
    SELECT term AS query_id, o_orderkey, relevance, position FROM (
        SELECT term, o_orderkey, CASE WHEN lower(p_name) = lower(term) THEN 1.0::double ELSE 0.5::double END AS relevance,
               row_number() OVER (
                   PARTITION BY term
                   ORDER BY lower(p_name) = lower(term) DESC, o_orderdate DESC NULLS LAST, o_orderkey) AS position
        FROM terms JOIN (
            SELECT o_orderkey, o_orderpriority AS p_name, o_orderdate,
                   CASE WHEN o_orderstatus = 'F' THEN 'final bolt' END AS note FROM orders)
          ON contains(lower(p_name), lower(term)) OR coalesce(contains(note, lower(term)), false))
    WHERE position <= 5
    """
)
def search_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 5 orders per term in two text columns, one of them often NULL, by the fallback score."""
    note = F.when(F.col("o_orderstatus") == "F", "final bolt")
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("name"), note.alias("note"), "o_orderdate"
    )
    found = s.search(
        _terms(spark, sf), orders, ["name", "note"], corpus_id="o_orderkey", date="o_orderdate", k=5, scorer="exact"
    )
    return found.withColumn("position", F.col("position").cast("bigint"))


BEST_PARTS = (
    SIMILARITY
    + """
    SELECT term AS query_id, p_partkey, round(relevance, 6) AS relevance, position FROM (
        SELECT s.term, p.p_partkey, s.relevance,
               row_number() OVER (PARTITION BY s.term ORDER BY s.relevance DESC, p.p_partkey) AS position
        FROM scored s JOIN part p ON p.p_name = s.p_name)
    WHERE position <= 8
    """
)


def _best_parts(spark: SparkSession, sf: str, **strategy: int) -> DataFrame:
    parts = read_table(spark, sf, "part", ["p_partkey", "p_name"])
    found = s.search(_terms(spark, sf), parts, ["p_name"], corpus_id="p_partkey", **strategy)
    return found.withColumn("relevance", F.round("relevance", 6)).withColumn("position", F.col("position").cast("bigint"))


@query(BEST_PARTS)
def search_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """The best 8 parts per term by word similarity."""
    return _best_parts(spark, sf)


@query(BEST_PARTS)
def search_by_gram(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the terms filed by grams and sent to every task, as for more terms than tests fit a plan."""
    return _best_parts(spark, sf, few=0)


@query(BEST_PARTS)
def search_by_shuffled_gram(spark: SparkSession, sf: str) -> DataFrame:
    """The same with ids and terms shuffled by gram, as for more terms than a task can hold."""
    return _best_parts(spark, sf, few=0, broadcast_up_to=0)


@query(
    SIMILARITY
    + """
    SELECT term AS query_id, p_partkey, p_name, p_type, p_size, p_brand, round(relevance, 6) AS relevance, position FROM (
        SELECT s.term, p.*, s.relevance,
               row_number() OVER (PARTITION BY s.term ORDER BY s.relevance DESC, p.p_partkey) AS position
        FROM scored s JOIN part p ON p.p_name = s.p_name WHERE p_type LIKE '%STEEL' OR p_size > 40)
    WHERE position <= 8
    """
)
def search_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The best 8 parts per term among those of some kinds, with their columns."""
    kinds = F.col("p_type").endswith("STEEL") | (F.col("p_size") > 40)
    shown = ["p_name", "p_type", "p_size", "p_brand"]
    found = s.search(_terms(spark, sf), read_table(spark, sf, "part"), ["p_name"], corpus_id="p_partkey", where=kinds, show=shown)
    return found.withColumn("relevance", F.round("relevance", 6)).withColumn("position", F.col("position").cast("bigint"))


@query(
    TERMS
    + """
    SELECT term AS query_id, count(*) AS n_documents, CAST(sum(doc_id) AS bigint) AS ids
    FROM terms JOIN documents ON contains(lower(text), lower(term)) GROUP BY term
    """
)
def search_documents(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents hold each term, over the whole texts."""
    documents = read_table(spark, sf, "documents", ["doc_id", "text"])
    found = s.candidates(_terms(spark, sf), documents, "query_id", "term", "doc_id", ["text"])
    return found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("doc_id").alias("ids"))


@query(
    """
    SELECT c_custkey, CASE WHEN lower(c_mktsegment) = 'building' THEN 1.0::double ELSE 0.5::double END AS score FROM customer
    """
)
def exact_score(spark: SparkSession, sf: str) -> DataFrame:
    """The fallback score of every customer for one segment."""
    customers = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    return customers.select("c_custkey", s.exact_score(F.col("c_mktsegment"), F.lit("Building")).alias("score"))
