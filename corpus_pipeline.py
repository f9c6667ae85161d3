"""From raw documents to packed sequences: quality rules, line dedup, near-duplicate join, decontamination, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.llm import decontamination, jaccard_join, line_dedup, packing, quality
from tablecare.llm.queries import vocabulary
from tablecare.llm.shipping import ship
from tablecare.session import cut_lineage, shared_dir

NEAR = jaccard_join.Similarity(shingle=5, percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the fixed rules and the cutoffs fitted on the labelled ones of their language."""
    ship(spark)
    measured = cut_lineage(quality.measure(docs, keep=["doc_id", "lang"]).select("row.*", *quality.MEASURES))
    cutoffs = quality.fit_on(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    passed = quality.measure(docs).where(quality.verdict(cutoffs, F.col("row")["lang"]))
    return passed.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that match an earlier line."""
    return line_dedup.drop_later_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return jaccard_join.keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a sequence for every piece of every document."""
    ship(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None
"""Cutoffs from binomial bounds and the order of packing have no SQL form; tests compare with a brute-force version."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
