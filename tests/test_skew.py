"""Operators when one key owns most of the rows; small thresholds force the paths for hot keys."""

import pytest
from pyspark.sql import Window, functions as F

from tablecare.operators import keys, paging, ranking, references
from tests.conftest import final_plan, plan_of


@pytest.fixture()
def skewed(spark):
    """3000 rows, two thirds of them under one key, some under NULL."""
    key = F.when(F.col("id") % 3 != 0, F.lit(7)).when(F.col("id") % 30 == 0, None).otherwise(F.col("id") % 11)
    return spark.range(3000).select("id", key.cast("int").alias("k"), (F.col("id") * 7919 % 1009).alias("v")).repartition(8)


def test_attach_group_is_the_window_result(skewed, rows):
    window = Window.partitionBy("k")
    expected = skewed.select("id", F.min("id").over(window).alias("low"), F.max("v").over(window).alias("top"))
    for share, least in ((0.1, 10), (1.1, 10), (0.0, 0)):
        got = keys.attach_group(skewed, ["k"], {"low": F.min("id"), "top": F.max("v")}, share, least)
        assert got.columns == ["id", "k", "v", "low", "top"]
        assert rows(got, "id", "low", "top") == rows(expected)


def test_hot_rows_are_spread_by_the_join(spark, skewed):
    """With no broadcast of the cold side, the rows of the hot key must not share one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {n: spark.conf.get(n, None) for n in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = keys.attach_group(skewed, ["k"], {"low": F.min("id")}, share=0.1, min_rows=10)
        assert any("hashpartitioning" in line and "_salt" in line for line in plan_of(got).splitlines())
        spread = got.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) > 1 and max(r["count"] for r in spread) < 1600
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_keys_are_found_and_split_exactly(skewed, rows):
    hot = keys.hot_keys(skewed, ["k"], share=0.3, min_rows=10, fraction=1.0)
    assert rows(hot) == [(7,)]
    large, rest = keys.split_by(skewed, ["k"], hot)
    assert large.count() + rest.count() == 3000 and large.where("k <> 7").count() == 0
    assert keys.hot_keys(skewed, ["k"], share=0.9, min_rows=10, fraction=1.0) is None


@pytest.mark.parametrize("share", [0.3, 0.01, 0.9])
def test_next_in_sequence_with_and_without_hot_groups(skewed, rows, share):
    window = Window.partitionBy("k").orderBy("v", "id")
    expected = skewed.select(
        "id", F.row_number().over(window).cast("bigint").alias("position"), F.lead("id").over(window).alias("next_id")
    )
    got = ranking.next_in_sequence(skewed, ["k"], ["v", "id"], {"next_id": "id"}, share=share, min_rows=5, fraction=1.0)
    assert rows(got, "id", "position", "next_id") == rows(expected)


def test_number_rows_is_a_gapless_global_order(skewed):
    numbered = keys.number_rows(skewed, ["v", F.col("id").desc()], "n").collect()
    ordered = sorted(numbered, key=lambda r: (r["v"], -r["id"]))
    assert [r["n"] for r in ordered] == list(range(3000))


def test_first_per_key_limits_before_the_shuffle(skewed):
    plan = plan_of(keys.first_per_key(skewed, ["k"], ["v"], 3))
    assert plan.count("WindowGroupLimit") == 2


def test_long_lists_per_key_are_cut_in_parts(skewed, rows, monkeypatch):
    short = keys.first_per_key(skewed, ["k"], ["v"], 40)
    monkeypatch.setattr(keys, "GROUP_LIMIT", 5)
    long = keys.first_per_key(skewed, ["k"], ["v"], 40)
    assert long.columns == skewed.columns and rows(long) == rows(short)


def test_deep_page_equals_shallow_page(skewed, rows, monkeypatch):
    shallow = paging.page(skewed, ["v", "id"], 100, 20)
    assert "TakeOrderedAndProject" in plan_of(shallow)
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 0)
    assert rows(paging.page(skewed, ["v", "id"], 100, 20)) == rows(shallow)


def test_first_occurrence_flags_one_row_per_key(skewed, rows):
    flagged = ranking.first_occurrence(skewed, ["k"], ["v", "id"])
    firsts = flagged.where("is_first")
    assert flagged.count() == 3000
    assert rows(firsts, "k", "v") == rows(skewed.groupBy("k").agg(F.min("v").alias("v")))


def test_a_skewed_child_is_split_at_run_time(spark):
    """The orphan join splits the partition of a hot key by itself once it is large enough."""
    child = spark.range(400_000, numPartitions=8).select(
        F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id") % 1000).alias("fk"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    parent = spark.range(0, 900).select(F.col("id").alias("pk"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        kept = references.drop_orphans(child, parent, "fk", "pk", nulls="drop")
        assert "skew=true" in final_plan(kept)
        assert kept.count() == child.where("fk < 900").count()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
