import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablecare.operators import paging, ranking, sets
from tests.conftest import SMALL, plan_of

NOW = datetime(2024, 6, 1)


def test_retention(frame):
    """Random ages per group against the rule said in plain Python; ids are unique inside a group only."""
    r = random.Random(12)
    made = [(g, i, f"{r.choice(['log', 'tmp'])}-{i}", NOW - timedelta(hours=r.randint(1, 4000))) for g in "abc" for i in range(25)]
    files = frame(made, "g string, id int, name string, at timestamp")
    for days, keep, pattern in ((60, 4, None), (10, 0, "^log"), (0, 3, None), (120, 1, "^log")):
        plan = ranking.retention_plan(files, ["g"], "at", "id", days, keep, NOW, "name", pattern)
        expected = []
        for g in "abc":
            own = sorted((m for m in made if m[0] == g and (not pattern or m[2].startswith("log"))), key=lambda m: (-m[3].timestamp(), m[1]))
            expected += [m[:2] for m in own[keep:] if days > 0 and m[3] < NOW - timedelta(days=days)]
        assert sorted((x["g"], x["id"]) for x in plan.collect()) == sorted(expected)


def test_latest_resume_favourites(frame, rows):
    state = frame(
        [(1, "u", 5, "2024-01-01", True), (2, "u", 0, "2024-01-09", True), (3, "u", 9, None, False), (4, "v", 1, "2024-01-02", None)],
        "id int, who string, position int, day string, liked boolean",
    )
    assert rows(ranking.resume_list(state, "who", "position", "day", "id", 1), "id") == [(1,), (4,)]
    assert rows(ranking.latest_per_group(state, ["who"], "day", "id", 2), "id") == [(1,), (2,), (4,)]
    assert rows(ranking.favourites(state, "who", F.col("liked"), "day")) == [("u", 2, "2024-01-09")]


def test_pages_and_tops(spark):
    df = spark.range(201).select(F.format_string("n%03d", "id").alias("name"))
    pages = [[r[0] for r in paging.page(df, ["name"], 100, i).collect()] for i in range(3)]
    assert [len(p) for p in pages] == [100, 100, 1] and sum(pages, []) == sorted(sum(pages, []))
    assert paging.top(df, [F.col("name").desc()], 150).count() == 150 and paging.top(df, ["name"]).count() == 50
    assert paging.top(df, ["name"], -4).count() == 1
    assert "TakeOrderedAndProject" in plan_of(paging.top(df, ["name"], 5))
    assert [r[0] for r in paging.worst(df, [F.col("name").desc()], 2).collect()] == ["n200", "n199"]


def test_preview_tells_of_more_rows(spark):
    df = spark.range(300)
    assert paging.preview(df, 10).truncated and len(paging.preview(df, 10).rows) == 10
    whole = paging.preview(spark.range(7), 7)
    assert not whole.truncated and len(whole.rows) == 7
    with pytest.raises(ValueError):
        paging.preview(df, 1000)


def test_samples(spark):
    df = spark.range(10_000)
    assert 2500 < paging.sample_rows(df, 0.3, seed=1).count() < 3500
    kept = paging.hash_sample(df, "id", 30)
    assert 2500 < kept.count() < 3500 and kept.exceptAll(paging.hash_sample(df.repartition(5), "id", 30)).count() == 0


def test_sets(frame, rows):
    a, b = frame([(1, "x"), (1, "x"), (2, "y")], "i int, s string"), frame([(1, "x")], "i int, s string")
    assert rows(sets.difference(a, b)) == [(2, "y")]
    assert rows(sets.multiset_difference(a, b)) == [(1, "x"), (2, "y")]
    many, few = frame([(1, "x")] * 25 + [(2, "y")] * 3, "i int, s string"), frame([(1, "x")] * 2, "i int, s string")
    for copies in (1, 4, 23, 100):
        assert rows(sets.multiset_difference(many, few, copies)) == [(1, "x")] * 23 + [(2, "y")] * 3
    assert rows(sets.append_all([b, frame([(5,)], "i int")])) == [(1, "x"), (5, None)]


def test_scan_prunes_columns_and_pushes_filters(spark):
    from tablecare.plans.catalogue import QUERIES

    shown = plan_of(QUERIES["projected_scan"](spark, SMALL))
    assert "LessThan(l_shipdate" in shown
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in shown


@pytest.mark.parametrize("name", ["merge_keep_first", "merge_last_wins", "latest_per_group", "retention_plan"])
def test_ranked_queries_cut_groups_before_the_shuffle(spark, name):
    from tablecare.plans.catalogue import QUERIES

    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, SMALL))


def test_small_parents_are_broadcast(spark):
    from tablecare.plans.catalogue import QUERIES

    assert "BroadcastHashJoin" in plan_of(QUERIES["drop_orphans"](spark, SMALL))


def test_first_occurrence_with_maps_and_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2, map('a', 1)), (1, 1, map('b', 2)), (1, 1, map('b', 2)), (2, NULL, NULL) AS t(k, t, m)")
    found = ranking.first_occurrence(df, ["k"], ["t"])
    assert sorted((x["k"], x["t"], x["is_first"]) for x in found.where("k = 1").collect()) == [(1, 1, True), (1, 1, True), (1, 2, False)]
    assert [x["is_first"] for x in found.where("k = 2").collect()] == [True]


@pytest.mark.parametrize("start", [0, 37, 5_000, 11_990, 20_000])
def test_a_deep_page_looks_only_near_its_rank(spark, start, monkeypatch):
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 0)
    df = spark.range(12_000).select((F.col("id") * 7919 % 12_000).alias("id"), F.when(F.col("id") % 5 != 0, F.col("id") % 300).alias("v"), F.lit("x").alias("w"))
    rows = sorted(map(tuple, df.collect()), key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    page = paging.page(df, ["v"], 1, start) if start % 10 else paging.page(df, ["v"], 10, start // 10)
    size = 1 if start % 10 else 10
    assert sorted(map(tuple, page.collect())) == sorted(rows[start : start + size])
    near, before = paging.near_rank(df, ["v", "id"], start, start + size)
    assert near.count() <= 12_000 // 2 and before <= start or start >= 12_000
