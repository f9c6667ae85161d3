"""Laws that must hold on any data, checked on random data with a dominant key."""

import random

import pytest
from pyspark.sql import functions as F

from tablecare.operators import merging as m
from tablecare.operators import references as r


def random_tables(frame, seed):
    dice = random.Random(seed)
    values = [None, "a", "A", "b", "hot", "hot", "hot", "hot"]
    dim = [(f"{i:04d}", dice.randint(1, 2), dice.choice(values)) for i in dice.sample(range(10_000), 60)]
    bridge = [(f"item{dice.randint(0, 20)}", dice.choice(dim)[0]) for _ in range(400)]
    return (
        frame(dim, "id string, type int, value string").repartition(5),
        frame(bridge, "item string, value_id string").repartition(5),
    )


def triples(dim, bridge):
    joined = bridge.join(dim, F.col("value_id") == F.col("id"))
    return {tuple(row) for row in joined.select("item", "type", "value").collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_consolidation_keeps_every_pairing(frame, seed):
    dim, bridge = random_tables(frame, seed)
    out = m.consolidate(dim, bridge, "id", ["type", "value"], "value_id")
    assert triples(out.dim, out.bridge) == triples(dim, bridge)
    assert out.dim.count() == dim.select("type", "value").distinct().count()
    assert out.bridge.count() == out.bridge.distinct().count() == len(triples(dim, bridge))


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_reuse_keeps_every_pairing(frame, seed):
    pending, bridge = random_tables(frame, seed)
    stored, _ = random_tables(frame, seed + 100)
    stored = stored.withColumn("id", F.concat(F.lit("s"), "id"))
    out = m.reuse_values(pending, bridge, stored, "id", ["type", "value"], "value_id")
    assert triples(stored.unionByName(out.dim), out.bridge) == triples(pending, bridge)
    overlap = out.dim.join(stored, (out.dim["type"] == stored["type"]) & out.dim["value"].eqNullSafe(stored["value"]))
    assert overlap.count() == 0


@pytest.mark.parametrize("seed", [7, 8])
def test_merging_twice_is_merging_once(frame, rows, seed):
    stored, _ = random_tables(frame, seed)
    incoming, _ = random_tables(frame, seed + 50)
    for merge in (m.merge_keep_first, m.merge_last_wins):
        once = merge(stored, incoming, ["id"], ["value"])
        assert rows(merge(once, incoming, ["id"], ["value"])) == rows(once)
        assert once.count() == once.select("id").distinct().count()


def test_guarded_rows_are_the_rows_that_are_no_orphans(frame, rows):
    dim, bridge = random_tables(frame, 9)
    parents = dim.where("value = 'hot'")
    guarded = r.guard_children(bridge, parents, "value_id", "id")
    assert rows(guarded.unionAll(r.orphans(bridge, parents, "value_id", "id"))) == rows(bridge)
