import pytest
from pyspark.sql import functions as F

from tablecare.operators import merging as m

VALUES = "id string, type int, value string"
BRIDGE = "item string, value_id string"


def uid(n):
    return f"00000000-0000-0000-0000-{n:012d}"


def test_consolidate_moves_bridge_to_smallest_id(frame, rows):
    dim = frame([(uid(2), 1, "Twice"), (uid(1), 1, "Twice"), (uid(3), 2, "Twice")], VALUES)
    bridge = frame([("a", uid(1)), ("b", uid(2)), ("a", uid(2)), ("c", uid(3))], BRIDGE)
    out = m.consolidate(dim, bridge, "id", ["type", "value"], "value_id")
    assert rows(out.dim, "id") == [(uid(1),), (uid(3),)]
    assert rows(out.bridge) == [("a", uid(1)), ("b", uid(1)), ("c", uid(3))]
    assert rows(out.remap) == [(uid(2), uid(1))]


def test_consolidate_twice_is_once_and_treats_null_values_as_equal(frame, rows):
    dim = frame([(uid(2), 1, None), (uid(1), 1, None)], VALUES)
    bridge = frame([("a", uid(2))], BRIDGE)
    once = m.consolidate(dim, bridge, "id", ["type", "value"], "value_id")
    twice = m.consolidate(once.dim, once.bridge, "id", ["type", "value"], "value_id")
    assert rows(once.dim) == rows(twice.dim) == [(uid(1), 1, None)]
    assert rows(once.bridge) == rows(twice.bridge) == [("a", uid(1))]


def test_reuse_takes_stored_id_and_keeps_new_values(frame, rows):
    stored = frame([(uid(1), 2, "Action")], VALUES)
    pending = frame([(uid(8), 2, "Action"), (uid(9), 2, "Fresh")], VALUES)
    bridge = frame([("item", uid(8)), ("item", uid(9))], BRIDGE)
    out = m.reuse_values(pending, bridge, stored, "id", ["type", "value"], "value_id")
    assert rows(out.dim) == [(uid(9), 2, "Fresh")]
    assert rows(out.bridge) == [("item", uid(1)), ("item", uid(9))]


def test_reuse_collapses_pending_copies(frame, rows):
    stored = frame([(uid(1), 4, "Liked")], VALUES)
    pending = frame([(uid(5), 4, "Liked"), (uid(6), 4, "Liked"), (uid(7), 4, "New"), (uid(8), 4, "New")], VALUES)
    bridge = frame([("x", uid(5)), ("x", uid(6)), ("x", uid(7)), ("y", uid(8))], BRIDGE)
    out = m.reuse_values(pending, bridge, stored, "id", ["type", "value"], "value_id")
    assert rows(out.dim) == [(uid(7), 4, "New")]
    assert rows(out.bridge) == [("x", uid(1)), ("x", uid(7)), ("y", uid(7))]


def test_reuse_is_case_sensitive(frame, rows):
    stored = frame([(uid(1), 4, "liked")], VALUES)
    pending = frame([(uid(5), 4, "Liked")], VALUES)
    out = m.reuse_values(pending, frame([("x", uid(5))], BRIDGE), stored, "id", ["type", "value"], "value_id")
    assert rows(out.dim) == [(uid(5), 4, "Liked")]
    assert out.remap.count() == 0


READING = "station string, hour int, level string"


def test_keep_first_never_changes_a_stored_row(frame, rows):
    stored = frame([("quay", 6, "4.2 m")], READING)
    incoming = frame([("quay", 6, "5.0 m"), ("weir", 7, "2"), ("weir", 7, "1"), (None, 9, "3")], READING)
    once = m.merge_keep_first(stored, incoming, ["station", "hour"], [])
    assert rows(once) == [("quay", 6, "4.2 m"), ("weir", 7, "1")]
    assert rows(m.merge_keep_first(once, incoming, ["station", "hour"], [])) == rows(once)


def test_a_table_of_keys_only(frame, rows):
    pairs = frame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert rows(m.merge_keep_first(pairs.limit(0), pairs, ["a", "b"], [])) == [(1, 2), (3, 4)]


def test_last_wins_replaces_all_columns(frame, rows):
    stored = frame([("quay", 6, "4.2 m"), ("lock", 8, "0")], READING)
    incoming = frame([("quay", 6, None), ("weir", 7, "1"), ("weir", 7, "2")], READING)
    order = [F.col("level").desc()]
    merged = m.merge_last_wins(stored, incoming, ["station", "hour"], order)
    assert rows(merged) == [("lock", 8, "0"), ("quay", 6, None), ("weir", 7, "2")]
    assert rows(m.merge_last_wins(merged, incoming, ["station", "hour"], order)) == rows(merged)


def test_full_row_recreates_a_vanished_row_and_refuses_a_partial_one(frame, rows):
    stored = frame([], READING)
    assert rows(m.merge_full_row(stored, frame([("quay", 6, "1")], READING), ["station"], [])) == [("quay", 6, "1")]
    with pytest.raises(ValueError, match="level"):
        m.merge_full_row(stored, frame([("quay", 6)], "station string, hour int"), ["station"], [])


def test_update_matched_lands_nulls_and_never_inserts(frame, rows):
    stored = frame([("quay", 6, "1"), ("weir", 7, "2")], READING)
    patch = frame([("quay", None), ("new", "x")], "station string, level string")
    assert rows(m.update_matched(stored, patch, ["station"])) == [("quay", 6, None), ("weir", 7, "2")]


def test_report_counts_every_incoming_row_once(frame):
    stored = frame([("quay", 6, "1")], READING)
    incoming = frame([("quay", 6, "2"), ("weir", 7, "1"), ("weir", 7, "2"), (None, 9, "3")], READING)
    keep = m.merge_report(stored, incoming, ["station", "hour"], "keep_first", "t").first()
    assert keep.asDict() == {"table": "t", "read": 4, "inserted": 1, "updated": 0, "skipped": 2, "refused": 1}
    wins = m.merge_report(stored, incoming, ["station", "hour"], "last_wins", "t").first()
    assert wins.asDict() == {"table": "t", "read": 4, "inserted": 1, "updated": 1, "skipped": 1, "refused": 1}


def test_report_agrees_with_the_merge(frame):
    stored = frame([(i, 0) for i in range(0, 50, 2)], "id int, v int")
    incoming = frame([(i % 60, i) for i in range(200)], "id int, v int")
    report = m.merge_report(stored, incoming, ["id"], "keep_first", "t").first()
    assert m.merge_keep_first(stored, incoming, ["id"], ["v"]).count() == 25 + report["inserted"]
    assert report["inserted"] + report["skipped"] + report["refused"] == report["read"] == 200


def test_assign_keys_goes_on_from_the_largest(frame):
    stored = frame([(4, "old"), (9, "old")], "id bigint, name string")
    incoming = frame([(f"n{i:03d}",) for i in range(300)], "name string").repartition(7)
    out = m.assign_keys(stored, incoming, "id", ["name"])
    made = sorted((r["id"], r["name"]) for r in out.collect())
    assert made == [(10 + i, f"n{i:03d}") for i in range(300)]


def test_assign_keys_into_an_empty_table(frame):
    out = m.assign_keys(frame([], "id bigint, name string"), frame([("a",)], "name string"), "id", ["name"])
    assert out.first()["id"] == 1
