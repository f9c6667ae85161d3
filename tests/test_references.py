import pytest
from pyspark.sql import functions as F

from tablecare.operators import references as r
from tablecare.spec import ForeignKey, TableSpec

CHILD = "id int, user_id string"


def test_orphans_with_both_null_policies(frame, rows):
    child = frame([(1, "a"), (2, "gone"), (3, None)], CHILD)
    users = frame([("a",), ("b",)], "user string")
    assert rows(r.drop_orphans(child, users, "user_id", "user", nulls="drop")) == [(1, "a")]
    assert rows(r.drop_orphans(child, users, "user_id", "user", nulls="keep")) == [(1, "a"), (3, None)]
    assert rows(r.orphans(child, users, "user_id", "user", nulls="keep")) == [(2, "gone")]
    assert rows(r.orphans(child, users, "user_id", "user", nulls="drop")) == [(2, "gone"), (3, None)]
    with pytest.raises(ValueError):
        r.drop_orphans(child, users, "user_id", "user", nulls="other")


def test_a_null_parent_key_does_not_hide_orphans(frame, rows):
    child = frame([(1, "a"), (2, "gone")], CHILD)
    assert rows(r.orphans(child, frame([("a",), (None,)], "user string"), "user_id", "user")) == [(2, "gone")]


def test_kept_and_dropped_make_the_input(spark):
    child = spark.range(500).select(F.col("id"), F.when(F.col("id") % 5 != 0, F.col("id") % 40).alias("fk"))
    parent = spark.range(20).select(F.col("id").alias("pk"))
    for nulls in ("keep", "drop"):
        kept = r.drop_orphans(child, parent, "fk", "pk", nulls=nulls)
        gone = r.orphans(child, parent, "fk", "pk", nulls=nulls)
        assert kept.count() + gone.count() == 500 and kept.unionAll(gone).distinct().count() == 500


def test_composite_keys(frame, rows):
    child = frame([(1, "x"), (1, "y")], "a int, b string")
    parent = frame([(1, "x"), (2, "y")], "pa int, pb string")
    assert rows(r.drop_orphans(child, parent, ["a", "b"], ["pa", "pb"])) == [(1, "x")]


def test_repoint_orphans_within_one_table(frame, rows):
    items = frame([("a", None), ("b", "a"), ("c", "gone"), ("d", "hole")], "id string, owner string")
    out = r.repoint_orphans(items, "owner", "id", "hole")
    assert rows(out) == [("a", None), ("b", "a"), ("c", "hole"), ("d", None)]


def test_guard_children_skips_rows_of_absent_items(frame, rows):
    pending = frame([("i1", "img"), ("gone", "img"), (None, "img")], "item string, kind string")
    assert rows(r.guard_children(pending, frame([("i1",)], "id string"), "item", "id")) == [("i1", "img")]


def test_counts_missing_unreferenced_registry(frame, rows):
    dim = frame([(1, "a"), (2, "b")], "id int, name string")
    fact = frame([(1, 10), (1, 20)], "dim int, size int")
    assert rows(r.with_child_count(dim, fact, "id", "dim")) == [(1, "a", 2), (2, "b", 0)]
    assert rows(r.unreferenced(dim, fact, "id", "dim")) == [(2, "b")]
    assert rows(r.registry_report(dim, fact, "id", "dim", "size")) == [(1, "a", 2, 30), (2, "b", 0, 0)]
    assert rows(r.missing(frame([("x",), ("y",), ("y",)], "n string"), frame([("x",)], "n string"), "n")) == [("y",)]


def test_audit_leaves_self_references_out(frame, rows):
    child = frame([(1, 1), (2, None), (3, 9)], "id int, fk int")
    spec = TableSpec.of(
        "child", child.schema, foreign_keys=(ForeignKey(("fk",), "parent", ("id",)), ForeignKey(("fk",), "child", ("id",)))
    )
    audit = r.audit_references({"child": child, "parent": frame([(1,)], "id int")}, [spec])
    assert rows(audit) == [("child", "fk", "parent", 3, 1, 1)]
