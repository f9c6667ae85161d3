"""Datasets that change as a whole, and swaps of single tables that a job died in."""

import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablecare.sources import dataset as d
from tablecare.sources import tables


class Killed(BaseException):
    """Ends a job at once: nothing of its own clean-up runs on it."""


@pytest.fixture()
def data(spark, tmp_path):
    made = d.Dataset(spark, str(tmp_path / uuid.uuid4().hex))
    made.write({"a": spark.range(5).withColumn("v", F.lit("old")), "b": spark.range(3), "c": spark.range(2)})
    return made


def ids(df):
    return sorted(r["id"] for r in df.collect())


def state(data):
    return {n: sorted(map(tuple, data.read(n).collect())) for n in data.names()}


def test_modes(spark, data):
    incoming = spark.createDataFrame([(4, "new"), (7, "new"), (7, "newer")], "id long, v string")
    before = data.read("a")
    data.write({"a": incoming}, "keep", {"a": ["id"]}, {"a": [F.col("v").desc()]})
    assert sorted(map(tuple, data.read("a").collect())) == [(0, "old"), (1, "old"), (2, "old"), (3, "old"), (4, "old"), (7, "newer")]
    assert len(data.head().tables["a"]) == 2 and ids(before) == [0, 1, 2, 3, 4]
    data.write({"a": incoming}, "upsert", {"a": ["id"]}, {"a": ["v"]})
    assert sorted(map(tuple, data.read("a").where("id > 3").collect())) == [(4, "new"), (7, "new")]
    data.write({"b": spark.range(1), "new": spark.range(9)}, "append")
    assert ids(data.read("b")) == [0, 0, 1, 2] and data.read("new", ["id"]).count() == 9
    assert len(data.compact().tables["b"]) == 1 and ids(data.read("b")) == [0, 0, 1, 2]
    assert data.drop(["new"]).number == data.head().number and data.names() == ["a", "b", "c"]
    with pytest.raises(ValueError):
        data.write({}, "merge")
    with pytest.raises(KeyError):
        data.read("absent")


@pytest.mark.parametrize("step", range(5))
def test_a_write_that_dies_leaves_all_as_it_was(spark, data, monkeypatch, step):
    """Killed before each folder, before the manifest, and after it."""
    before, calls = state(data), []
    writer, put = type(spark.range(1).write), d.write_text_once

    def parquet(self, *a, real=writer.parquet, **k):
        if len(calls) == step:
            raise Killed
        calls.append(a)
        return real(self, *a, **k)

    def once(*a):
        if step == 3:
            raise Killed
        put(*a)
        if step == 4:
            raise Killed

    with monkeypatch.context() as patched, pytest.raises(Killed):
        patched.setattr(writer, "parquet", parquet)
        patched.setattr(d, "write_text_once", once)
        data.write({n: spark.range(50).withColumn("v", F.lit("x")) for n in "abc"})
    again = d.Dataset(spark, data._folder)
    assert state(again) == (before if step < 4 else {n: [(k, "x") for k in range(50)] for n in "abc"})
    again.write({"b": spark.range(4)})
    again.write({"c": spark.range(4)})
    kept = state(again)
    again.clean(keep=1)
    assert state(again) == kept and len(os.listdir(f"{data._folder}/data")) == 3


def test_a_failing_table_undoes_the_others(spark, data):
    before, folders = state(data), os.listdir(f"{data._folder}/data")
    with pytest.raises(Exception, match="boom"):
        data.write({"a": spark.range(9), "b": spark.range(2).select(F.raise_error(F.lit("boom")).alias("id"))})
    assert state(data) == before and os.listdir(f"{data._folder}/data") == folders


def test_one_of_two_writers_wins(spark, data, monkeypatch):
    other, put = d.Dataset(spark, data._folder), d.write_text_once

    def late(*a):
        monkeypatch.setattr(d, "write_text_once", put)
        other.write({"b": spark.range(30)})
        put(*a)

    monkeypatch.setattr(d, "write_text_once", late)
    with pytest.raises(d.Conflict):
        data.write({"a": spark.range(40)})
    assert data.read("a").count() == 5 and data.read("b").count() == 30


def test_purge_snapshot_restore(spark, data):
    before = state(data)
    taken = data.snapshot("nightly", datetime(2024, 1, 2, 3, 4, 5))
    assert data.snapshots() == ["nightly_20240102_030405"]
    assert sorted(map(tuple, data.purge(["a", "b"]).collect())) == [("a", 5), ("b", 3)]
    assert state(data) == {"a": [], "b": [], "c": before["c"]} and data.read("a").columns == ["id", "v"]
    for n in range(4):
        data.write({"new": spark.range(n)})
    data.clean()
    data.restore(taken, ["b"])
    assert state(data) == {"a": [], "b": before["b"], "c": before["c"], "new": [(0,), (1,), (2,)]}
    data.restore(taken)
    assert {n: rows for n, rows in state(data).items() if n != "new"} == before
    with pytest.raises(KeyError):
        data.restore(taken, ["b", "absent"])
    with pytest.raises(FileExistsError):
        data.snapshot("nightly", datetime(2024, 1, 2, 3, 4, 5))
    data.drop_snapshot(taken)
    assert data.snapshots() == [] and state(data)["a"] == before["a"]


def test_content_ignores_order_but_not_repeats(spark):
    df = spark.range(20).withColumn("x", F.when(F.col("id") > 3, F.col("id") / 3))
    mark = lambda rows: tuple(d.content(rows).first())
    assert mark(df) == mark(df.repartition(7)) != mark(df.unionAll(df)) and mark(df) != mark(df.where("id > 0"))


@pytest.mark.parametrize("renames", [0, 1])
def test_a_swap_that_dies_is_recovered(spark, tmp_path, renames):
    path = tables.table_path(str(tmp_path), "t")
    tables.write_table(spark.range(5), path)
    os.rename(path, f"{path}.old-1")
    if renames:
        spark.range(7).write.parquet(path)
    spark.range(9).write.parquet(f"{path}.new-2")
    tables.recover(spark, path)
    assert spark.read.parquet(path).count() == (7 if renames else 5)
    assert sorted(os.listdir(tmp_path)) == ["t.parquet", "t.parquet.new-2"]
    os.utime(f"{path}.new-2", (1, 1))
    tables.write_table(spark.range(6).select("id"), path, "upsert", ["id"])
    assert spark.read.parquet(path).count() == (7 if renames else 6) and os.listdir(tmp_path) == ["t.parquet"]


def test_staged_copies_are_removed(spark, tmp_path, monkeypatch):
    made, real = [], tables.working_folder
    monkeypatch.setattr(tables, "working_folder", lambda s: made.append(real(s)) or made[-1])
    path = tables.table_path(str(tmp_path), "t")
    for mode in ("keep", "upsert", "keep"):
        tables.write_table(spark.range(5), path, mode, ["id"])
    assert len(made) == 2 and not any(os.path.exists(m) for m in made)
