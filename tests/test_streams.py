import os
import shutil
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablecare.operators import merging as m
from tablecare.streaming import jobs, log
from tests.conftest import SMALL

KEYS = ["user_id", "event_type"]


def newest_first():
    return [F.col("ts").desc(), F.col("event_id").desc()]


@pytest.fixture(scope="module")
def events(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture()
def source(spark, events, tmp_path):
    """The events as three files that arrive one by one, not in the order of time."""
    folder = tmp_path / "arriving"
    events.repartition(3, "event_id").write.parquet(str(folder))
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.fixture()
def place(tmp_path):
    return lambda: str(tmp_path / uuid.uuid4().hex)


def folders(folder):
    """Names of the bases and batches of a log."""
    return sorted(n for d in ("", "changes") if os.path.isdir(os.path.join(folder, "log", d)) for n in os.listdir(os.path.join(folder, "log", d)) if n.startswith(("base", "_batch")))


def test_upsert_reaches_the_batch_result(spark, events, source, place, rows):
    folder, state = place(), place()
    jobs.start_upsert(source, folder, state, KEYS, newest_first()).awaitTermination()
    expected = rows(m.one_per_key(events, KEYS, newest_first()))
    read = lambda: rows(jobs.current(spark, folder, KEYS, newest_first()).select(*events.columns))
    assert read() == expected and folders(folder) == ["_batch=0", "_batch=1", "_batch=2"]
    assert jobs.fold(spark, folder, KEYS, newest_first()) and read() == expected
    assert folders(folder) == ["base-00000001"] and not jobs.fold(spark, folder, KEYS, newest_first())


def test_a_folded_upsert_reads_few_folders_and_survives_replays(spark, events, source, place, rows):
    folder = place()
    jobs.start_upsert(source, folder, place(), KEYS, newest_first(), fold_every=2).awaitTermination()
    expected = rows(m.one_per_key(events, KEYS, newest_first()))
    read = lambda: rows(jobs.current(spark, folder, KEYS, newest_first()).select(*events.columns))
    assert folders(folder) == ["_batch=2", "base-00000001"] and read() == expected
    jobs.start_upsert(source, folder, place(), KEYS, newest_first(), fold_every=2).awaitTermination()  # all batches once more
    assert read() == expected and folders(folder) == ["_batch=2", "base-00000001"]


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["write_text_once", "delete", "list_names"])
def test_a_fold_that_dies_changes_nothing(spark, place, rows, monkeypatch, step):
    folder = place()
    store = log.BatchLog(spark, folder)
    for n in range(4):
        store.write(spark.range(n, n + 3).withColumn("n", F.lit(n)), n)
    newest = lambda df: m.one_per_key(df, ["id"], [F.col("n").desc()])
    read = lambda: rows(newest(store.read()).select("id", "n"))
    expected, calls, real = read(), [], getattr(log, step)

    def dying(*args, **kwargs):
        calls.append(args)
        if len(calls) > 2 or step != "list_names":
            raise Killed
        return real(*args, **kwargs)

    with pytest.raises(Killed), monkeypatch.context() as patched:
        patched.setattr(log, step, dying)
        store.fold(newest)
    assert read() == expected
    store.write(spark.range(1).withColumn("n", F.lit(9)), 4)
    assert store.fold(newest) and read() == sorted([(0, 9), *expected[1:]], key=repr)
    assert store.batches() == [] and len([f for f in os.listdir(folder) if f.startswith("base")]) <= 2


def test_writers_of_one_manifest(spark, place):
    path = f"{place()}/manifest/00000001.json"
    log.write_text_once(spark, path, "{}")
    with pytest.raises(FileExistsError):
        log.write_text_once(spark, path, "{}")
    assert os.listdir(os.path.dirname(path)) == ["00000001.json"] or all(".crc" in n or n == "00000001.json" for n in os.listdir(os.path.dirname(path)))


def arriving(spark, place, *batches, schema="id int, k string, ts timestamp, v int"):
    """A stream that reads one file per batch."""
    folder = place()
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{folder}/{n}")
    paths = [os.path.join(folder, str(n), f) for n in range(len(batches)) for f in os.listdir(os.path.join(folder, str(n))) if f.endswith(".parquet")]
    gathered = place()
    os.makedirs(gathered)
    for n, path in enumerate(paths):
        shutil.copy(path, f"{gathered}/{n}.parquet")
        os.utime(f"{gathered}/{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(gathered)


def day(n):
    return None if n is None else datetime(2024, 1, 1) + timedelta(days=n)


BATCHES = (
    [(1, "a", day(5), 1), (2, "a", day(3), 2), (3, "b", None, 3), (4, None, day(1), 4)],
    [(5, "a", day(1), 5), (6, "b", day(6), 6), (7, "c", None, 7), (8, "c", day(9), 8), (9, None, None, 9)],
    [(10, "a", day(60), 10), (11, "d", None, 11), (12, "d", None, 12), (13, "c", day(45), 13)],
)


@pytest.mark.parametrize("ttl, expected", [(None, [2, 3, 8, 11]), ("40 days", [2, 3, 8, 10, 11, 13])])
@pytest.mark.parametrize("fold_every", [1, 50])
def test_firsts_with_null_times_and_memory(spark, place, ttl, expected, fold_every):
    folder, source = place(), arriving(spark, place, *BATCHES)
    jobs.start_firsts(source, folder, place(), ["k"], "ts", ttl, fold_every=fold_every).awaitTermination()
    found = jobs.firsts(spark, folder)
    assert found.columns == ["id", "k", "ts", "v"]
    assert sorted(r["id"] for r in found.collect()) == expected
    assert sorted((r["id"], r["batch"]) for r in jobs.refused(spark, folder).collect()) == [(4, 0), (9, 1)]
    jobs.start_firsts(source, folder, place(), ["k"], "ts", ttl, fold_every=fold_every).awaitTermination()  # a replay of every batch
    assert sorted(r["id"] for r in jobs.firsts(spark, folder).collect()) == expected


def test_firsts_go_on_after_a_restart(spark, place, monkeypatch):
    folder, state, source = place(), place(), arriving(spark, place, *BATCHES)
    real = log.BatchLog.write

    def dying(self, frame, number):
        if number == 1:
            raise Killed
        real(self, frame, number)

    with monkeypatch.context() as patched, pytest.raises(Exception):
        patched.setattr(log.BatchLog, "write", dying)
        jobs.start_firsts(source, folder, state, ["k"], "ts").awaitTermination()
    jobs.start_firsts(source, folder, state, ["k"], "ts").awaitTermination()
    assert sorted(r["id"] for r in jobs.firsts(spark, folder).collect()) == [2, 3, 8, 11]


def test_an_endless_stream_takes_what_arrives(spark, place):
    folder, source = place(), arriving(spark, place, *BATCHES)
    query = jobs.start_upsert(source, folder, place(), ["k"], [F.col("id").desc()], trigger={"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
        assert query.isActive
        assert sorted((r["k"], r["id"]) for r in jobs.current(spark, folder, ["k"], [F.col("id").desc()]).collect()) == [("a", 10), ("b", 6), ("c", 13), ("d", 12)]
        assert jobs.refused(spark, folder).count() == 2
    finally:
        query.stop()


def test_keep_first_lets_whole_rows_through_once(spark, events, source, place, rows):
    folder = place()
    jobs.start_firsts(source, folder, place(), KEYS, "ts", order=["ts", "event_id"]).awaitTermination()
    found = jobs.firsts(spark, folder)
    assert rows(found.select(*KEYS)) == rows(events.select(*KEYS).distinct())
    assert found.join(events, events.columns, "left_anti").count() == 0


def test_native_keep_first_lets_each_key_through_once(spark, events, source, place, rows):
    folder = place()
    passed = jobs.keep_first_stream(source, KEYS, "ts", "40 days").writeStream.format("parquet").option("path", folder)
    passed.option("checkpointLocation", place()).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(folder).select(*KEYS)) == rows(events.select(*KEYS).distinct())


def test_slow_monitor_equals_batch_up_to_the_watermark(spark, events, source, place, rows):
    folder = place()
    jobs.start_slow_monitor(source, folder, place(), "ts", "event_type", "value", "40 days", 100).awaitTermination()
    written = spark.read.parquet(folder)
    assert written.count() == 0
    folder = place()
    closing = events.limit(1).withColumns({"ts": F.lit("2024-12-31").cast("timestamp"), "value": F.lit(0.0)})
    arriving = place()
    events.repartition(3, "event_id").unionByName(closing).write.parquet(arriving)
    again = spark.readStream.schema(events.schema).parquet(arriving)
    jobs.start_slow_monitor(again, folder, place(), "ts", "event_type", "value", "40 days", 100).awaitTermination()
    batch = jobs.slow_windows(events, "ts", "event_type", "value", 100)
    assert rows(spark.read.parquet(folder)) == rows(batch)
