import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecare.operators import conforming as cf
from tablecare.operators import health
from tablecare.plans import guarded_sql as g
from tablecare.plans import repair as repairs
from tablecare.plans import reports
from tablecare.sources import copying, history, inventory, reconciling, tables
from tablecare.session import shuffle_partitions
from tablecare.spec import ColumnSpec, ForeignKey, TableSpec
from tests.conftest import final_plan, plan_of


@pytest.fixture()
def folder(tmp_path):
    def make(name="data"):
        return str(tmp_path / f"{name}-{uuid.uuid4().hex[:6]}")

    return make


ITEM = TableSpec("item", (ColumnSpec("id", T.LongType(), False), ColumnSpec("name", T.StringType())), ("id",))
LINK = TableSpec(
    "link",
    (ColumnSpec("parent", T.LongType(), False), ColumnSpec("sort", T.IntegerType(), False)),
    ("parent", "sort"),
    foreign_keys=(ForeignKey(("parent",), "item", ("id",)),),
)


ORDERS = {"item": ["name"], "link": []}


def source_of(spark, folder, links=(("1", "0"), ("1", "1"), ("9", "0"))):
    source = folder("source")
    items = spark.createDataFrame([("1", "one"), ("2", "two"), ("x", "bad")], "ID string, name string")
    tables.write_table(items, tables.table_path(source, "item"))
    made = spark.createDataFrame(list(links), "parent string, sort string")
    tables.write_table(made, tables.table_path(source, "link"))
    return source


def test_copy_twice_is_copy_once(spark, folder, rows):
    source, target = source_of(spark, folder), folder("target")
    for mode in ("reload", "reload", "keep"):
        report = copying.copy_dataset(spark, source, target, [ITEM, LINK], mode, order=ORDERS)
        assert rows(tables.read_table(spark, target, "item")) == [(1, "one"), (2, "two")]
        assert rows(tables.read_table(spark, target, "link")) == [(1, 0), (1, 1)]
    lines = {r["table"]: r for r in report.collect()}
    assert (lines["item"]["read"], lines["item"]["written"], lines["item"]["rejected"]) == (3, 0, 1)


def test_copy_counts_and_order(spark, folder, rows):
    source, target = folder("source"), folder("target")
    items = [("1", "b"), ("1", "a"), ("2", None), ("2", "z"), ("x", "bad"), (None, "none")]
    tables.write_table(spark.createDataFrame(items, "id string, name string"), tables.table_path(source, "item"))
    links = [("1", "0"), ("1", "0"), ("9", "0"), ("2", "y"), ("2", None)]
    tables.write_table(spark.createDataFrame(links, "parent string, sort string"), tables.table_path(source, "link"))
    loose = TableSpec("link", (LINK.columns[0], ColumnSpec("sort", T.IntegerType())), LINK.key, foreign_keys=LINK.foreign_keys)
    order = {"item": [F.col("name").desc_nulls_last()], "link": []}
    with pytest.raises(ValueError, match="order"):
        copying.copy_dataset(spark, source, target, [ITEM, loose], order={"item": []})
    report = {r["table"]: r for r in copying.copy_dataset(spark, source, target, [ITEM, loose], order=order).collect()}
    counts = lambda name: {c: report[name][c] for c in copying.COUNTS}
    assert counts("item") == {"read": 6, "rejected": 2, "refused": 2, "null_keys": 0, "orphaned": 0, "repeated": 2, "stored": 0, "written": 2, "skipped": 4}
    assert counts("link") == {"read": 5, "rejected": 1, "refused": 0, "null_keys": 2, "orphaned": 1, "repeated": 1, "stored": 0, "written": 1, "skipped": 4}
    assert rows(tables.read_table(spark, target, "item")) == [(1, "b"), (2, "z")]
    again = copying.copy_dataset(spark, source, target, [ITEM, loose], "keep", order=order).collect()
    assert [(r["table"], r["stored"], r["written"]) for r in again] == [("item", 2, 0), ("link", 1, 0)]


def test_copy_goes_on_where_it_stopped(spark, folder, monkeypatch, rows):
    source, target = source_of(spark, folder), folder("target")
    whole, seen = copying.coerce, []

    def watched(df, spec, fails=()):
        seen.append(spec.name)
        if spec.name in fails:
            raise RuntimeError("disk gone")
        return whole(df, spec)

    copy = lambda **k: {r["table"]: r["status"] for r in copying.copy_dataset(spark, source, target, [ITEM, LINK], order=ORDERS, **k).collect()}
    monkeypatch.setattr(copying, "coerce", lambda df, spec: watched(df, spec, ("link",)))
    with pytest.raises(copying.CopyFailed):
        copy()
    monkeypatch.setattr(copying, "coerce", watched)
    seen.clear()
    assert copy(resume=True) == {"item": "unchanged", "link": "copied"} and seen == ["link"]
    seen.clear()
    assert copy(resume=True) == {"item": "unchanged", "link": "unchanged"} and seen == []
    tables.write_table(spark.createDataFrame([("9", "nine")], "ID string, name string"), tables.table_path(source, "item"))
    assert copy(resume=True) == {"item": "copied", "link": "copied"}
    assert rows(tables.read_table(spark, target, "link")) == [(9, 0)]


def test_copy_records_a_failing_table_and_goes_on(spark, folder, monkeypatch):
    source, target = source_of(spark, folder), folder("target")
    whole = copying.coerce

    def failing(df, spec):
        if spec.name == "item":
            raise RuntimeError("disk gone")
        return whole(df, spec)

    monkeypatch.setattr(copying, "coerce", failing)
    with pytest.raises(copying.CopyFailed, match="item") as caught:
        copying.copy_dataset(spark, source, target, [ITEM, LINK], order=ORDERS)
    states = {r["table"]: r["status"] for r in caught.value.report.collect()}
    assert states == {"item": "failed", "link": "copied"}


def test_copy_checks_before_it_writes(spark, folder):
    source, target = source_of(spark, folder), folder("target")
    strict = TableSpec("link", (*LINK.columns, ColumnSpec("kind", T.StringType(), False)), LINK.key)
    with pytest.raises(ValueError, match="kind"):
        copying.copy_dataset(spark, source, target, [ITEM, strict], order=ORDERS)
    assert not tables.exists(spark, target)
    with pytest.raises(ValueError, match="no table"):
        copying.copy_dataset(spark, source, target, [TableSpec("other", ITEM.columns)], order={})


def test_a_table_may_replace_itself(spark, folder, rows):
    path = tables.table_path(folder(), "t")
    tables.write_table(spark.range(5).toDF("id"), path)
    tables.replace_table(spark.read.parquet(path).where("id > 2"), path)
    assert rows(spark.read.parquet(path)) == [(3,), (4,)]


def test_keep_appends_only_new_files(spark, folder, rows):
    path = tables.table_path(folder(), "t")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    tables.write_table(first, path, "keep", ["id"])
    before = set(tables.list_names(spark, path))
    tables.write_table(spark.createDataFrame([(2, "x"), (3, "d")], "id int, v string"), path, "keep", ["id"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "c"), (3, "d")]
    assert before < set(tables.list_names(spark, path))
    newer = spark.createDataFrame([(2, "y"), (2, "z"), (9, None)], "id int, v string")
    tables.write_table(newer, path, "upsert", ["id"], [F.col("v").desc()])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "z"), (3, "d"), (9, None)]
    with pytest.raises(ValueError):
        tables.write_table(first, path, "other")


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0, 8) == 16 and shuffle_partitions(1 << 40, 8) == 4096
    assert shuffle_partitions(100 << 40, 8000) == 50_000


def test_purge_snapshot_restore(spark, folder, rows):
    data, root = folder(), folder("root")
    tables.write_table(spark.range(4).toDF("id"), tables.table_path(data, "a"))
    tables.write_table(spark.range(2).toDF("id"), tables.table_path(data, "b"))
    taken = tables.snapshot(spark, data, root, "mine", datetime(2024, 1, 2, 3, 4, 5))
    assert taken.endswith("mine_20240102_030405") and tables.list_snapshots(spark, root) == ["mine_20240102_030405"]
    assert rows(tables.purge(spark, data, ["a", "b"])) == [("a", 4), ("b", 2)]
    empty = tables.read_table(spark, data, "a")
    assert empty.count() == 0 and empty.columns == ["id"]
    assert tables.restore(spark, taken, data) == ["a", "b"]
    assert tables.read_table(spark, data, "a").count() == 4
    with pytest.raises(FileExistsError):
        tables.snapshot(spark, data, root, "mine", datetime(2024, 1, 2, 3, 4, 5))


def test_repair_compacts_and_moves_marks_once(spark, folder, rows):
    data = folder()
    log = spark.createDataFrame([(i % 10, i) for i in range(100)], "k int, version int")
    tables.write_table(log, tables.table_path(data, "log"))
    tables.write_table(spark.createDataFrame([("log", 5)], "table string, last_value bigint"), tables.table_path(data, "marks"))
    logs = {"log": (["k"], [F.col("version").desc()]), "absent": (["k"], [])}
    first = repairs.repair(spark, data, logs, "marks", {"log": "version"}, dead_over=10)
    assert rows(first, "action", "target", "ok") == [
        ("compact", "absent", False), ("compact", "log", True), ("move mark", "log", True),
    ]
    assert rows(tables.read_table(spark, data, "log")) == [(k, 90 + k) for k in range(10)]
    assert rows(tables.read_table(spark, data, "marks")) == [("log", 99)]
    del logs["absent"]
    assert repairs.repair(spark, data, logs, "marks", {"log": "version"}, dead_over=10).count() == 0


def test_history_rule(frame, rows):
    ids = ["20240101000000_Known", "202401010000001_Known", "2024010100000_Known", "20240101000000_Other", "x_Known", "20240101000000_"]
    source = frame([(i, "9.0.0") for i in ids], "migration_id string, product_version string")
    stored = frame([("20240101000000_Known", "8")], "migration_id string, product_version string")
    made = history.copy_allowed(source, frame([("Known",)], "name string"), stored)
    assert rows(made) == [("202401010000001_Known", "9.0.0"), ("20240101000000_Known", "8")]


def test_reconcile(frame, rows):
    a = frame([(1, "x"), (2, None), (3, "z")], "id int, v string")
    b = frame([(2, None), (3, "Z"), (4, "n")], "id int, v string")
    for by in ("values", "fingerprint"):
        assert rows(reconciling.reconcile_rows(a, b, ["id"], by)) == [(1, "missing"), (3, "changed"), (4, "extra")]
    twice = reconciling.reconcile_multiset(a.unionAll(a), b)
    assert rows(twice, "id", "status", "copies") == [
        (1, "missing", 2), (2, "missing", 1), (3, "extra", 1), (3, "missing", 2), (4, "extra", 1),
    ]
    counts = reconciling.reconcile_counts({"t": a, "u": a}, {"t": b})
    assert rows(counts) == [("t", 3, 3, 0), ("u", 3, 0, -3)]


def test_profile_of_odd_columns(spark, folder):
    df = spark.createDataFrame(
        [(0.0, [1], b"a"), (-0.0, None, b"b"), (float("nan"), [1], None)], "x double, a array<int>, b binary"
    )
    for kind in ("exact", "approx"):
        made = {r["column"]: r for r in inventory.column_profile(df, "t", kind).collect()}
        assert made["x"]["distinct_values"] == 2 and made["a"]["nulls"] == 1
        assert made["b"]["distinct_values"] == 2 and made["a"]["min_value"] is None
    empty = inventory.column_profile(df.limit(0), "t").collect()
    assert [r["distinct_values"] for r in empty] == [0, 0, 0]


def test_merged_profile_equals_the_whole(spark):
    rows = [(k if k % 7 else None, (k % 13) / 4 - 1, f"t{k % 50}" if k % 5 else None, Decimal(k) / 3 if k % 2 else None, k % 3 == 0, datetime(2024, 1, 1 + k % 28), datetime(2024, 1, 1 + k % 28).date(), [k], -(2**62) + k) for k in range(2000)]
    df = spark.createDataFrame(rows, "i int, x double, s string, d decimal(20,6), b boolean, t timestamp, day date, a array<int>, big bigint")
    whole = {r["column"]: r.asDict() for r in inventory.column_profile(df, "t").collect()}
    parts = inventory.profile_parts(df, "t", F.col("x"))
    assert parts.select("part").distinct().count() == 13
    for made in (inventory.merged_profile(parts), inventory.merged_profile(inventory.profile_parts(df, "t"))):
        for line in made.collect():
            expected = whole[line["column"]]
            assert {k: v for k, v in line.asDict().items() if k != "distinct_values"} == {k: v for k, v in expected.items() if k != "distinct_values"}
            assert abs(line["distinct_values"] - expected["distinct_values"]) <= 0.03 * expected["distinct_values"]


def test_bounds_of_parts_are_made_once_per_part(spark):
    """Texts and decimals of bounds come after the aggregation, and -0.0 stands before 0.0."""
    df = spark.createDataFrame([(0.0, 5, datetime(2024, 1, 2)), (-0.0, -7, datetime(2024, 1, 1)), (None, None, None)], "z double, i long, t timestamp_ntz")
    made = {r["column"]: (r["min_value"], r["max_value"]) for r in inventory.merged_profile(inventory.profile_parts(df.unionAll(df.orderBy("z")), "t")).collect()}
    assert made == {"z": ("-0.0", "0.0"), "i": ("-7", "5"), "t": ("2024-01-01 00:00:00", "2024-01-02 00:00:00")}
    partial = [line for line in inventory.profile_parts(df, "t")._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in line]
    assert partial and not any("date_format" in line.lower() or "decimal(38,18)" in line for line in partial)


def test_refreshed_profile_reads_new_files_only(spark, folder):
    data, parts = folder(), folder()
    spark.range(100).repartition(2).write.parquet(data)
    assert inventory.refresh_profile(spark, data, "t", parts).first()["max_value"] == "99"
    assert spark.read.parquet(parts).count() == 2
    spark.range(100, 300).coalesce(1).write.mode("append").parquet(data)
    line = inventory.refresh_profile(spark, data, "t", parts).first()
    assert (line["min_value"], line["max_value"], line["nulls"]) == ("0", "299", 0) and spark.read.parquet(parts).count() == 3
    assert inventory.refresh_profile(spark, data, "t", parts).first()["distinct_values"] == 300 and spark.read.parquet(parts).count() == 3
    spark.range(5).coalesce(1).write.mode("overwrite").parquet(data)
    assert inventory.refresh_profile(spark, data, "t", parts).first()["max_value"] == "4"


def test_a_task_of_a_distinct_count_holds_one_column(spark):
    rows = [(k, k % 3, f"t{k % 5}" if k % 2 else None, -0.0 if k % 2 else 0.0, float("nan"), k % 2 == 0, datetime(2024, 1, 1 + k % 9), Decimal(k % 4)) for k in range(40)]
    df = spark.createDataFrame(rows, "i long, j int, s string, z double, n float, b boolean, t timestamp_ntz, d decimal(20,2)")
    made = inventory.column_profile(df, "t")
    assert [r["distinct_values"] for r in made.orderBy("position").collect()] == [40, 3, 5, 1, 1, 2, 9, 4]
    assert "Generate" not in plan_of(inventory._distinct_counts(df))


def test_exact_distinct_counts_shuffle_hashes(spark):
    df = spark.range(10).select(F.repeat(F.col("id").cast("string"), 1000).alias("long"), "id")
    made = inventory.column_profile(df, "t")
    assert [r["distinct_values"] for r in made.orderBy("position").collect()] == [10, 10]
    shuffled = [line for line in final_plan(made).split("\n") if "Exchange hashpartitioning" in line]
    assert shuffled and not any("long" in line for line in shuffled)


def test_reconcile_by_bucket_reads_what_differs(spark, rows):
    source = spark.range(20_000).select("id", (F.col("id") % 7).alias("n"), F.map_from_arrays(F.array(F.lit("k")), F.array("id")).alias("m"), F.when(F.col("id") % 11 != 0, "x").alias("z"))
    copy = source.where("id <> 70").withColumn("n", F.when(F.col("id") == 500, None).otherwise(F.col("n"))).unionAll(source.limit(1).withColumn("id", F.lit(-1).cast("long")))
    plain = copy.select("z", "m", "n", "id")
    assert rows(reconciling.reconcile_by_bucket(source.drop("m"), plain.drop("m"), ["id"], 64)) == sorted([(-1, "extra"), (70, "missing"), (500, "changed")], key=repr)
    left, right = reconciling.suspects(source, plain, ["id"], 64)
    assert left.count() + right.count() < 100
    assert [side.count() for side in reconciling.suspects(source, source.repartition(5), ["id"])] == [0, 0]
    keyless = spark.createDataFrame([(None, 1), (None, 2), (1, 1)], "k int, v int")
    assert reconciling.suspects(keyless, keyless.where("v = 1"), ["k"])[0].count() >= 2


WIDE = TableSpec(
    "t",
    (ColumnSpec("id", T.LongType()), ColumnSpec("note", T.StringType()), ColumnSpec("rank", T.IntegerType(), False, default=3)),
)


def test_conform_heals_once(spark):
    made = cf.conform(spark.range(2), WIDE)
    assert made.outcome == "healed" and [tuple(r) for r in made.df.collect()] == [(0, None, 3), (1, None, 3)]
    assert cf.conform(made.df, WIDE).outcome == "in_sync"
    assert cf.conform(made.df, WIDE, baseline=TableSpec("t", WIDE.columns[:1])).outcome == "already_healed"
    assert cf.conform(spark.range(2), WIDE, "report").outcome == "detected"
    assert cf.conform(spark.range(2), WIDE, "off").outcome == "disabled"


@pytest.mark.parametrize(
    "columns, kind",
    [
        ([ColumnSpec("id", T.LongType()), ColumnSpec("must", T.StringType(), False)], "add column"),
        ([ColumnSpec("note", T.StringType())], "drop column"),
        ([ColumnSpec("id", T.StringType()), ColumnSpec("note", T.StringType())], "retype column"),
        ([ColumnSpec("ID", T.LongType()), ColumnSpec("note", T.StringType())], "rename column"),
    ],
)
def test_one_unsafe_difference_blocks_all(spark, columns, kind):
    spec = TableSpec("t", (*columns, ColumnSpec("extra", T.StringType())))
    made = cf.conform(spark.range(2), spec)
    assert made.outcome == "blocked" and made.df.columns == ["id"]
    assert kind in [o.kind for o in made.operations if not o.safe]


def test_new_keys_block(spark):
    keyed = TableSpec("t", WIDE.columns, ("id",), unique=(("note",),), foreign_keys=(ForeignKey(("rank",), "u", ("id",)),))
    extra = cf.key_differences(WIDE, keyed)
    assert [o.kind for o in extra] == ["add unique key", "add foreign key", "change key"]
    assert cf.conform(spark.range(2), WIDE, extra=extra).outcome == "blocked"


def test_probes_find_what_types_do_not_show(spark):
    spec = TableSpec("t", (ColumnSpec("id", T.LongType(), False), ColumnSpec("note", T.StringType(), max_length=2)), ("id",))
    rows = [(1, "ab"), (1, "abc"), (None, "x"), (2, None)]
    df = spark.createDataFrame(rows, "id long, note string")
    assert cf.conform(df, spec).outcome == "in_sync"
    made = cf.conform(df, spec, probe=True)
    assert made.outcome == "blocked" and [(o.kind, o.column, o.rows) for o in made.operations] == [
        ("tighten: duplicate key", "id", 1), ("tighten: null value", "id", 1), ("tighten: too long", "note", 1),
    ]
    assert cf.conform(df.where("id = 2"), spec, probe=True).outcome == "in_sync"


def test_the_ledger_records_what_was_healed(spark, folder):
    ledger, at = f"{folder()}/ledger", datetime(2024, 5, 1)
    data = spark.range(2)
    assert cf.conform_recorded(data, WIDE, ledger, at, "report").outcome == "detected" and cf.applied(spark, ledger).count() == 0
    for outcome in ("healed", "already_healed"):
        made = cf.conform_recorded(data, WIDE, ledger, at)
        assert made.outcome == outcome and [tuple(r) for r in made.df.collect()] == [(0, None, 3), (1, None, 3)]
    assert sorted((r["column"], r["applied_at"]) for r in cf.applied(spark, ledger).collect()) == [("note", at), ("rank", at)]
    other = TableSpec("u", WIDE.columns)
    assert cf.conform_recorded(data, other, ledger, at).outcome == "healed" and cf.applied(spark, ledger).count() == 4
    strict = TableSpec("t", (*WIDE.columns, ColumnSpec("must", T.StringType(), False)))
    assert cf.conform_recorded(data, strict, ledger, at).outcome == "blocked" and cf.applied(spark, ledger).count() == 4


def test_conform_dataset_adds_tables(spark):
    other = TableSpec("new", (ColumnSpec("k", T.StringType()),))
    healed, operations, outcome = cf.conform_tables({"t": spark.range(2)}, [WIDE, other])
    assert outcome == "healed" and healed["new"].count() == 0 and len(healed["t"].columns) == 3
    bad = TableSpec("t", (ColumnSpec("id", T.StringType()),))
    same, _, outcome = cf.conform_tables({"t": spark.range(2)}, [bad, other])
    assert outcome == "blocked" and set(same) == {"t"}


BODIES = {"SELECT": "SELECT n_name FROM nation", "WITH": "WITH k AS (SELECT 7 AS seven) SELECT seven FROM k", "TABLE": "TABLE nation", "VALUES": "VALUES (7)", "EXPLAIN": "EXPLAIN SELECT 7", "SHOW": "SHOW TABLES"}
WRAPPERS = ["{}", "  {} ; ", "/* why */ {}", "{} -- tail; end", "\n{}\n"]
HIDING = ["'{}'", '"{}"', "`{}`", "a_{}", "{}_at"]


@pytest.mark.parametrize("starter", g.STARTERS)
@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_reading_statements_pass(starter, wrapper):
    assert g.check_readonly(wrapper.format(BODIES[starter]))


@pytest.mark.parametrize("word", g.BLOCKED)
def test_blocked_words_count_outside_of_names_and_literals(word):
    for hidden in HIDING:
        assert g.check_readonly(f"SELECT {hidden.format(word)} FROM nation")
    for shape in ("{} nation", "SELECT 7; {} nation", "SELECT 7 {} nation", "-- x\n{} nation", "/* x */ {} nation", "WITH k AS (SELECT 7) {} k"):
        for form in (word, word.lower()):
            with pytest.raises(g.Rejected):
                g.check_readonly(shape.format(form))


@pytest.mark.parametrize("sql", ["", " \t", "--", ";;", "SELECT 7; SELECT 8", "SELECT $q$;$q$", "/* a /* b */ */ SELECT 7", "USE x", "CACHE TABLE x", "ADD FILE x", "LOAD DATA INPATH 'x' INTO TABLE y"])
def test_other_statements_are_rejected(sql):
    with pytest.raises(g.Rejected):
        g.check_readonly(sql)


def test_console(spark):
    spark.range(20).withColumn("a", F.array("id")).createOrReplaceTempView("console_items")
    result = g.run_readonly(spark, "SELECT id, a, binary('ab') AS b, timestamp '2024-01-02 03:04:05' AS t FROM console_items ORDER BY id; ", 3)
    assert result.columns == ["id", "a", "b", "t"] and result.truncated
    assert result.rows[1] == ["1", "[1 items]", "byte[2]", "2024-01-02 03:04:05.000"]
    assert not g.run_readonly(spark, "TABLE console_items", 20).truncated
    assert "Physical Plan" in g.run_readonly(spark, "SELECT * FROM console_items", explain=True).rows[0][0]
    assert "Physical Plan" in g.run_readonly(spark, "EXPLAIN EXTENDED SELECT * FROM console_items").rows[0][0]
    assert g.run_readonly(spark, "SHOW TABLES").columns
    assert g.run_readonly(spark, "VALUES (1), (2)").rows == [["1"], ["2"]]


def test_reading_cannot_write(spark, folder):
    path = tables.table_path(folder(), "t")
    tables.write_table(spark.range(3).toDF("id"), path)
    spark.read.parquet(path).createOrReplaceTempView("guarded")
    for sql in ("INSERT INTO guarded VALUES (9)", "WITH x AS (SELECT 9L AS id) INSERT INTO guarded SELECT id FROM x"):
        with pytest.raises(g.Rejected):
            g.run_readonly(spark, sql)
    assert spark.read.parquet(path).count() == 3


def test_a_tenant_sees_its_own_tables_only(spark, folder):
    data = folder()
    tables.write_table(spark.range(5).toDF("id"), tables.table_path(data, "mine"))
    spark.range(3).createOrReplaceTempView("foreign_view")
    assert g.tenant_sql(spark, data, ["mine"], "SELECT count(*) FROM mine WHERE id >= :low", {"low": 2}).first()[0] == 3
    with pytest.raises(Exception, match="foreign_view"):
        g.tenant_sql(spark, data, ["mine"], "SELECT * FROM foreign_view").collect()
    other = folder()
    tables.write_table(spark.range(9), tables.table_path(other, "theirs"))
    with pytest.raises(Exception, match="theirs"):
        g.tenant_sql(spark, data, ["mine"], f"SELECT * FROM parquet.`{tables.table_path(other, 'theirs')}`").collect()
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        g.tenant_sql(spark, data, ["mine"], "SELECT * FROM GLOBAL_TEMP.x")


def test_report_survives_a_check_that_fails_while_running(spark):
    def failing():
        return reports.finding(spark.range(1), "late", "ok", F.raise_error(F.lit("boom")), F.lit("x"))

    def fine():
        return reports.finding(spark.range(2), "fine", "warn", F.lit("m"), F.col("id"))

    found = reports.health_report(spark, {"late": failing, "fine": fine})
    summary = reports.summarise(found).first()
    assert (summary["findings"], summary["errors"], summary["warnings"], summary["worst"]) == (3, 1, 2, "error")
    assert reports.summarise(reports.health_report(spark, {})).first()["worst"] == "ok"


def test_slow_report_with_rows_and_hits(frame):
    log = frame([("q" * 130, 600.0, 10, 3, 1)] * 3 + [("fast", 1.0, 1, 0, 0)] * 3, "sql string, ms double, n int, hit int, miss int")
    row = health.slow_report(log, "sql", "ms", rows="n", hits="hit", reads="miss").collect()
    assert len(row) == 1 and row[0]["severity"] == "warn" and row[0]["preview"] == "q" * 120 + "…" and row[0]["sql"] == "q" * 130
    assert (row[0]["calls"], row[0]["mean_ms"], row[0]["avg_rows"], row[0]["hit_pct"]) == (3, 600.0, 10.0, 75.0)


def test_refresh_policy_floor_division(frame):
    stats = frame([(10_009, 1000, 2001), (100_009, 10_000, 20_000), (-1, 999, 1000)], "n_rows bigint, changed bigint, dead bigint")
    made = [(r["needs_refresh"], r["needs_compaction"]) for r in health.refresh_policy(stats).orderBy("n_rows").collect()]
    assert made == [(False, True), (True, True), (True, False)]


def test_stale_and_high_water(frame, rows):
    df = frame([("a", "2024-01-01"), ("b", "2024-01-31"), ("c", None)], "g string, day string").withColumn("day", F.col("day").cast("timestamp"))
    assert rows(health.stale_groups(df, ["g"], "day", "2024-02-01", min_rows=1), "g") == [("a",), ("c",)]
    marks = frame([("t", 3), ("e", 0)], "table string, last_value bigint")
    data = {"t": (frame([(5,)], "id int"), "id"), "e": (frame([], "id int"), "id")}
    assert rows(health.high_water_drift(marks, data)) == [("t", "id", 3, 5)]
