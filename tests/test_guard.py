"""What read-only and tenant SQL let through, judged on the analysed plan."""

import time
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablecare.plans import guarded_sql as g
from tablecare.sources import tables

CALL = "reflect('java.lang.System', 'setProperty', 'guarded', 'changed')"


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """A tenant's folder, and tables and views of others in the same catalogue."""
    data = str(tmp_path_factory.mktemp("tenant"))
    tables.write_table(spark.range(5).toDF("id"), tables.table_path(data, "mine"))
    tables.write_table(spark.range(7).toDF("id"), tables.table_path(data, "also"))
    other = tables.table_path(str(tmp_path_factory.mktemp("other")), "theirs")
    tables.write_table(spark.range(9).toDF("id"), other)
    name = f"other_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{other}'")
    spark.sql(f"CREATE VIEW {name}_view AS SELECT * FROM {name}")
    spark.range(3).createOrReplaceGlobalTempView(f"{name}_global")
    yield data, other, name
    spark.sql(f"DROP VIEW {name}_view")
    spark.sql(f"DROP TABLE {name}")
    spark.catalog.dropGlobalTempView(f"{name}_global")


WIDE = ", ".join(f"{k} AS c{k}" for k in range(40))

CALLS = [
    f"SELECT {WIDE}, {CALL} AS last",
    f"SELECT * FROM VALUES (1) AS t(a) WHERE {CALL} IS NULL",
    f"SELECT (SELECT max({CALL})) AS a",
    f"SELECT 1 WHERE EXISTS (SELECT {CALL})",
    f"SELECT 1 WHERE 1 IN (SELECT length({CALL}))",
    f"WITH t AS (SELECT {CALL} AS a) SELECT 1 FROM t",
    f"SELECT transform(array(1), x -> {CALL}) AS a",
    f"SELECT a, sum(a) OVER (ORDER BY {CALL}) FROM VALUES (1) AS t(a)",
    f"SELECT explode(array({CALL}))",
    f"SELECT * FROM VALUES (1) AS t(a), LATERAL (SELECT {CALL} AS b)",
    f"SELECT a FROM VALUES (1) AS t(a) GROUP BY a HAVING max({CALL}) = 'x'",
    f"SELECT a FROM VALUES (1) AS t(a) ORDER BY {CALL}",
    f"SELECT 1 UNION ALL SELECT length({CALL})",
    f"EXPLAIN SELECT {WIDE}, {CALL} AS last",
    "SELECT 7 WHERE `java_method`('java.lang.System', 'nanoTime') IS NULL",
    "SELECT try_reflect('java.lang.System', 'nanoTime')",
    "SELECT java_method('java.lang.System', 'nanoTime')",
    "SELECT TRANSFORM(a) USING 'cat' AS (b string) FROM VALUES (1) AS t(a)",
]


@pytest.mark.parametrize("sql", CALLS)
def test_no_code_runs(spark, sql):
    with pytest.raises((g.Rejected, AnalysisException)):
        g.readonly_frame(spark, sql).collect()
    assert spark._jvm.java.lang.System.getProperty("guarded") is None


def test_functions_of_users_are_refused(spark):
    spark.udf.register("guarded_udf", lambda x: x, "int")
    try:
        with pytest.raises(g.Rejected, match="UDF"):
            g.readonly_frame(spark, "SELECT guarded_udf(1)")
    finally:
        spark.sql("DROP TEMPORARY FUNCTION guarded_udf")


ALLOWED = [
    f"SELECT '{CALL.replace(chr(39), chr(34))}' AS a",
    "SELECT 'reflect(' AS a, \"java_method('x')\" AS b",
    f"SELECT {WIDE}",
    "WITH t AS (SELECT id FROM mine) SELECT a.id FROM t a JOIN also b ON a.id = b.id WHERE a.id IN (SELECT id FROM also)",
    "SELECT id, rank() OVER (ORDER BY id) r, (SELECT max(id) FROM also) m FROM mine ORDER BY id LIMIT 2 OFFSET 1",
    "SELECT id % 2 k, count(DISTINCT id) n FROM mine GROUP BY ROLLUP (id % 2) HAVING count(*) > 0",
    "SELECT * FROM (SELECT id, id % 2 k FROM mine) PIVOT (count(id) FOR k IN (0, 1))",
    "SELECT x FROM mine LATERAL VIEW explode(array(id, id)) e AS x",
    "SELECT id FROM mine INTERSECT SELECT id FROM also",
    "SELECT * FROM mine TABLESAMPLE (100 PERCENT)",
    "WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 5) SELECT * FROM r",
    "SELECT transform(array(1, 2), x -> x + 1), json_tuple('{\"a\":1}', 'a'), regexp_replace('a', 'a', 'b'), to_json(struct(1)), uuid() IS NULL",
    "TABLE mine",
    "VALUES (1), (2)",
    "EXPLAIN SELECT * FROM mine",
]


@pytest.mark.parametrize("sql", ALLOWED)
def test_reading_is_allowed(spark, shared, sql):
    assert g.tenant_sql(spark, shared[0], ["mine", "also"], sql).collect()


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT count(*) FROM {other}", "SELECT count(*) FROM default.{other}", "SELECT count(*) FROM spark_catalog.default.{other}", "SELECT * FROM {other}_view",
        "SELECT * FROM global_temp.{other}_global", "SELECT * FROM `global_temp`.`{other}_global`", "SELECT * FROM GLOBAL_TEMP . {other}_global", "SELECT * FROM parquet.`{path}`",
        "SELECT 1 FROM mine WHERE id = (SELECT max(id) FROM {other})", "WITH t AS (SELECT * FROM {other}) SELECT id FROM mine UNION SELECT id FROM t", "SELECT 1 WHERE EXISTS (TABLE {other})",
        "SHOW TABLES", "SHOW CREATE TABLE {other}", "EXPLAIN SELECT * FROM {other}", "SELECT * FROM mine, LATERAL (SELECT * FROM {other} o WHERE o.id = mine.id)",
    ],
)
def test_a_tenant_reads_nothing_of_others(spark, shared, sql):
    data, path, other = shared
    with pytest.raises(Exception) as raised:
        g.tenant_sql(spark, data, ["mine"], sql.format(other=other, path=path)).collect()
    assert isinstance(raised.value, g.Rejected) or "UNSUPPORTED_DATASOURCE" in str(raised.value) or "TABLE_OR_VIEW_NOT_FOUND" in str(raised.value)


def test_a_tenant_may_write_the_words(spark, shared):
    assert g.tenant_sql(spark, shared[0], ["mine"], "SELECT id AS global_temp FROM mine WHERE 'global_temp' <> ''").count() == 5


def test_the_console_reads_the_catalogue_but_no_files(spark, shared):
    _, path, other = shared
    for name in (other, f"default.{other}", f"{other}_view", f"global_temp.{other}_global"):
        assert g.run_readonly(spark, f"SELECT count(*) FROM {name}").rows in ([["9"]], [["3"]])
    with pytest.raises(g.Rejected, match="path"):
        g.readonly_frame(spark, f"SELECT * FROM parquet.`{path}`")
    assert g.run_readonly(spark, f"SHOW COLUMNS IN {other}").rows == [["id"]]


def test_rows_are_not_cut_silently(spark):
    for asked in (0, g.MAX_ROWS + 1):
        with pytest.raises(ValueError):
            g.bounded_query(spark, "SELECT * FROM range(9000)", asked)
        with pytest.raises(ValueError):
            g.run_readonly(spark, "SELECT * FROM range(9000)", asked)
    assert g.run_readonly(spark, "SELECT * FROM range(9000)", g.MAX_ROWS).truncated
    assert not g.run_readonly(spark, "SELECT * FROM range(5000)", g.MAX_ROWS).truncated


def test_a_long_statement_is_stopped(spark, shared):
    slow = "SELECT count(*) FROM range(40000000000) a WHERE id * 3 % 7 = 9 OR sha2(cast(id AS string), 256) = 'x'"
    start = time.perf_counter()
    with pytest.raises(g.TimedOut):
        g.run_readonly(spark, slow, seconds=2)
    with pytest.raises(g.TimedOut):
        g.run_tenant(spark, shared[0], ["mine"], slow, seconds=2)
    assert time.perf_counter() - start < 40
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
    assert spark.range(10).agg(F.sum("id")).first()[0] == 45
    assert g.run_tenant(spark, shared[0], ["mine"], "SELECT * FROM mine", max_rows=3).truncated


def test_a_statement_with_too_many_parts(spark, monkeypatch):
    monkeypatch.setattr(g, "MOST_NODES", 50)
    with pytest.raises(g.Rejected, match="50 parts"):
        g.readonly_frame(spark, f"SELECT {WIDE}, {WIDE.replace('c', 'd')}")
