"""Read-only SQL with a bound on rows and time, and SQL over one tenant's tables.

A statement is first read as text (one statement, a reading verb, no blocked word outside literals), then analysed by Spark as a
subquery, where the grammar admits nothing but a query, and the analysed plan is visited: every operator must be on a list of reading
ones, every relation must be one that the caller may see, and no expression may call code from outside Spark's own functions. Nothing of
the statement has run by then. Views are trusted: who may define them decides what they hold.
"""

from __future__ import annotations

import re
import threading
import uuid
from contextlib import contextmanager
from typing import Any, Collection, Iterator, Mapping, NamedTuple

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecare.functions.text import console_text
from tablecare.sources.tables import read_table

# Rows and seconds that one statement may take.
MAX_ROWS = 5000
MAX_SECONDS = 30

MOST_NODES = 20_000
"""Operators and expressions of a plan that are visited; a statement with more is refused."""

# Words a statement may start with, and words it may not hold outside literals.
STARTERS = ("SELECT", "WITH", "TABLE", "VALUES", "EXPLAIN", "SHOW")
BLOCKED = (
    "INSERT UPDATE DELETE MERGE TRUNCATE DROP ALTER CREATE GRANT REVOKE COPY VACUUM ANALYZE REINDEX CLUSTER "
    "REFRESH CALL DO SET RESET LOCK COMMIT ROLLBACK BEGIN SAVEPOINT DISCARD LISTEN NOTIFY IMPORT REASSIGN "
    "CHECKPOINT ATTACH DETACH PREPARE EXECUTE DEALLOCATE INTO SECURITY REPLACE"
).split()

_SKIPPED = re.compile(
    r"""--[^\n]*                      # line comment
      | /\*.*?\*/                     # block comment
      | [rR]'[^']*' | [rR]"[^"]*"     # raw literal
      | '(?:\\.|[^'\\])*'             # literal
      | "(?:\\.|[^"\\])*"             # literal or quoted name
      | `(?:``|[^`])*`                # quoted name
    """,
    re.VERBOSE | re.DOTALL,
)
_DOLLAR = re.compile(r"\$[A-Za-z_]*\$")
_BLOCKED = re.compile(r"\b(" + "|".join(BLOCKED) + r")\b", re.IGNORECASE)


class Rejected(ValueError):
    """The statement is empty, not read-only, more than one, or reaches for what it may not see."""


class TimedOut(RuntimeError):
    """The statement took longer than it may; its jobs are cancelled."""


def _without(sql: str, literals: bool) -> str:
    """``sql`` with comments blanked, and with ``literals`` quoted text emptied too."""

    def blank(found: re.Match) -> str:
        piece = found.group()
        if piece.startswith(("--", "/*")):
            return " "
        return "''" if literals else piece

    return _SKIPPED.sub(blank, sql)


def check_readonly(sql: str) -> str:
    """The statement without comments and trailing semicolon, if it only reads; else ``Rejected``."""
    statement = _without(sql or "", literals=False).strip()
    if not statement:
        raise Rejected("the statement is empty")
    if _DOLLAR.search(statement):
        raise Rejected("dollar quotes are not allowed")
    masked = _without(sql, literals=True).strip().rstrip("; \t\r\n")
    if "/*" in masked or "*/" in masked:
        raise Rejected("nested or open comments are not allowed")
    if ";" in masked:
        raise Rejected("only one statement is allowed")
    first = re.match(r"[(\s]*([A-Za-z_]*)", masked).group(1).upper()
    if first not in STARTERS:
        raise Rejected(f"only {', '.join(STARTERS)} are allowed, not '{first}'")
    blocked = _BLOCKED.search(masked)
    if blocked:
        raise Rejected(f"'{blocked.group().upper()}' is blocked")
    return statement.rstrip("; \t\r\n")


_OPERATORS = frozenset(
    "Project Filter Aggregate Join LateralJoin AsOfJoin Sort GlobalLimit LocalLimit LimitAndOffset Offset Tail Distinct Deduplicate Union "
    "Intersect Except Window WithWindowDefinition Expand Generate SubqueryAlias WithCTE CTERelationDef CTERelationRef UnionLoop UnionLoopRef "
    "Sample Pivot Unpivot Repartition RepartitionByExpression RebalancePartitions ResolvedHint LocalRelation OneRowRelation Range View".split()
)
"""Operators that only read and compute. Scripts, commands, Python table functions and relations are not among them."""

_TABLES = frozenset("LogicalRelation HiveTableRelation DataSourceV2Relation StreamingRelation".split())

_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."

_FOREIGN = frozenset(
    "CallMethodViaReflection TryReflect ScalaUDF ScalaUDAF PythonUDF PythonUDAF PythonUDTF ApplyFunctionExpression V2Aggregator "
    "FromProtobuf ToProtobuf FromAvro ToAvro SchemaOfAvro".split()
)
"""Expressions of Spark's own package that call methods by name, functions of users, or read descriptor files."""


class _Visitor:
    """Walks an analysed plan with its expressions and subqueries, and refuses what is not on the lists.

    ``views`` are the temporary views that may be read; None admits every view and every table of the catalogue.
    """

    def __init__(self, spark: SparkSession, views: Collection[str] | None) -> None:
        self._gateway = spark.sparkContext._gateway
        self._views = None if views is None else {v.lower() for v in views}

    def check(self, plan: JavaObject) -> None:
        """Raise ``Rejected`` for the first operator, relation or expression that may not be there."""
        waiting, seen = [(plan, True)], 0
        while waiting:
            node, is_plan = waiting.pop()
            seen += 1
            if seen > MOST_NODES:
                raise Rejected(f"the statement has more than {MOST_NODES} parts")
            waiting += self._operator(node) if is_plan else self._expression(node)

    @staticmethod
    def _all(sequence: JavaObject) -> list[JavaObject]:
        return [sequence.apply(i) for i in range(sequence.size())]

    def _operator(self, node: JavaObject) -> list[tuple[JavaObject, bool]]:
        name = node.getClass().getSimpleName()
        if name in _TABLES:
            return self._table(node, name)
        if name not in _OPERATORS:
            raise Rejected(f"'{name}' is not allowed")
        if name == "View":
            return self._view(node)
        return [(c, True) for c in self._all(node.children())] + [(e, False) for e in self._all(node.expressions())]

    def _table(self, node: JavaObject, name: str) -> list:
        if self._views is not None:
            raise Rejected("only the given tables can be read")
        if name == "LogicalRelation" and node.catalogTable().isEmpty():
            raise Rejected("files cannot be read by their path")
        return []

    def _view(self, node: JavaObject) -> list:
        if self._views is not None:
            known = node.desc().identifier()
            if not node.isTempView() or known.database().isDefined() or known.table().lower() not in self._views:
                raise Rejected(f"'{known.table()}' is not one of the given tables")
        return []

    def _expression(self, node: JavaObject) -> list[tuple[JavaObject, bool]]:
        kind = node.getClass().getName()
        name = kind.rpartition(".")[2]
        if not kind.startswith(_EXPRESSIONS) or name in _FOREIGN:
            raise Rejected(f"'{name}' is not allowed")
        inner = [(c, False) for c in self._all(node.children())]
        if is_instance_of(self._gateway, node, _EXPRESSIONS + "PlanExpression"):
            inner.append((node.plan(), True))
        return inner


def _visited(df: DataFrame, views: Collection[str] | None) -> DataFrame:
    """``df``, if its analysed plan holds nothing but what may be read and computed."""
    _Visitor(df.sparkSession, views).check(df._jdf.queryExecution().analyzed())
    return df


def _shows(spark: SparkSession, statement: str) -> bool:
    """Whether Spark itself reads the statement as a ``SHOW`` command."""
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(statement).getClass().getSimpleName().startswith("Show")


def readonly_frame(
    spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None, views: Collection[str] | None = None
) -> DataFrame:
    """A checked statement as a DataFrame.

    ``views`` are the temporary views that it may read, and nothing else then, not even the names of other tables; without
    them it may read all tables and views of the catalogue, but no files by path.
    """
    statement = check_readonly(sql)
    starter = re.match(r"[(\s]*([A-Za-z_]*)", statement).group(1).upper()
    if starter == "SHOW":
        if views is not None or not _shows(spark, statement):
            raise Rejected("'SHOW' is not allowed here")
        return spark.sql(statement)
    if starter == "EXPLAIN":
        inner = re.sub(r"^EXPLAIN(\s+(EXTENDED|CODEGEN|COST|FORMATTED))?\s+", "", statement, flags=re.IGNORECASE)
        check_readonly(inner)
        _visited(spark.sql(f"SELECT * FROM ({inner}\n)", args=dict(args or {})), views)
        return spark.sql(f"EXPLAIN FORMATTED SELECT * FROM ({inner}\n)", args=dict(args or {}))
    return _visited(spark.sql(f"SELECT * FROM ({statement}\n)", args=dict(args or {})), views)


def _row_limit(max_rows: int) -> int:
    if not 1 <= max_rows <= MAX_ROWS:
        raise ValueError(f"max_rows must be from 1 to {MAX_ROWS}")
    return max_rows


def bounded_query(spark: SparkSession, sql: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """The first ``max_rows`` rows of a read-only statement; more than 5000 cannot be asked for."""
    return readonly_frame(spark, sql).limit(_row_limit(max_rows))


@contextmanager
def time_limit(spark: SparkSession, seconds: float) -> Iterator[None]:
    """Cancel the jobs of the block after ``seconds`` and raise ``TimedOut``; other jobs of the session go on."""
    context = spark.sparkContext
    kept = {name: context.getLocalProperty(name) for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
    group, late = f"limited-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        while not done.wait(0.1):
            context.cancelJobGroup(group)

    done = threading.Event()
    timer = threading.Timer(seconds, stop)
    timer.daemon = True
    context.setJobGroup(group, "read-only statement", interruptOnCancel=True)
    timer.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise TimedOut(f"the statement took more than {seconds} s") from error
        raise
    finally:
        done.set()
        timer.cancel()
        for name, value in kept.items():
            context.setLocalProperty(name, value)


class ConsoleResult(NamedTuple):
    """Column names, rows as text, and whether there were more rows."""

    columns: list[str]
    rows: list[list[str | None]]
    truncated: bool


def _run(df: DataFrame, max_rows: int, seconds: float) -> ConsoleResult:
    shown = df.select(*[console_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
    with time_limit(df.sparkSession, seconds):
        rows = [list(r) for r in shown.limit(max_rows + 1).collect()]
    return ConsoleResult(df.columns, rows[:max_rows], len(rows) > max_rows)


def run_readonly(
    spark: SparkSession, sql: str, max_rows: int = 200, explain: bool = False, seconds: float = MAX_SECONDS
) -> ConsoleResult:
    """Run a read-only statement, or show its plan; at most ``max_rows`` (up to 5000) rows reach the driver.

    After ``seconds`` its jobs are cancelled and ``TimedOut`` is raised.
    """
    limit = _row_limit(max_rows)
    return _run(readonly_frame(spark, f"EXPLAIN {check_readonly(sql)}" if explain else sql), limit, seconds)


def tenant_sql(
    spark: SparkSession, folder: str, names: list[str], sql: str, args: Mapping[str, Any] | None = None
) -> DataFrame:
    """Read-only SQL with parameters that can read the tenant's tables and nothing else.

    The statement runs in a session of its own. That session shares the catalogue and the global views with others, so the
    relations of the plan are checked against ``names``: tables, views, files and names of others are refused.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for name in names:
        read_table(own, folder, name).createOrReplaceTempView(name)
    return readonly_frame(own, sql, args, views=names)


def run_tenant(
    spark: SparkSession,
    folder: str,
    names: list[str],
    sql: str,
    args: Mapping[str, Any] | None = None,
    max_rows: int = MAX_ROWS,
    seconds: float = MAX_SECONDS,
) -> ConsoleResult:
    """Run :func:`tenant_sql` with the bounds of :func:`run_readonly`."""
    return _run(tenant_sql(spark, folder, names, sql, args), _row_limit(max_rows), seconds)
