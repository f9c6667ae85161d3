"""Conversion, repair, export and conformance."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablecare.functions import text, values
from tablecare.operators import coercion as c
from tablecare.operators import conforming, projection as p
from tablecare.plans.catalogue.registry import query, run_folder
from tablecare.sources.exporting import canonical_export
from tablecare.sources.tables import read_table
from tablecare.spec import ColumnSpec, TableSpec

# The raw texts are made from the events in the same way in Spark and in the oracle.
RAW = """
    WITH raw AS (
        SELECT event_id,
               CASE event_type WHEN 'error' THEN 'n/a' WHEN 'click' THEN '  +' || (props::json->>'$.k') || ' '
                    WHEN 'view' THEN (props::json->>'$.k') || '.5' WHEN 'signup' THEN '9999999999'
                    ELSE props::json->>'$.k' END AS code,
               CASE event_type WHEN 'view' THEN '5' WHEN 'click' THEN 'TRUE' WHEN 'purchase' THEN 'yes'
                    WHEN 'error' THEN '0' END AS flag,
               CASE WHEN event_type = 'view' THEN '[' || user_id || ',' || event_id || ']' ELSE event_type END AS items,
               props AS label,
               CASE WHEN event_type = 'error' THEN '01/02/2024' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' END
                   AS at
        FROM events)
"""
MADE = """
        SELECT event_id,
               CASE WHEN regexp_matches(trim(code), '^[+-]?[0-9]+$') AND length(trim(code)) < 10
                    THEN trim(code, ' +')::int END AS code,
               CASE WHEN flag = 'TRUE' OR flag = '5' THEN true WHEN flag = '0' THEN false END AS flag,
               CASE WHEN items[1] = '[' THEN items END AS items,
               label[1:6] AS label,
               CASE WHEN "at" <> '01/02/2024' THEN strptime("at"[1:19], '%Y-%m-%dT%H:%M:%S') - INTERVAL 2 HOUR END AS "at"
        FROM raw
"""


def _raw_events(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return read_table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", "n/a")
        .when(kind == "click", F.concat(F.lit("  +"), k, F.lit(" ")))
        .when(kind == "view", F.concat(k, F.lit(".5")))
        .when(kind == "signup", "9999999999")
        .otherwise(k)
        .alias("code"),
        F.when(kind == "view", "5").when(kind == "click", "TRUE").when(kind == "purchase", "yes").when(kind == "error", "0")
        .alias("flag"),
        F.when(kind == "view", F.format_string("[%d,%d]", "user_id", "event_id")).otherwise(kind).alias("items"),
        F.col("props").alias("label"),
        F.when(kind == "error", "01/02/2024")
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .alias("at"),
    )


def _event_spec(strict: bool) -> TableSpec:
    return TableSpec(
        "events",
        (
            ColumnSpec("event_id", T.LongType(), nullable=False),
            ColumnSpec("code", T.IntegerType()),
            ColumnSpec("flag", T.BooleanType(), nullable=not strict),
            ColumnSpec("items", T.ArrayType(T.LongType())),
            ColumnSpec("label", T.StringType(), max_length=6),
            ColumnSpec("at", T.TimestampType()),
        ),
        key=("event_id",),
    )


def _shown(df: DataFrame) -> DataFrame:
    """The typed columns as text, NULLs kept: client libraries show nullable numbers in different ways."""
    shown = {"items": F.to_json("items"), "at": F.date_format("at", "yyyy-MM-dd HH:mm:ss")}
    return df.withColumns({**shown, "code": F.col("code").cast("string"), "flag": F.col("flag").cast("string")})


@query(
    RAW
    + f"""
    SELECT event_id, CAST(code AS varchar) AS code, CAST(flag AS varchar) AS flag, items, label, strftime("at", '%Y-%m-%d %H:%M:%S') AS "at" FROM ({MADE})
    WHERE event_id NOT IN (SELECT event_id FROM raw WHERE code = '9999999999')
    """
)
def coerce_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Texts to typed values; a number too wide for its column refuses the row."""
    return _shown(c.coerce(_raw_events(spark, sf), _event_spec(strict=False)).clean)


@query(
    RAW
    + f"""
    SELECT event_id, CAST(code AS varchar) AS code, CAST(flag AS varchar) AS flag, items, label, strftime("at", '%Y-%m-%d %H:%M:%S') AS "at" FROM ({MADE})
    WHERE flag IS NOT NULL AND event_id NOT IN (SELECT event_id FROM raw WHERE code = '9999999999')
    """
)
def coerce_refused(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a required flag: rows without one are refused and the others go on."""
    return _shown(c.coerce(_raw_events(spark, sf), _event_spec(strict=True)).clean)


@query(
    RAW
    + f""", made AS ({MADE}), lost AS (
        SELECT r.event_id, 'code' AS "column", r.code AS raw,
               CASE WHEN r.code = '9999999999' THEN 'out of range' ELSE 'bad value' END AS reason
        FROM raw r JOIN made m USING (event_id) WHERE r.code IS NOT NULL AND m.code IS NULL
        UNION ALL SELECT r.event_id, 'flag', r.flag, 'bad value' FROM raw r JOIN made m USING (event_id)
        WHERE r.flag IS NOT NULL AND m.flag IS NULL
        UNION ALL SELECT r.event_id, 'items', r.items, 'bad value' FROM raw r JOIN made m USING (event_id)
        WHERE r.items IS NOT NULL AND m.items IS NULL
        UNION ALL SELECT r.event_id, 'at', r."at", 'bad value' FROM raw r JOIN made m USING (event_id)
        WHERE r."at" IS NOT NULL AND m."at" IS NULL)
    SELECT 'events' AS "table", '{{"event_id":"' || event_id || '"}}' AS row_key, "column", raw, reason FROM lost
    """
)
def coerce_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """One row per value that was lost."""
    return c.coerce(_raw_events(spark, sf), _event_spec(strict=False)).rejects


@query(
    """
    SELECT 'orders' AS "table", rule, "column", rows FROM (
        SELECT 'null value' AS rule, 'o_orderpriority' AS "column",
               count(*) FILTER (o_orderpriority = '5-LOW') AS rows FROM orders
        UNION ALL SELECT 'too long', 'o_orderpriority',
               count(*) FILTER (o_orderpriority <> '5-LOW' AND length(o_orderpriority) > 8) FROM orders
        UNION ALL SELECT 'duplicate key', 'o_custkey,o_orderdate', CAST(sum(n - 1) AS bigint) FROM (
            SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1))
    WHERE rows > 0
    UNION ALL SELECT 'orders', 'missing column', 'o_clerk', 0
    """
)
def violations(spark: SparkSession, sf: str) -> DataFrame:
    """Rules the orders break: a missing column, NULLs, long texts, repeated keys."""
    orders = read_table(spark, sf, "orders")
    orders = orders.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    columns = [ColumnSpec(f.name, f.dataType) for f in orders.schema.fields if f.name != "o_orderpriority"]
    columns.append(ColumnSpec("o_orderpriority", T.StringType(), nullable=False, max_length=8))
    columns.append(ColumnSpec("o_clerk", T.StringType(), nullable=False))
    spec = TableSpec("orders", tuple(columns), ("o_orderkey",), unique=(("o_custkey", "o_orderdate"),))
    return c.validate(orders, spec).na.fill(0, ["rows"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Line keys with more than one row."""
    return c.duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT event_id, CAST(value > 100 AS int) AS big, CASE WHEN event_type <> 'error' THEN value END AS value,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' AS ts, '[' || user_id || ',' || event_id || ']' AS pair,
           upper(k[1:8] || '-' || k[9:12] || '-' || k[13:16] || '-' || k[17:20] || '-' || k[21:32]) AS ref,
           k[1:8] || '-' || k[9:12] || '-' || k[13:16] || '-' || k[17:20] || '-' || k[21:32] AS ref_key, event_type, props
    FROM (SELECT *, md5(CAST(event_id AS varchar)) AS k FROM events)
    """
)
def canonical_export_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events in portable form, with a NaN, an array, a UUID value and a UUID key added."""
    ref = values.canonical_uuid(F.md5(F.col("event_id").cast("string").cast("binary")))
    events = read_table(spark, sf, "events").select(
        "event_id",
        (F.col("value") > 100).alias("big"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        "ts",
        F.array("user_id", "event_id").alias("pair"),
        ref.alias("ref"),
        ref.alias("ref_key"),
        "event_type",
        "props",
    )
    return canonical_export(events, key_columns=["ref_key"])


@query(
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN CAST(json_object('user', user_id) AS varchar) WHEN 'error' THEN props || '}'
                     WHEN 'view' THEN '{"other": 1,  "x":[1, 2]}' ELSE '{}' END AS props
    FROM events
    """
)
def strip_json_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Key k leaves the JSON; malformed texts and objects without it stay byte for byte."""
    kind = F.col("event_type")
    events = read_table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "click", F.format_string('{"k": {"deep": [1, 2]}, "user": %d}', "user_id"))
        .when(kind == "error", F.concat("props", F.lit("}")))
        .when(kind == "view", '{"other": 1,  "x":[1, 2]}')
        .otherwise(F.col("props"))
        .alias("props"),
    )
    return p.strip_json_keys(events, "props", ["k", "extra"])


@query(
    """
    SELECT o_orderkey, CASE
        WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN NULL
        ELSE k[1:8] || '-' || k[9:12] || '-' || k[13:16] || '-' || k[17:20] || '-' || k[21:32] END AS ref
    FROM (SELECT *, md5(CAST(o_orderkey AS varchar)) AS k FROM orders)
    """
)
def canonical_uuid(spark: SparkSession, sf: str) -> DataFrame:
    """Key texts in upper case, with dashes, mangled, or all zero."""
    k, kind = F.md5(F.col("o_orderkey").cast("string").cast("binary")), F.col("o_orderpriority")
    raw = (
        F.when(kind == "1-URGENT", "00000000000000000000000000000000")
        .when(kind == "5-LOW", F.concat(k, F.lit("0")))
        .when(kind == "2-HIGH", F.upper(k))
        .otherwise(F.concat_ws("-", F.substring(k, 1, 8), F.substring(k, 9, 24)))
    )
    return p.canonical_keys(read_table(spark, sf, "orders").select("o_orderkey", raw.alias("ref")), ["ref"])


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '1970-01-01 00:00:00' END
               AS o_orderdate
    FROM orders
    """
)
def repair_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Sentinels at both ends of time become the epoch."""
    status = F.col("o_orderstatus")
    dates = (
        F.when(status == "F", F.lit("0001-01-01 00:00:00").cast("timestamp"))
        .when(status == "P", F.lit("9999-12-31 23:59:59.999999").cast("timestamp"))
        .otherwise(F.col("o_orderdate").cast("timestamp"))
    )
    orders = read_table(spark, sf, "orders").select("o_orderkey", dates.alias("o_orderdate"))
    repaired = p.repair_timestamps(orders, ["o_orderdate"])
    return repaired.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT event_id, epoch_us(ts) AS micros FROM events")
def to_utc(spark: SparkSession, sf: str) -> DataFrame:
    """Zone-less times as UTC instants, shown as microseconds since the epoch."""
    events = p.to_utc(read_table(spark, sf, "events", ["event_id", "ts"]), ["ts"])
    return events.select("event_id", F.unix_micros("ts").alias("micros"))


@query(
    """
    SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_mktsegment END AS c_mktsegment
    FROM customer
    """
)
def fill_derived(spark: SparkSession, sf: str) -> DataFrame:
    """A missing segment is filled with the name in upper case."""
    customers = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    customers = customers.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return p.fill_upper(customers, "c_mktsegment", "c_name")


@query("SELECT c_custkey, coalesce(nullif(c_nationkey, 3), 0) AS c_nationkey FROM customer")
def fill_const(spark: SparkSession, sf: str) -> DataFrame:
    """A missing key becomes the zero key."""
    customers = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    return p.fill_const(customers.withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(3))), "c_nationkey", 0)


def _ratings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customers = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").when(
        F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")
    )
    customers = customers.withColumns(
        {"c_mktsegment": segment, "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))}
    )
    return p.null_where(customers, "c_acctbal", p.is_blank("c_mktsegment"))


@query(
    """
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END
               AS c_mktsegment,
           CASE WHEN c_acctbal >= 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_acctbal END AS c_acctbal
    FROM customer
    """
)
def null_where(spark: SparkSession, sf: str) -> DataFrame:
    """Balances of customers without a segment become NULL."""
    return _ratings(spark, sf)[0]


@query("SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def null_where_changed(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that changes: those that were NULL already are not among them."""
    return _ratings(spark, sf)[1].select("c_custkey")


@query("SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS varchar) AS c_mktsegment, false AS c_original FROM customer")
def reshape(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns leave; one of their names comes back empty, and a flag with a default joins."""
    customers = read_table(spark, sf, "customer")
    return p.reshape(customers, ["c_acctbal", "c_mktsegment"], {"c_mktsegment": ("string", None), "c_original": ("boolean", False)})


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type NOT IN ('signup', 'error')")
def drop_where(spark: SparkSession, sf: str) -> DataFrame:
    """Session events are left out of an export."""
    events = read_table(spark, sf, "events", ["event_id", "user_id", "event_type"])
    return p.drop_where(events, F.col("event_type").isin("signup", "error"))[0]


@query("SELECT o_orderkey AS O_ORDERKEY, o_orderstatus AS O_OrderStatus, o_orderdate FROM orders")
def common_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The columns the target also has, under the target's names."""
    spec = TableSpec(
        "orders",
        (
            ColumnSpec("o_comment", T.StringType()),
            ColumnSpec("o_orderdate", T.TimestampNTZType()),
            ColumnSpec("O_OrderStatus", T.StringType()),
            ColumnSpec("O_ORDERKEY", T.LongType()),
        ),
    )
    return p.common_columns(read_table(spark, sf, "orders"), spec)


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           CAST(NULL AS varchar) AS o_comment, 7 AS o_shippriority FROM orders
    """
)
def conform_heal(spark: SparkSession, sf: str) -> DataFrame:
    """Orders brought to a wider schema."""
    orders = read_table(spark, sf, "orders")
    extra = (ColumnSpec("o_comment", T.StringType()), ColumnSpec("o_shippriority", T.IntegerType(), False, default=7))
    spec = TableSpec("orders", (*TableSpec.of("orders", orders.schema).columns, *extra))
    return conforming.conform(orders, spec).df


def _strict_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, TableSpec]:
    """Orders with some customers unknown, and a schema that tightens and retypes columns."""
    owner = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey"))
    orders = read_table(spark, sf, "orders").withColumn("o_custkey", owner)
    columns = [
        ColumnSpec("o_orderkey", T.LongType(), nullable=False),
        ColumnSpec("o_custkey", T.LongType(), nullable=False),
        ColumnSpec("o_orderstatus", T.StringType(), max_length=1),
        ColumnSpec("o_totalprice", T.DecimalType(12, 2)),
        ColumnSpec("o_orderdate", T.TimestampNTZType()),
        ColumnSpec("o_orderpriority", T.StringType(), max_length=6),
        ColumnSpec("o_comment", T.StringType()),
    ]
    return orders, TableSpec("orders", tuple(columns), key=("o_orderkey",), unique=(("o_custkey",),))


STRICT = """
    SELECT 'orders' AS "table", 'retype column' AS kind, 'o_totalprice' AS "column", false AS safe, CAST(0 AS bigint) AS rows
    UNION ALL SELECT 'orders', 'add column', 'o_comment', true, 0
    UNION ALL SELECT 'orders', 'tighten: null value', 'o_custkey', false, count(*) FILTER (o_orderkey % 10 = 0) FROM orders
    UNION ALL SELECT 'orders', 'tighten: too long', 'o_orderpriority', false, count(*) FILTER (length(o_orderpriority) > 6) FROM orders
    UNION ALL SELECT 'orders', 'tighten: duplicate key', 'o_custkey', false,
        count(*) FILTER (o_orderkey % 10 <> 0) - count(DISTINCT o_custkey) FILTER (o_orderkey % 10 <> 0) FROM orders
"""


@query(f"SELECT *, 'blocked' AS outcome FROM ({STRICT})")
def conform_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """Why orders cannot be brought to a stricter schema, with the rows that stand in the way."""
    made = conforming.conform(*_strict_orders(spark, sf), probe=True)
    schema = "table string, kind string, column string, safe boolean, rows bigint"
    return spark.createDataFrame([tuple(o) for o in made.operations], schema).withColumn("outcome", F.lit(made.outcome))


def _healed_twice(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    orders, ledger = read_table(spark, sf, "orders"), f"{run_folder(spark)}/ledger"
    held = TableSpec.of("orders", orders.schema).columns
    wider = (ColumnSpec("o_comment", T.StringType()), ColumnSpec("o_shippriority", T.IntegerType(), False, default=7))
    widest = (*wider, ColumnSpec("o_clerk", T.StringType()))
    steps = []
    for step, extra in enumerate((wider, wider, widest, widest), 1):
        made = conforming.conform_recorded(orders, TableSpec("orders", (*held, *extra)), ledger, datetime(2024, 3, step), mode)
        priority = F.sum("o_shippriority") if "o_shippriority" in made.df.columns else F.lit(None).cast("bigint")
        facts = made.df.agg(F.count(F.lit(1)).alias("n_rows"), priority.alias("priorities"))
        steps.append(facts.select(F.lit(step).alias("step"), F.lit(made.outcome).alias("outcome"), F.lit(conforming.applied(spark, ledger).count()).alias("recorded"), "n_rows", "priorities"))
    return reduce(DataFrame.unionAll, steps)


@query(
    """
    SELECT step, outcome, CAST(recorded AS bigint) AS recorded, n_rows, CAST(7 * n_rows AS bigint) AS priorities
    FROM (VALUES (1, 'healed', 2), (2, 'already_healed', 2), (3, 'healed', 3), (4, 'already_healed', 3)) AS v(step, outcome, recorded),
         (SELECT count(*) AS n_rows FROM orders)
    """
)
def conform_already_healed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read four times under two growing schemas; the ledger knows what was applied before."""
    return _healed_twice(spark, sf, "heal")


@query(
    """
    SELECT step, 'detected' AS outcome, CAST(0 AS bigint) AS recorded, n_rows, CAST(NULL AS bigint) AS priorities
    FROM (VALUES (1), (2), (3), (4)) AS v(step), (SELECT count(*) AS n_rows FROM orders)
    """
)
def conform_detected(spark: SparkSession, sf: str) -> DataFrame:
    """The same in report mode: the data stays as it is and nothing is recorded."""
    return _healed_twice(spark, sf, "report")


@query(
    """
    SELECT doc_id, lang, source FROM documents
    WHERE contains(lower(text), '%') OR contains(lower(source), '%')
    UNION ALL
    SELECT doc_id, lang, source FROM documents
    WHERE contains(lower(text), 'c1') OR contains(lower(source), 'c1')
    """
)
def contains_any(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold either term; the percent sign is a plain character, case does not count."""
    documents = read_table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])
    found = [p.contains_any(documents, term, ["text", "source"]) for term in ("%", "C1")]
    return found[0].unionByName(found[1]).select("doc_id", "lang", "source")


@query("SELECT p_partkey, p_name, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO')")
def in_list(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of two types given as a comma list with blanks."""
    return p.in_list(read_table(spark, sf, "part", ["p_partkey", "p_name", "p_type"]), "p_type", " ECONOMY, ,PROMO,")


@query(
    """
    SELECT doc_id, sha256('=' || doc_id || chr(31) || '=' || source || chr(31)
               || CASE WHEN lang = 'en' THEN '-' ELSE '=' || lang END) AS print,
           CASE WHEN length(text) > 120 THEN text[1:120] || '…' ELSE text END AS preview,
           CASE WHEN n_chars >= 1024 THEN printf('%.1f KB', round(n_chars / 1024.0, 1)) ELSE n_chars || ' B' END AS size
    FROM documents
    """
)
def text_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint, preview and readable size of each document."""
    return read_table(spark, sf, "documents").select(
        "doc_id",
        text.fingerprint(F.col("doc_id"), F.col("source"), F.nullif("lang", F.lit("en"))).alias("print"),
        text.preview_text(F.col("text")).alias("preview"),
        text.byte_size(F.col("n_chars")).alias("size"),
    )
