import math
import random
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecare.functions import json_text, text, values
from tablecare.operators import coercion as c
from tablecare.operators import projection as p
from tablecare.sources.exporting import canonical_export
from tablecare.spec import ColumnSpec, TableSpec


def convert(frame, raw, target):
    df = frame([(i, x) for i, x in enumerate(raw)], "i int, s string")
    made = df.select("i", values.convert(F.col("s"), T.StringType(), target).alias("v")).orderBy("i").collect()
    return [r["v"] for r in made]


def test_boolean_texts(frame):
    raw = ["1", "0", "5", "true", "FALSE", "yes", " 12 ", "t", "", None]
    assert convert(frame, raw, T.BooleanType()) == [True, False, True, True, False, None, True, None, None, None]


def test_integer_texts(frame):
    raw = [" 12 ", "1.5", "+7", "-3", "9223372036854775808", "12x", ""]
    assert convert(frame, raw, T.LongType()) == [12, None, 7, -3, None, None, None]
    assert convert(frame, ["2147483647", "2147483648"], T.IntegerType()) == [2147483647, None]
    assert convert(frame, ["-128", "128"], T.ByteType()) == [-128, None]


def test_real_texts(frame):
    made = convert(frame, ["1e3", " -2.5 ", "NaN", "Infinity", "-infinity", "1d", "x", ".5"], T.DoubleType())
    assert made[:2] == [1000.0, -2.5] and math.isnan(made[2]) and made[3:5] == [math.inf, -math.inf]
    assert made[5:] == [None, None, 0.5]


def test_timestamp_texts(frame):
    raw = ["2024-01-02T03:04:05Z", "2024-01-02 03:04:05", "2024-01-02T03:04:05+02:00", "01/02/2024", "12:30", "x"]
    df = frame([(i, x) for i, x in enumerate(raw)], "i int, s string")
    shown = F.date_format(values.to_timestamp_utc(F.col("s")), "yyyy-MM-dd HH:mm:ss")
    made = [r[0] for r in df.orderBy("i").select(shown).collect()]
    assert made == ["2024-01-02 03:04:05"] * 2 + ["2024-01-02 01:04:05"] + [None] * 3


def test_array_texts(frame):
    raw = ["[1,2]", " [ 3 ] ", "[]", "[1,null]", "x", "[1,x]", "[1,2] x]", None]
    expected = [[1, 2], [3], [], [1, None], None, None, None, None]
    assert convert(frame, raw, T.ArrayType(T.LongType())) == expected


def test_real_source_to_whole(frame):
    df = frame([(2.0,), (1.5,), (math.nan,), (None,)], "x double")
    made = [r[0] for r in df.select(values.convert(F.col("x"), T.DoubleType(), T.LongType())).collect()]
    assert made == [2, None, None, None]


SPEC = TableSpec(
    "item",
    (
        ColumnSpec("id", T.StringType(), nullable=False),
        ColumnSpec("year", T.ShortType()),
        ColumnSpec("name", T.StringType(), max_length=4),
        ColumnSpec("folded", T.StringType(), nullable=False),
    ),
    key=("id",),
    derived={"folded": "upper(name)"},
)


def test_coerce_reports_values_and_refuses_rows(frame, rows):
    raw = frame(
        [("a", "1999", "straße", None), ("b", "99999", "x", "X"), ("c", "old", "y", "Y"), (None, "1", "z", "Z")],
        "ID string, Year string, NAME string, folded string",
    )
    out = c.coerce(raw, SPEC)
    assert out.clean.columns == ["id", "year", "name", "folded"]
    assert rows(out.clean) == [("a", 1999, "stra", "STRASSE"), ("c", None, "y", "Y")]
    assert rows(out.rejects, "column", "raw", "reason") == [
        ("id", None, c.MISSING),
        ("year", "99999", c.OUT_OF_RANGE),
        ("year", "old", c.BAD_VALUE),
    ]
    assert out.rejects.where("raw = 'old'").first()["row_key"] == '{"id":"c"}'


def test_coerce_export_coerce_is_stable(frame, rows):
    raw = frame([("1", "true", "[1,2]"), ("2", "0", "x")], "id string, flag string, ticks string")
    spec = TableSpec(
        "t",
        (
            ColumnSpec("id", T.LongType()),
            ColumnSpec("flag", T.BooleanType()),
            ColumnSpec("ticks", T.ArrayType(T.LongType())),
        ),
        key=("id",),
    )
    once = c.coerce(raw, spec).clean
    again = c.coerce(canonical_export(once, ["id"]).select(*[F.col(x).cast("string") for x in once.columns]), spec)
    assert rows(again.clean) == rows(once) and again.rejects.count() == 0


def test_no_common_column(frame):
    with pytest.raises(ValueError, match="no common column"):
        c.coerce(frame([(1,)], "other int"), SPEC)
    assert p.common_columns(frame([(1,)], "other int"), SPEC) is None


def test_validate_and_require(frame, rows):
    df = frame([("a", 1, "toolong", None), ("a", 2, "x", "X")], "id string, year int, name string, folded string")
    assert rows(c.validate(df, SPEC), "rule", "column", "rows") == [
        ("duplicate key", "id", 1),
        ("null value", "folded", 1),
        ("too long", "name", 1),
    ]
    with pytest.raises(ValueError, match="duplicate key"):
        c.require_valid(df, SPEC)
    with pytest.raises(ValueError, match="folded"):
        c.require_columns(df.drop("folded"), SPEC)
    assert c.validate(df.where("year = 2"), SPEC).count() == 0


def test_export_rules(frame):
    df = frame(
        [(True, datetime(2024, 1, 2, 3, 4, 5, 678), math.nan, [1, 2], "Abcdef00-0000-0000-0000-00000000000a", "Abcdef00-0000-0000-0000-00000000000a")],
        "flag boolean, at timestamp, x double, ticks array<bigint>, ref string, key string",
    )
    row = canonical_export(df, key_columns=["KEY"]).first()
    assert row["flag"] == 1 and row["x"] is None and row["ticks"] == "[1,2]"
    assert row["at"] == "2024-01-02T03:04:05.0006780Z"
    assert row["ref"] == "ABCDEF00-0000-0000-0000-00000000000A" and row["key"] == "Abcdef00-0000-0000-0000-00000000000a"


def test_infinities_leave_an_export(frame):
    df = frame([(math.inf, 1.5), (-math.inf, None)], "x double, y double")
    assert [tuple(r) for r in canonical_export(df).collect()] == [(None, 1.5), (None, None)]


def test_uuid_forms(frame):
    dice = random.Random(31)
    ids = [uuid.UUID(int=dice.getrandbits(128)) for _ in range(12)]
    forms = [str, lambda u: str(u).upper(), lambda u: u.hex, lambda u: u.hex.upper()]
    good = [(form(u), str(u)) for u in ids for form in forms]
    odd = [(u.hex[:31], None) for u in ids[:2]] + [(u.hex + "f", None) for u in ids[:2]] + [(u.hex.replace(u.hex[7], "g"), None) for u in ids[:2]]
    cases = [*good, *odd, (str(uuid.UUID(int=0)), None), ("", None), (None, None)]
    df = frame([(i, x) for i, (x, _) in enumerate(cases)], "i int, s string").orderBy("i")
    assert [r[0] for r in df.select(values.canonical_uuid(F.col("s"))).collect()] == [expected for _, expected in cases]


JSON = '{"draft":[1],"note":"x","size":7}'


def test_strip_json_keys_changes_once(frame, rows):
    df = frame([(1, JSON), (2, "{draft"), (3, '{"size": 1}'), (4, None)], "id int, data string")
    keys = ["draft", "note"]
    once = p.strip_json_keys(df, "data", keys)
    assert rows(once) == [(1, '{"size":7}'), (2, "{draft"), (3, '{"size": 1}'), (4, None)]
    assert once.where(json_text.has_any_key(F.col("data"), keys)).count() == 0


@pytest.mark.parametrize(
    "bad", ['{"k":1}}', '{"k":1} x', '{"k":1', "{'k':1}", '{"k":NaN}', '{"k":1}] {}', '{"k":1},{"k":2}', '[{"k":1}]']
)
def test_text_that_is_not_one_object_stays(frame, bad):
    assert p.strip_json_keys(frame([(bad,)], "data string"), "data", ["k"]).first()[0] == bad


def test_an_escaped_key_is_found(frame):
    df = frame([('{"\\u006b":1,"z":[1, {"k": 2}]}',)], "data string")
    assert p.strip_json_keys(df, "data", ["k"]).first()[0] == '{"z":[1,{"k":2}]}'


def test_sentinel_times_also_in_arrays(spark):
    low, high, good = "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999", "2024-05-06 07:08:09"
    df = spark.range(1).select(
        *[F.lit(x).cast("timestamp").alias(n) for n, x in (("low", low), ("high", high), ("good", good))],
        F.array(*[F.lit(x).cast("timestamp_ntz") for x in (low, good)]).alias("many"),
    )
    row = p.repair_timestamps(df, ["low", "high", "good", "many"]).select(
        *[F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) for n in ("low", "high", "good")],
        F.transform("many", lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss")).alias("many"),
    ).first()
    assert row["low"] == row["high"] == "1970-01-01 00:00:00" and row["good"] == good
    assert row["many"] == ["1970-01-01 00:00:00", good]


def test_zoneless_times_are_utc_also_in_arrays(spark):
    df = spark.range(1).select(F.array(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("many"))
    made = p.to_utc(df, ["many"])
    assert made.schema["many"].dataType == T.ArrayType(T.TimestampType())
    assert made.select(F.unix_seconds(F.get("many", F.lit(0)))).first()[0] == 1704067200


def test_null_where_reports_changed_rows_only(frame, rows):
    df = frame([(1, None, 5), (2, "", None), (3, "PG", 7)], "id int, rating string, value int")
    made, changed = p.null_where(df, "value", p.is_blank("rating"))
    assert rows(made) == [(1, None, None), (2, "", None), (3, "PG", 7)]
    assert rows(changed, "id") == [(1,)]
    assert p.null_where(made, "value", p.is_blank("rating"))[1].count() == 0


def test_fill_and_drop(frame, rows):
    df = frame([("ada", None), (None, None), ("bob", "B")], "name string, folded string")
    assert rows(p.fill_upper(df, "folded", "name")) == [("ada", "ADA"), ("bob", "B"), (None, "")]
    assert rows(p.fill_const(df, "name", "zero"), "name") == [("ada",), ("bob",), ("zero",)]
    stay, gone = p.drop_where(df, F.col("name") != "bob")
    assert rows(stay, "name") == [("bob",), (None,)] and rows(gone, "name") == [("ada",)]


def test_reshape(frame):
    df = frame([(1, "legacy")], "id int, extra string")
    made = p.reshape(df, ["extra"], {"extra": ("string", None), "original": ("boolean", False)}).first()
    assert made.asDict() == {"id": 1, "extra": None, "original": False}
    with pytest.raises(ValueError, match="extra"):
        p.reshape(df, add={"extra": ("int", 1)})


def test_text_helpers(frame, rows):
    df = frame([("100%",), ("1000",), ("a_b",), ("aXb",), ("c\\d",), (None,)], "s string")
    for term, found in (("0%", ["100%"]), ("A_B", ["a_b"]), ("\\", ["c\\d"])):
        assert [r[0] for r in p.contains_any(df, term, ["s"]).collect()] == found
    assert text.split_list(" a, ,b,") == ["a", "b"] and text.split_list(None) == []
    assert p.in_list(df, "s", " , ").count() == 6
    sizes = frame([(0, 5), (1, 1536), (2, 5 << 20), (3, 3 << 30)], "i int, n bigint").orderBy("i")
    assert [r[0] for r in sizes.select(text.byte_size(F.col("n"))).collect()] == ["5 B", "1.5 KB", "5.0 MB", "3.0 GB"]
