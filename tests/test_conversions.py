"""Literal cases of every conversion, and comparison with Python's own parsing."""

from __future__ import annotations

import datetime as dt
import json
import random
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowharbor.functions.dates import to_date, to_datetime
from rowharbor.functions.json_text import csv_to_array, is_json, repair_json, to_json_or_array
from rowharbor.functions.numbers import to_float, to_int
from rowharbor.functions.text import WHITESPACE, list_items, strip, to_bool, to_text
from rowharbor.operators.clean import cast_to_schema, clean, rename, split_factor
from rowharbor.operators.coerce import coerce_table
from rowharbor.spec import SpecError


def apply(spark, fn, values):
    """Values of ``fn`` over a text column, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r["v"] for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def check(spark, fn, cases):
    got = apply(spark, fn, [k for k, _ in cases])
    assert list(zip([k for k, _ in cases], got)) == cases


def test_strip_removes_what_python_strips(spark):
    values = [f"{w} a{w}b {w}" for w in WHITESPACE] + ["", "  "]
    assert apply(spark, strip, values) == [v.strip() for v in values]
    assert all(not w.strip() for w in WHITESPACE) and len(set(WHITESPACE)) == len(WHITESPACE) == 29


INT_CASES = [
    ("1,000", 1000), ("9.7", 9), ("-9.7", -9), ("1e3", 1000), (" 7 ", 7), ("+5", 5), (".5", 0), ("9.", 9),
    ("inf", None), ("12d", None), ("0x10", None), ("abc", None), ("", None), ("nan", None), ("1_000", None),
    (None, None), ("1e30", None), ("NAN", None), ("1f", None),
]


def test_to_int(spark):
    check(spark, to_int, INT_CASES)


def test_int_rejects_and_reasons(spark):
    rows = spark.createDataFrame([(v,) for v, _ in INT_CASES], "c string")
    valid, rejected = coerce_table(rows, {"c": "int"})
    reasons = {r["c"]: r["rejection_reason"] for r in rejected.collect()}
    assert reasons == {
        "inf": "Type coercion failed: cannot convert float infinity to integer",
        "NAN": "Type coercion failed: cannot convert float NaN to integer",
        "1e30": "Type coercion failed: integer out of range",
        "12d": "Type coercion failed: could not convert string to float: '12d'",
        "1f": "Type coercion failed: could not convert string to float: '1f'",
        "0x10": "Type coercion failed: could not convert string to float: '0x10'",
        "abc": "Type coercion failed: could not convert string to float: 'abc'",
        "1_000": "Type coercion failed: could not convert string to float: '1_000'",
    }
    assert valid.count() == len(INT_CASES) - len(reasons)
    assert valid.schema["c"].dataType.simpleString() == "bigint"


def test_to_float_reads_what_python_reads(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice("0123456789.eE+-, ") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    values += ["inf", "-Infinity", "1,234.5", "abc", "1d"]

    def python(v):
        try:
            return None if v.strip() in ("", "nan", "NaN") else float(v.replace(",", ""))
        except ValueError:
            return None

    assert apply(spark, to_float, values) == [python(v) for v in values]


DATES = [
    "2024-01-05", "2024-1-5", "2024-01-05T10:20", "2024-01-05 10:20:30.5", "2024-01-05 10:20:30+05:30", "2024/01/05",
    "2024.01.05", "20240105", "202401", "45000", "2024", "24", "1/5/24", "1/5/99", "13/1/24", "31/12/2024", "12/31/2024",
    "31-12-2024", "5.1.2024", "31.12.2024", "Jan 5 2024", "January 5, 2024", "5 Jan 2024", "05-Jan-2024", "05-Jan-24",
    "5 January 2024", "Jan 2024", "2024-01", "1677-09-21", "1677-09-22", "1600-01-01", "2200-12-31", "2201-01-01",
    "2024-02-30", "30/02/2024", "abc", "2024-01-05 abc", "Fri Jan 5 2024", "2024-01-05Z", "1/5/2024 10:20 PM",
    "2024-13-01", "2024-31-12", "Jan 5, 2024 10:00", "05JAN2024", "2024 Jan 5", "jan-05-2024", "2024-001", "12", "99991231",
    "31/12", "12-31-2024", "  2024-01-05 ", "0024-01-05", "2024-1", "5/2024", "Sept 5 2024", "5th Jan 2024",
    "2024-01-05T24:00", "None", "N/A",
]


def test_dates_match_pandas(spark):
    warnings.simplefilter("ignore")

    def stamp(v):
        try:
            t = pd.to_datetime(v)
        except ValueError:
            return None
        return None if pd.isna(t) or t.year > 2200 else t.tz_localize(None).to_pydatetime()

    expected = [stamp(v) for v in DATES]
    assert apply(spark, to_datetime, DATES) == expected
    assert apply(spark, to_date, DATES) == [t.date() if t else None for t in expected]


def test_end_of_time_and_missing_dates(spark):
    check(
        spark,
        to_date,
        [
            ("9999-12-31", dt.date(9999, 12, 31)),
            ("9999-12-31 00:00:00", dt.date(9999, 12, 31)),
            ("until 9999-12-31", dt.date(9999, 12, 31)),
            ("", None), ("nan", None), (None, None),
        ],
    )


def test_lists(spark):
    check(spark, list_items, [("a, b,,c ", ["a", "b", "c"]), (" , ,", None), ("", None), ("nan", None), ("x", ["x"])])
    check(spark, csv_to_array, [("a, b", '["a","b"]'), (" , ", None)])


JSON_TEXTS = [
    "[1,2]", "5", "a,b", "[1] x", "1 2", "1, 2", "1], [2", '1}, {"a":2', '{"a":1,"a":2}', "NaN", "Infinity", "-Infinity",
    "['a', 'b']", "{'a': 1}", '{"a": [1,}', "[1, 2", '"q"', "'q'", "null", "true", " [1] ", "[1,]", "01", "1e999",
    "[1.50]", "{a:1}", "1-URGENT", '"a" "b"', '{"a": NaN}', '"\\x"', "+1", ".5", "[01]", '5,"v":6', "tru", "5x",
    '[1], "x": [2]', "[1]], [[2]", "[1], [2]", '{"a":1}, "v":{}', '"\\u00e9\\n"', '["a\\"b"]', "-", "[]", "{}", "1.", '""',
]


def test_json_validity_matches_python(spark):
    def python(v):
        try:
            json.loads(v)
            return True
        except ValueError:
            return False

    assert list(zip(JSON_TEXTS, apply(spark, is_json, JSON_TEXTS))) == [(v, python(v)) for v in JSON_TEXTS]


def test_json_or_list(spark):
    check(
        spark,
        to_json_or_array,
        [("[1,2]", "[1,2]"), ("5", "5"), ("a,b", '["a","b"]'), ("", None), (",", None), ('{"k": 1}', '{"k": 1}')],
    )


def test_repair_json(spark):
    check(
        spark,
        repair_json,
        [
            ('["a"]', '["a"]'),
            ("['a', 'b']", '["a","b"]'),
            ('["it\'s", \'x\']', '["it\'s","x"]'),
            ("{'a': 1, 'b': ['x']}", '{"a":1,"b":["x"]}'),
            ("[1, 'a']", '[1,"a"]'),
            ("['a', b]", '["a", b]'),
            ("['a'] ['b']", '["a"] ["b"]'),
            ("plain 'text'", "plain 'text'"),
            ("'q'", "'q'"),
            ("", None),
            (None, None),
        ],
    )


def test_text_and_flags(spark):
    check(spark, to_bool, [("T", True), (" yes ", True), ("1", True), ("f", False), ("maybe", False), ("", None)])
    assert spark.range(1).select(to_text(F.lit(9.0)).alias("v")).first()["v"] == "9.0"


def test_split_factor(spark):
    cases = {
        "0.001": (0.001, None), "1e3": (1000.0, None), "-5": (0.0, "-5"), "1e-05": (0.0, "1e-05"), "=A1*2": (0.0, "=A1*2"),
        "12 pack": (0.0, "12 pack"), "1,000": (0.0, "1,000"), "": (0.0, ""), "nan": (None, None), "Depends": (0.0, "Depends"),
        "5 × 10": (0.0, "5 × 10"), "inf": (float("inf"), None), "INF": (0.0, "INF"), "1.": (1.0, None), "5K": (0.0, "5K"),
        "12d": (0.0, "12d"),
    }
    df = spark.createDataFrame([(k, k) for k in cases], "raw string, conversion_factor string")
    got = {r["raw"]: (r["conversion_factor"], r["syn"]) for r in split_factor(df).collect()}
    assert got == cases
    kept = spark.createDataFrame([("2", "old"), ("x", "old")], "conversion_factor string, syn string")
    assert {tuple(r) for r in split_factor(kept).select("conversion_factor", "syn").collect()} == {(2.0, "old"), (0.0, "x")}
    assert split_factor(df.select("raw")).columns == ["raw"]


def test_clean_and_rename(spark):
    df = spark.createDataFrame([(" a\t", None, 1)], " x  string,  `y ` string, z int".replace(" x  ", "`  x` "))
    cleaned = clean(df)
    assert cleaned.columns == ["x", "y", "z"]
    assert cleaned.first() == ("a", None, 1)
    two = spark.createDataFrame([(None, "b", "c"), ("a", "b", "c")], "plant_id string, PLANT_ID2 string, k string")
    merged = rename(two, {"PLANT_ID2": "plant_id", "nope": "x"})
    assert merged.columns == ["plant_id", "k"]
    assert [r["plant_id"] for r in merged.collect()] == ["b", "a"]


def test_cast_to_schema_needs_a_known_column(spark):
    from pyspark.sql import types as T

    with pytest.raises(SpecError):
        cast_to_schema(spark.range(1), T.StructType([T.StructField("x", T.LongType())]))


def test_first_failing_column_is_reported(spark):
    rows = spark.createDataFrame([("x", "y", "k")], "a string, b string, other string")
    _, rejected = coerce_table(rows, {"b": "float", "a": "int", "gone": "int"})
    assert rejected.first()["rejection_reason"].endswith("'y'")
    assert rejected.columns == ["a", "b", "other", "rejection_reason"]
    quoted = spark.createDataFrame([("it's",)], "a string")
    assert coerce_table(quoted, {"a": "float"})[1].first()["rejection_reason"].endswith('float: "it\'s"')


def test_two_digit_years_follow_the_reference_year_alone(spark):
    df = spark.createDataFrame([("1/2/75",), ("1/2/76",), ("5 mar 30",)], "v string")
    years = lambda **k: [r[0].year for r in df.select(to_date(F.col("v"), **k)).collect()]
    assert years() == [2075, 1976, 2030] and years(reference_year=1990) == [1975, 1976, 2030] and years(reference_year=1950) == [1975, 1976, 1930]
    plan = df.select(to_date(F.col("v")), to_datetime(F.col("v")))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "current_date" not in plan
