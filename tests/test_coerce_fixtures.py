"""Literal coercion cases (FIXTURES.md part C) with the values the reference rules give."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.coerce import coerce_json

CASES = [
    ("bigint", ['"1.5"', '" 7 "', "-2.9", "true", '"+4"', '"1_000"', '"-2.75"', "1e3", '"1.5e3"', "0.0"], [1, 7, -2, 1, 4, 1000, -2, 1000, 1500, 0]),
    ("double", ['"1e3"', '" 1.5 "', '".5"', '"1_0.5"', '"-inf"', "true", "7", '"+4."'], [1000.0, 1.5, 0.5, 10.5, float("-inf"), 1.0, 7.0, 4.0]),
    ("decimal(6,2)", ['"12.34"', "12.3"], [Decimal("12.34"), Decimal("12.30")]),
    ("boolean", ['"Yes"', '"t"', '"1"', '"N"', '"0"', '"maybe"', '""', "2", "0",
                 '" false "', '"T"', "[]", "[0]", "{}", "0.0"],
     [True, True, True, False, False, True, False, True, False, True, True, False, True, False, False]),
    ("date", ['"2024-06-30"', '"06/30/2024"', '"30-06-2024"', '"2024/06/30"',
              '"2024-06-30T23:00:00-05:00"'], [datetime.date(2024, 6, 30)] * 5),
    ("date", ['"2024-W01-5"', '"2024W015"', '"20240105"', '"20240105T101112"', '"2024-1-5"', '"2024-01-05 10:00"'], [datetime.date(2024, 1, 5)] * 6),
    ("timestamp_ntz", ['"20240105T101112"', '"2024-01-05T10:11:12"', '"2024-01-05 10:11:12"', '"2024-W01-5T10:11:12"', '"2024/1/5 10:11:12"',
                       '"2024-1-5 10:11:12"', '"2024-01-05T12:11:12+02:00"', '"2024-01-05T101112Z"', '"2024-01-05T10:11:12,0"'],
     [datetime.datetime(2024, 1, 5, 10, 11, 12)] * 9),
    ("timestamp_ntz", ['"2024-06-01T00:00:00Z"', '"2024/06/01 01:02:03"', "1.5"],
     [datetime.datetime(2024, 6, 1), datetime.datetime(2024, 6, 1, 1, 2, 3),
      datetime.datetime(1970, 1, 1, 0, 0, 1, 500000)]),
    ("array<string>", ['"x"', '["x",null]'], [["x"], ["x", None]]),
    ("map<string,int>", ['{"k":"3"}'], [{"k": 3}]),
    ("string", ['{"a":1}', "null"], ['{"a":1}', None]),
]

ERROR_CASES = [
    ("bigint", ['""', '"1e3"', '"abc"', "{}", '"1.5d"', '"0x1"', '"7L"', '"1__0"', "[1]"]),
    ("double", ['"1.5d"', '"1.5f"', '"0x1p3"', '"1D"', '""', "[]"]),
    ("timestamp_ntz", ['"2024-01-05 10:00:00 Europe/Paris"', '" 2024-01-05T10:00:00"', '"2024-01-05T10:00:00 "', '"2024-W54-1"', '"2024-02-30"', '"10:00"']),
    ("decimal(6,2)", ['"abc"', '""']),
    ("date", ["20240630", '" 2024-01-05"', '"2024-13-05"', '"2023-W53-1"', '"2024-01-05T25:00"']),
    ("decimal(6,2)", ["true", '"12.5d"']),
    ("struct<a:int>", ["{}", "5"]),
]


def _run(spark, ddl, values, mode="permissive"):
    dtype = T._parse_datatype_string(ddl)
    df = spark.createDataFrame([(i, '{"x": %s}' % v) for i, v in enumerate(values)], "i int, j string")
    out = coerce_json(df, "j", T.StructType([T.StructField("x", dtype)]), mode=mode, keep=["i"])
    return sorted(out.collect(), key=lambda r: r.i)


@pytest.mark.parametrize("ddl,values,expected", CASES)
def test_values(spark, ddl, values, expected):
    rows = _run(spark, ddl, values)
    assert [r.x for r in rows] == expected
    assert all(r._errors == [] for r in rows)


def test_nan(spark):
    import math
    rows = _run(spark, "double", ['"nan"'])
    assert math.isnan(rows[0].x)


@pytest.mark.parametrize("ddl,values", ERROR_CASES)
def test_errors(spark, ddl, values):
    rows = _run(spark, ddl, values)
    assert all(r.x is None and len(r._errors) == 1 for r in rows)


def test_binary(spark):
    rows = _run(spark, "binary", ['"aGk="', '"abcdef"', '"hello world"', "[104,105]", '"deadbeef"'])
    assert [bytes(r.x) for r in rows] == [b"hi", bytes.fromhex("abcdef"), b"hello world", b"hi",
                                          bytes.fromhex("75e69d6de79f")]


def test_struct_fields(spark):
    rows = _run(spark, "struct<a:int,b:int>", ['{"a":1,"z":2}'])
    assert rows[0].x.a == 1 and rows[0].x.b is None


def test_non_nullable(spark):
    s = T.StructType([T.StructField("a", T.IntegerType(), False)])
    df = spark.createDataFrame([(0, '{"x":{"b":1}}'), (1, '{"x":{"a":null}}')], "i int, j string")
    rows = sorted(coerce_json(df, "j", T.StructType([T.StructField("x", s)]), mode="permissive",
                              keep=["i"]).collect(), key=lambda r: r.i)
    assert rows[0]._errors and not rows[1]._errors


def test_variant(spark):
    rows = _run(spark, "string", ['"{\\"a\\":1}"'])
    assert rows[0].x == '{"a":1}'
    dtype = T.StructType([T.StructField("x", T.VariantType())])
    df = spark.createDataFrame([(0, '{"x": "{\\"a\\":1}"}')], "i int, j string")
    out = coerce_json(df, "j", dtype).select(F.variant_get("x", "$.a", "int").alias("a"))
    assert out.collect()[0].a == 1


def test_strict_fails(spark):
    with pytest.raises(Exception, match="cannot convert abc"):
        _run(spark, "bigint", ['"abc"'], mode="strict")


def test_record_level_errors(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    df = spark.createDataFrame([(0, "{}"), (1, "5"), (2, "not json"), (3, '{"b":1}')], "i int, j string")
    rows = sorted(coerce_json(df, "j", schema, mode="permissive", keep=["i"]).collect(), key=lambda r: r.i)
    assert "empty object" in rows[0]._errors[0]
    assert "struct" in rows[1]._errors[0]
    assert "bad JSON" in rows[2]._errors[0]
    assert rows[3]._errors == [] and rows[3].a is None


def test_text_after_the_record_is_an_error(spark):
    df = spark.createDataFrame([('{"a":1}{"a":2}',), ('{"a":1},{"a":2}',), ('{"a":1} x',), ('{"a":1} ',), ("5",), ("[1]",)], "j string")
    out = coerce_json(df, "j", T._parse_datatype_string("struct<a:int>"), mode="permissive", keep=["j"]).collect()
    assert {r.j: r.a for r in out if not r._errors} == {'{"a":1} ': 1}
    with pytest.raises(Exception, match="bad JSON"):
        coerce_json(df.limit(1), "j", T._parse_datatype_string("struct<a:int>")).collect()


def test_expression_grows_with_the_depth_not_its_power(spark):
    """The expression of a type four arrays deep is a few times that of one array."""
    def size(depth):
        ddl = "int"
        for _ in range(depth):
            ddl = f"array<struct<a:{ddl}>>"
        df = coerce_json(spark.createDataFrame([('{"x":[]}',)], "j string"), "j", T._parse_datatype_string(f"struct<x:{ddl}>"))
        return len(df._jdf.queryExecution().analyzed().toString())
    assert size(4) < 6 * size(1)
