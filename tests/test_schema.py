"""Schema inference, fallback, drift and described schemas."""

import json

from pyspark.sql import types as T

from keelson.operators.schema import FALLBACK_DDL, described_schema, infer_schema, schema_drift, schema_or_fallback


def test_inference_rules(spark):
    rec = {"a": 1, "b": 1.5, "c": True, "d": None, "e": [1, 2], "f": [{"x": 1}], "g": {}, "h": "s"}
    df = spark.createDataFrame([(json.dumps(rec),)], "j string")
    ddl = infer_schema(df, "j").first().ddl
    assert ddl == ("STRUCT<a: BIGINT, b: DOUBLE, c: BOOLEAN, d: STRING, e: ARRAY<STRING>, "
                   "f: ARRAY<STRUCT<x: BIGINT>>, g: STRUCT<value: STRING>, h: STRING>")
    T._parse_datatype_string(ddl.replace("STRUCT<", "struct<", 1))  # Spark accepts it


def test_fallback_without_sample(spark):
    df = spark.createDataFrame([("not json",), (None,)], "j string")
    row = schema_or_fallback(df, "j").first()
    assert row.ddl == FALLBACK_DDL and row.fallback


def test_drift_statuses(spark):
    df = spark.createDataFrame([('{"a":1,"x":2}',), ('{"a":3}',)], "j string")
    declared = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    got = {r.field: (r.records, r.status) for r in schema_drift(df, "j", declared).collect()}
    assert got == {"a": (2, "declared"), "x": (1, "undeclared"), "b": (0, "missing")}


def test_names_are_not_types(spark):
    rec = {"INT": 1, "VOID": "x", "a b": {"DECIMAL(2,1)": 1.5}, "n:m": [[1, 2]], "`q": [], "big": 12345678901234567890123, "one": 1.0}
    ddl = infer_schema(spark.createDataFrame([(json.dumps(rec),)], "j string"), "j").first().ddl
    got = {f.name: f.dataType.simpleString() for f in T._parse_datatype_string(ddl).fields}
    assert got == {"INT": "bigint", "VOID": "string", "a b": "struct<DECIMAL(2,1):double>", "n:m": "array<string>", "`q": "array<string>",
                   "big": "bigint", "one": "double"}


def test_described_schema():
    got = described_schema([{"name": "id", "type": "string", "nullable": False}, {"name": "at", "type": "timestamp"},
                            {"name": "m", "type": "struct", "fields": [{"name": "count", "type": "integer"}, {"name": "measure", "type": "double"}]}])
    assert got == T.StructType([T.StructField("id", T.StringType(), False), T.StructField("at", T.TimestampType()),
                                T.StructField("m", T.StructType([T.StructField("count", T.IntegerType()), T.StructField("measure", T.DoubleType())]))])


def test_metadata_relation_honours_table_options(spark):
    from types import SimpleNamespace
    from keelson.operators.profile import metadata_relation
    meta = {"a": {"primary_keys": ["x", "y"], "cursor_field": "at", "ingestion_type": "cdc"}, "b": {}}
    got = metadata_relation(spark, SimpleNamespace(metadata=meta.get), ["b", "a"], {"a": {"cursor_field": "seq"}}).collect()
    assert [tuple(r) for r in got] == [("b", [], None, "cdc"), ("a", ["x", "y"], "seq", "cdc")]
