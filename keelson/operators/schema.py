"""Schema inference and drift.

Inference aggregates ``schema_of_variant_agg`` over all rows (partial + final aggregate,
one schema string per task crosses the shuffle) and maps the resulting type, as a tree, to
the types the reference infers: objects → struct, lists of scalars → array<string>, JSON numbers with a
fraction → double, null → string, ``{}`` → ``struct<value: string>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: schema used when there is no sample to infer from.
FALLBACK_DDL = "STRUCT<id: STRING, created_at: STRING, updated_at: STRING>"


def _inferred_type(ddl: str) -> str:
    """Spark DDL for a VARIANT schema, walked as a tree: names are never touched."""
    at = 0

    def name() -> str:
        nonlocal at
        start = at
        if ddl[at] == "`":
            at += 1
            while ddl[at] != "`" or ddl[at:at + 2] == "``":
                at += 2 if ddl[at] == "`" else 1
            at += 1
        else:
            at = ddl.index(":", at)
        return ddl[start:at]

    def kind() -> tuple[str, bool]:
        """Type at this place, and whether it is an object."""
        nonlocal at
        if ddl.startswith("OBJECT<", at):
            at += len("OBJECT<")
            fields = []
            while ddl[at] != ">":
                key = name()
                at = ddl.index(" ", at) + 1
                fields.append(f"{key}: {kind()[0]}")
                at += 2 if ddl[at] == "," else 0
            at += 1
            return f"STRUCT<{', '.join(fields) or 'value: STRING'}>", True
        if ddl.startswith("ARRAY<", at):
            at += len("ARRAY<")
            element, is_object = kind()
            at += 1
            return f"ARRAY<{element if is_object else 'STRING'}>", False
        start = at
        while at < len(ddl) and ddl[at] not in ",>":
            at += 1
            if ddl[at - 1] == "(":
                at = ddl.index(")", at) + 1
        word = ddl[start:at]
        if word.startswith("DECIMAL"):
            precision, scale = map(int, word[8:-1].split(","))
            # an integer that no 64 bits hold is still an integer
            return ("BIGINT" if scale == 0 and precision >= 19 else "DOUBLE"), False
        return {"VOID": "STRING", "INT": "BIGINT", "SMALLINT": "BIGINT", "TINYINT": "BIGINT", "FLOAT": "DOUBLE"}.get(word, word), False

    return kind()[0]


def infer_schema(df: DataFrame, json_col: str) -> DataFrame:
    """One row ``ddl`` inferred from every row of ``json_col`` (null when no sample)."""
    agg = F.schema_of_variant_agg(F.try_parse_json(F.col(json_col)))
    raw = df.agg(agg.alias("__raw"))
    rewrite = F.udf(_inferred_type)  # one row: the aggregate's
    return raw.select(F.when(F.col("__raw") != "VOID", rewrite("__raw")).alias("ddl"))


def schema_or_fallback(df: DataFrame, json_col: str) -> DataFrame:
    """The inferred DDL, or the fixed id/created_at/updated_at schema without a sample."""
    inf = infer_schema(df, json_col)
    return inf.select(F.coalesce("ddl", F.lit(FALLBACK_DDL)).alias("ddl"),
                      F.col("ddl").isNull().alias("fallback"))


def schema_drift(df: DataFrame, json_col: str, schema: T.StructType) -> DataFrame:
    """Top-level keys against a declared schema.

    Rows ``(field, records, status)``: ``declared`` (in schema and seen), ``undeclared``
    (seen, not in schema) and ``missing`` (in schema, never seen, ``records = 0``).
    """
    keys = (df.select(F.explode(F.json_object_keys(F.col(json_col))).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("records")))
    declared = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(f.name) for f in schema.fields])).alias("field"))
    j = keys.join(declared.withColumn("__d", F.lit(True)), "field", "full_outer")
    status = (F.when(F.col("records").isNull(), F.lit("missing"))
              .when(F.col("__d").isNull(), F.lit("undeclared"))
              .otherwise(F.lit("declared")))
    return j.select("field", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
                    status.alias("status"))


def nested_as_text(df: DataFrame, json_col: str, schema: T.StructType) -> DataFrame:
    """I4: fields declared string keep nested objects as their JSON text."""
    from keelson.functions.coerce import coerce_json
    return coerce_json(df, json_col, schema)


def described_schema(fields: list[dict]) -> T.StructType:
    """The declared schema of a source that describes itself: a list of
    ``{name, type, nullable, fields}``, ``fields`` for nested structs."""
    def kind(f: dict) -> T.DataType:
        return described_schema(f["fields"]) if f.get("fields") else T._parse_datatype_string(f["type"])
    return T.StructType([T.StructField(f["name"], kind(f), f.get("nullable", True)) for f in fields])
