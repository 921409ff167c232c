"""Schema summaries per batch, merged without reading earlier batches again.

A batch is summed up by the type of all its JSON records: one short text, from Spark's own
aggregate. Types form a lattice whose join is associative, commutative and idempotent, so the
summaries of any split of the rows, merged in any order and as often as one likes, give the
schema of the whole. Numbers widen (integer, decimal, double), objects take the fields
of both, arrays join their elements, and null gives way; anything else has no common type and
stays a variant.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from keelson.operators.schema import FALLBACK_DDL, _inferred_type

#: A type: its name, or a dict of fields (object), or a list of one type (array).
Kind = str | dict | list


def parse_kind(ddl: str) -> Kind:
    """The type that a text of ``schema_of_variant_agg`` describes."""
    def name(at: int) -> tuple[str, int]:
        end = at
        if ddl[at] == "`":
            end = at + 1
            while ddl[end] != "`" or ddl[end:end + 2] == "``":
                end += 2 if ddl[end] == "`" else 1
            end += 1
        else:
            end = ddl.index(":", at)
        return ddl[at:end], ddl.index(" ", end) + 1

    def kind(at: int) -> tuple[Kind, int]:
        if ddl.startswith("OBJECT<", at):
            at, fields = at + 7, {}
            while ddl[at] != ">":
                key, at = name(at)
                fields[key], at = kind(at)
                at += 2 if ddl[at] == "," else 0
            return fields, at + 1
        if ddl.startswith("ARRAY<", at):
            element, at = kind(at + 6)
            return [element], at + 1
        end = at
        while end < len(ddl) and ddl[end] not in ",>":
            end = ddl.index(")", end) + 1 if ddl[end] == "(" else end + 1
        return ddl[at:end], end

    return kind(0)[0]


def kind_text(kind: Kind) -> str:
    if isinstance(kind, dict):
        plain = lambda k: k[1:-1].replace("``", "`") if k[0] == "`" else k
        return f"OBJECT<{', '.join(f'{k}: {kind_text(kind[k])}' for k in sorted(kind, key=plain))}>"
    return f"ARRAY<{kind_text(kind[0])}>" if isinstance(kind, list) else kind


def _digits(kind: str) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if kind == "BIGINT":
        return 20, 0
    if kind.startswith("DECIMAL("):
        precision, scale = map(int, kind[8:-1].split(","))
        return precision - scale, scale
    return None


def join_kinds(a: Kind, b: Kind) -> Kind:
    """The least type that holds the values of both."""
    if a == b or b == "VOID":
        return a
    if a == "VOID":
        return b
    if isinstance(a, dict) and isinstance(b, dict):
        return {k: join_kinds(a.get(k, "VOID"), b.get(k, "VOID")) for k in (*a, *(b.keys() - a.keys()))}
    if isinstance(a, list) and isinstance(b, list):
        return [join_kinds(a[0], b[0])]
    if not (isinstance(a, str) and isinstance(b, str)):
        return "VARIANT"
    exact = _digits(a), _digits(b)
    if None not in exact:
        whole, part = (max(x) for x in zip(*exact))
        return f"DECIMAL({whole + part},{part})" if whole + part <= 38 else "DOUBLE"
    if all(k == "DOUBLE" or d for k, d in zip((a, b), exact)):
        return "DOUBLE"
    return "VARIANT"


class SchemaLog:
    """Summaries of batches below ``path``, one folder a batch. The same batch again replaces its
    summary; ``add`` can be the function of ``foreachBatch``."""

    def __init__(self, spark: SparkSession, path: str, json_col: str):
        self.spark, self.path, self.json_col = spark, path.rstrip("/"), json_col

    def add(self, df: DataFrame, batch: int | str) -> None:
        kind = F.schema_of_variant_agg(F.try_parse_json(F.col(self.json_col)))
        (df.agg(kind.alias("kind"), F.count(self.json_col).alias("records"))
         .write.mode("overwrite").parquet(f"{self.path}/batch={batch}"))

    def kind(self) -> Kind:
        try:  # a growing source repeats itself: different texts only, each as long as a schema
            found = self.spark.read.parquet(self.path).select("kind").distinct().collect()
        except AnalysisException:
            found = []
        return reduce(join_kinds, (parse_kind(r.kind) for r in found if r.kind), "VOID")

    def schema(self, fallback: bool = False) -> str | None:
        """DDL of all batches, as ``infer_schema`` gives it for all their rows; without any
        sample None, or the fixed schema with ``fallback``."""
        kind = self.kind()
        if kind == "VOID":
            return FALLBACK_DDL if fallback else None
        return _inferred_type(kind_text(kind))

    def as_frame(self) -> DataFrame:
        return self.spark.createDataFrame([(self.schema(),)], "ddl string")
