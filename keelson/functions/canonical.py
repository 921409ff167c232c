"""Values in a form that can be compared, hashed and ordered.

Spark refuses MAP and VARIANT in hashes, comparisons and sorts. A map becomes its entries in
key order, a variant its JSON text (object keys are sorted there), at any depth; every other
value stays as it is. Two values are the same exactly when their forms are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _refused(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return _refused(kind.elementType)
    return isinstance(kind, T.StructType) and any(_refused(f.dataType) for f in kind.fields)


def canonical(value: Column, kind: T.DataType) -> Column:
    """The comparable form of ``value`` of type ``kind``; null stays null."""
    if not _refused(kind):
        return value
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(canonical(e["key"], kind.keyType).alias("key"),
                                   canonical(e["value"], kind.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(value), entry))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: canonical(e, kind.elementType))
    fields = [canonical(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def canonical_columns(df: DataFrame, cols: list[str] | None = None) -> list[Column]:
    return [canonical(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in cols or df.columns]


def row_hash(df: DataFrame, cols: list[str] | None = None, seed: int = 0) -> Column:
    """64-bit hash of the named columns (default: all) and their names, whatever their order;
    another ``seed`` gives another hash. Columns that are null do not count, nor does the width
    of a number: a row hashes alike before and after a column is added or widened."""
    out = F.lit(seed).cast("bigint")
    for c in cols or df.columns:
        kind = df.schema[c].dataType
        value = canonical(F.col(f"`{c}`"), kind)
        if isinstance(kind, T.IntegralType):
            value = value.cast("bigint")
        elif isinstance(kind, T.FloatType):
            value = value.cast("double")
        out = out.bitwiseXOR(F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(f"{seed}:{c}"), value)))
    return out
