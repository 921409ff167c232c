"""Typing untyped records with column expressions.

A record arrives as JSON text or VARIANT. ``coerce`` walks a Spark ``DataType`` and
builds one expression tree per field, so typing runs inside whole-stage codegen with
no Python per row. Semantics follow the reference's conversion rules:

* struct: declared fields only; missing nullable → null; missing non-nullable, ``{}`` and
  non-objects are errors; an explicit null passes.
* array: list → element-wise; a scalar becomes a one-element list when the array
  allows nulls, else error.  map: object → keys and values coerced.
* integer: text with ``.`` goes through double and truncates; other text parses as an
  integer; numbers truncate toward zero; booleans are 1/0; blank text is an error. Text
  must be a plain decimal number (no type suffix, no hexadecimal).
* double: text parse (exponents, nan, inf, padding, same pattern); booleans 1.0/0.0.
* decimal: text or number; booleans are errors.
* boolean: true/t/yes/y/1 and false/f/no/n/0 in any case; other non-empty text is true,
  empty text false; numbers by non-zero; objects/lists by non-empty.
* date: ``yyyy-M-d``, ``M/d/yyyy``, ``d-M-yyyy``, ``yyyy/M/d``, then ISO (the date part).
* timestamp: ISO (dates by month or week, basic or extended form, ``Z`` or offsets, no zone
  names, no padding), then ``yyyy-M-d H:m:s``, ``yyyy/M/d H:m:s``; numbers are epoch seconds.
* binary: lenient base64 (foreign characters dropped, length a multiple of 4), else hex,
  else UTF-8 of the text; a list of ints 0..255 is the bytes; other values UTF-8 of JSON.
* string: the text itself; other values their JSON text (decision D2).
* variant: text is parsed as JSON, other values are kept.

Errors are collected per row as ``array<string>``. ``mode='strict'`` fails the job on the
first bad row (``raise_error``); ``mode='permissive'`` returns nulls plus ``_errors``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The boolean words of the reference conversion rules.
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]
# The date formats tried in order before ISO (reference order).
DATE_FORMATS = ["yyyy-M-d", "M/d/yyyy", "d-M-yyyy", "yyyy/M/d"]
TIMESTAMP_FORMATS = ["yyyy-M-d H:m:s", "yyyy/M/d H:m:s"]
# Shapes of numbers in text, and of ISO dates and times.
INTEGER_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
DOUBLE_TEXT = (r"(?i)^\s*[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf(inity)?|nan)\s*$")
ISO_DAY = r"(\d{4}-\d{2}-\d{2}|\d{8})"
ISO_WEEK = r"(\d{4})-?W(\d{2})(?:-?([1-7]))?"
ISO_TIME = r"(\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?)(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?"

ERRORS = "_errors"
_NUM = "^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class _V:
    """Kind tests on one VARIANT value."""

    def __init__(self, v: Column):
        self.v = v
        self.kind = F.schema_of_variant(v)
        self.null = _absent(v)
        self.text = F.try_variant_get(v, "$", "string")
        self.is_str = self.kind == "STRING"
        self.is_bool = self.kind == "BOOLEAN"
        self.is_num = self.kind.rlike(_NUM)
        self.is_obj = self.kind.startswith("OBJECT")
        self.is_arr = self.kind.startswith("ARRAY")


def _err(cond: Column, path: str, what: str, shown: Column | None = None) -> Column:
    msg = F.concat(F.lit(f"{path}: cannot convert "), F.coalesce(shown, F.lit("value")),
                   F.lit(f" to {what}")) if shown is not None else F.lit(f"{path}: {what}")
    return F.when(cond, F.array(msg))


def _path(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


def _pack(errs: list[Column]) -> Column:
    if not errs:
        return F.array().cast("array<string>")
    return F.flatten(F.array_compact(F.array(*errs)))


def _digits(s: Column) -> Column:
    """Number text without padding and digit groups."""
    return F.regexp_replace(F.trim(s), "_", "")


def _text_integer(s: Column) -> Column:
    """Integer parse of text: ``.`` → through double; else integer text (``_`` digit groups ok)."""
    return (F.when(s.contains("."), _try_double(s).try_cast("bigint"))
            .when(s.rlike(INTEGER_TEXT), _digits(s).try_cast("bigint")))


def _try_double(s: Column) -> Column:
    return F.when(s.rlike(DOUBLE_TEXT), _digits(s).try_cast("double"))


def _iso_day(s: Column) -> Column:
    """Day of an ISO text: calendar or week date, each basic or extended; null if there is none."""
    calendar = F.regexp_replace(F.regexp_extract(s, f"^{ISO_DAY}", 1), "-", "")
    year, week = F.regexp_extract(s, f"^{ISO_WEEK}", 1), F.regexp_extract(s, f"^{ISO_WEEK}", 2).try_cast("int")
    weekday = F.coalesce(F.nullif(F.regexp_extract(s, f"^{ISO_WEEK}", 3), F.lit("")), F.lit("1")).cast("int")
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")  # always in week 1
    monday = F.date_sub(fourth, F.weekday(fourth))
    in_year = F.date_add(monday, (week - 1) * 7 + weekday - 1)
    last = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))  # always in the last week
    return F.coalesce(F.try_to_date(F.nullif(calendar, F.lit("")), "yyyyMMdd"), F.when(week.between(1, last), in_year))


def _iso_timestamp(s: Column) -> Column:
    """Instant of an ISO text (UTC without offset); null where the text is not wholly ISO."""
    pattern = rf"^(?:{ISO_DAY}|{ISO_WEEK})(?:.{ISO_TIME})?$"
    part = lambda g: F.regexp_extract(s, pattern, g)
    time = F.regexp_replace(F.regexp_replace(part(5), ":", ""), ",", ".")
    two = lambda at: F.coalesce(F.nullif(F.substring(time, at, 2), F.lit("")), F.lit("00"))
    fraction = F.rpad(F.substring(F.regexp_extract(time, r"\.(\d+)", 1), 1, 6), 6, "0")
    offset = F.regexp_replace(part(6), ":", "")
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    shift = F.when((offset == "") | (offset == "Z"), F.lit(0)).otherwise(
        sign * (F.substring(offset, 2, 2).cast("int") * 3600
                + F.coalesce(F.substring(offset, 4, 2).try_cast("int"), F.lit(0)) * 60
                + F.coalesce(F.substring(offset, 6, 2).try_cast("int"), F.lit(0))))
    local = F.concat(_iso_day(s).cast("string"), F.lit(" "), two(1), F.lit(":"), two(3), F.lit(":"), two(5),
                     F.lit("."), fraction, F.lit("Z")).try_cast("timestamp")
    return F.when(s.rlike(pattern), F.timestamp_micros(F.unix_micros(local) - shift.cast("bigint") * 1_000_000))


def _date_from_text(s: Column) -> Column:
    plain = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s.try_cast("date"))
    tries = [F.try_to_date(s, f) for f in DATE_FORMATS]
    return F.coalesce(plain, *tries, F.when(_iso_timestamp(s).isNotNull(), _iso_day(s)))


def _ts_from_text(s: Column) -> Column:
    plain = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"), s.try_cast("timestamp"))
    others = [F.try_to_timestamp(s, F.lit(f)) for f in TIMESTAMP_FORMATS]
    return F.coalesce(plain, _iso_timestamp(s), *others)


def _binary_from_text(s: Column) -> Column:
    clean = F.regexp_replace(s, "[^A-Za-z0-9+/=]", "")
    b64_ok = (F.length(clean) % 4 == 0) & clean.rlike("^[A-Za-z0-9+/]*={0,2}$")
    hex_ok = s.rlike(r"^\s*([0-9A-Fa-f]{2}\s*)*$")
    return (F.when(b64_ok, F.unbase64(clean))
            .when(hex_ok, F.unhex(F.regexp_replace(s, r"\s", "")))
            .otherwise(F.encode(s, "UTF-8")))


def _bool_from_text(s: Column) -> Column:
    low = F.lower(s)
    return (F.when(low.isin(TRUE_WORDS), F.lit(True))
            .when(low.isin(FALSE_WORDS), F.lit(False))
            .otherwise(F.length(s) > 0))


def _let(x: Column, body) -> Column:
    """``body(x)`` with ``x`` evaluated once, however often the body refers to it."""
    return F.transform(F.array(x), body)[0]


def _pair(value: Column, errors: Column) -> Column:
    return F.struct(value.alias("v"), errors.alias("e"))


def _coerced(v: Column, dtype: T.DataType, path: str) -> Column:
    """struct(v = value, e = errors) of a VARIANT. Each level refers to the level below once,
    so the expression grows in proportion to the type."""
    if isinstance(dtype, T.StructType):
        def struct_of(x: Column) -> Column:
            k = _V(x)
            ok = k.is_obj & (k.kind != "OBJECT<>")
            get = {f.name: F.try_variant_get(x, _path(f.name), "variant") for f in dtype.fields}
            members = F.struct(*[_coerced(get[f.name], f.dataType, f"{path}.{f.name}").alias(f"m{i}")
                                 for i, f in enumerate(dtype.fields)])
            missing = [_err(get[f.name].isNull(), f"{path}.{f.name}", "missing non-nullable field")
                       for f in dtype.fields if not f.nullable]
            typed = _let(members, lambda m: _pair(
                F.struct(*[m[f"m{i}"]["v"].alias(f.name) for i, f in enumerate(dtype.fields)]),
                _pack([m[f"m{i}"]["e"] for i in range(len(dtype.fields))] + missing)))
            wrong = _pack([_err(~k.null & ~k.is_obj, path, "a struct", k.text),
                           _err(k.kind == "OBJECT<>", path, "empty object for a struct")])
            return F.when(ok, typed).otherwise(_pair(F.lit(None).cast(_nullable(dtype)), wrong))
        return _let(v, struct_of)

    if isinstance(dtype, T.ArrayType):
        def array_of(x: Column) -> Column:
            k = _V(x)
            elements = F.try_variant_get(x, "$", "array<variant>")
            if dtype.containsNull:
                elements = F.when(k.null, F.lit(None)).when(k.is_arr, elements).otherwise(F.array(x))
                wrong = F.array().cast("array<string>")
            else:
                elements = F.when(k.is_arr, elements)
                wrong = _pack([_err(~k.null & ~k.is_arr, path, "an array", k.text)])
            typed = F.transform(elements, lambda e: _coerced(e, dtype.elementType, f"{path}[]"))
            return _let(typed, lambda t: _pair(F.transform(t, lambda p: p["v"]).cast(_nullable(dtype)), F.concat(
                wrong, F.coalesce(F.flatten(F.transform(t, lambda p: p["e"])), F.array().cast("array<string>")))))
        return _let(v, array_of)

    if isinstance(dtype, T.MapType):
        def map_of(x: Column) -> Column:
            k = _V(x)
            entries = F.map_entries(F.when(k.is_obj, F.try_variant_get(x, "$", "map<string,variant>")))
            typed = F.transform(entries, lambda e: F.struct(
                _coerced_text(e["key"], dtype.keyType, f"{path}{{key}}").alias("k"),
                _coerced(e["value"], dtype.valueType, f"{path}{{}}").alias("x")))
            wrong = _pack([_err(~k.null & ~k.is_obj, path, "a map", k.text)])
            return _let(typed, lambda t: _pair(
                F.map_from_entries(F.transform(F.filter(t, lambda p: p["k"]["v"].isNotNull()),
                                               lambda p: F.struct(p["k"]["v"], p["x"]["v"]))).cast(_nullable(dtype)),
                F.concat(wrong, F.coalesce(F.flatten(F.transform(t, lambda p: F.concat(p["k"]["e"], p["x"]["e"]))),
                                           F.array().cast("array<string>")))))
        return _let(v, map_of)

    def scalar_of(x: Column) -> Column:
        return _let(_scalar(x, dtype, path), lambda r: _pair(r, _pack(_scalar_errors(x, r, dtype, path))))
    return _let(v, scalar_of)


def _coerced_text(s: Column, dtype: T.DataType, path: str) -> Column:
    """The same for a text column (map keys)."""
    if isinstance(dtype, T.StringType):
        return _pair(s, F.array().cast("array<string>"))
    v = F.try_parse_json(F.to_json(F.struct(s.alias("x"))))
    return _coerced(F.try_variant_get(v, "$.x", "variant"), dtype, path)


def _nullable(dtype: T.DataType) -> T.DataType:
    """The type with every inner value nullable: what an expression can promise."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_nullable(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(_nullable(dtype.keyType), _nullable(dtype.valueType), True)
    return dtype


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


_NUMBERS = (T.DecimalType, T.DoubleType, T.FloatType, *_INTEGRAL)


def _fast(text: Column, dtype: T.DataType) -> Column | None:
    """Value of a JSON scalar from its text, whether it was quoted or not, where the plain cast
    agrees with the rules; null where it may not. None for types that need the kind."""
    if isinstance(dtype, T.StringType):
        return F.when(~F.substring(text, 1, 1).isin("{", "["), text)
    if isinstance(dtype, _INTEGRAL):
        return text.try_cast(dtype)
    if isinstance(dtype, _NUMBERS):  # ends in a digit: no type suffix, no word
        return F.when(F.substring(text, -1, 1).between("0", "9") & ~text.contains("x") & ~text.contains("X"), text.try_cast(dtype))
    if isinstance(dtype, T.BooleanType):
        return F.when(text == "true", True).when(text == "false", False)
    if isinstance(dtype, T.DateType):
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"),
                      text.try_cast("timestamp").cast(dtype))
    return None


def _absent(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def _scalar_errors(v: Column, value: Column, dtype: T.DataType, path: str) -> list[Column]:
    """Messages for a value that is there but gave none. Text takes anything and any
    boolean text has a value."""
    if isinstance(dtype, (T.StringType, T.BooleanType)):
        return []
    what = "variant (bad JSON)" if isinstance(dtype, T.VariantType) else dtype.simpleString()
    return [_err(~_absent(v) & value.isNull(), path, what, F.try_variant_get(v, "$", "string"))]


def _scalar(v: Column, dtype: T.DataType, path: str) -> Column:
    """Value of a VARIANT under the rules of a scalar type; null where it has none."""
    k = _V(v)
    notnull = ~k.null
    tname = dtype.simpleString()

    if isinstance(dtype, T.VariantType):
        parsed = F.try_parse_json(k.text)
        return F.when(k.null, F.lit(None)).when(k.is_str, parsed).otherwise(v)

    if isinstance(dtype, T.StringType):
        return F.when(notnull, k.text)

    if isinstance(dtype, _INTEGRAL):
        num = F.try_variant_get(v, "$", "bigint")
        val = F.when(k.is_str, _text_integer(k.text)).when(k.is_num | k.is_bool, num)
        return val if isinstance(dtype, T.LongType) else val.try_cast(dtype)

    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        num = F.try_variant_get(v, "$", "double")
        val = F.when(k.is_str, _try_double(k.text)).when(k.is_num | k.is_bool, num)
        return val.cast("float") if isinstance(dtype, T.FloatType) else val

    if isinstance(dtype, T.DecimalType):
        return (F.when(k.is_str, F.trim(k.text).try_cast(dtype))
                .when(k.is_num, F.try_variant_get(v, "$", tname)))

    if isinstance(dtype, T.BooleanType):
        arr = F.try_variant_get(v, "$", "array<variant>")
        return (F.when(k.null, F.lit(None))
                .when(k.is_str, _bool_from_text(k.text))
                .when(k.is_bool, F.try_variant_get(v, "$", "boolean"))
                .when(k.is_num, F.try_variant_get(v, "$", "double") != 0)
                .when(k.is_obj, k.kind != "OBJECT<>")
                .when(k.is_arr, F.size(arr) > 0)).cast("boolean")

    if isinstance(dtype, T.DateType):
        return F.when(k.is_str, _date_from_text(k.text))

    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        secs = F.when(k.is_bool, F.try_variant_get(v, "$", "boolean").cast("double")) \
            .otherwise(F.try_variant_get(v, "$", "double"))
        val = (F.when(k.is_str, _ts_from_text(k.text))
               .when(k.is_num | k.is_bool, F.timestamp_seconds(secs)))
        return val.cast(dtype)

    if isinstance(dtype, T.BinaryType):
        ints = F.try_variant_get(v, "$", "array<bigint>")
        bad_ints = F.exists(ints, lambda x: x.isNull() | (x < 0) | (x > 255))
        from_ints = F.unhex(F.array_join(F.transform(ints, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
        return (F.when(k.null, F.lit(None).cast("binary"))
                .when(k.is_str, _binary_from_text(k.text))
                .when(k.is_arr, F.when(~bad_ints, from_ints))
                .otherwise(F.encode(k.text, "UTF-8")))

    raise ValueError(f"{path}: unsupported type {tname}")


def coerce(v: Column, dtype: T.DataType, path: str = "$") -> tuple[Column, Column]:
    """Coerce a VARIANT column to ``dtype``. Returns ``(value, errors array<string>)``."""
    built = _coerced(v, dtype, path)
    return built["v"], built["e"]


def strict(value: Column, errors: Column) -> Column:
    """The value, or a job failure naming the problems of the first bad row."""
    return F.when(F.size(errors) > 0, F.raise_error(F.concat_ws("; ", errors))).otherwise(value)


def _typed(df: DataFrame, source: str, schema: T.StructType, mode: str, keep: list[str],
           text: bool) -> DataFrame:
    """Type a record column (JSON text or VARIANT) in staged projections: each stage refers
    to the one before as columns, so nothing is evaluated twice per row.

    JSON text goes through one ``from_json`` pass, inside a list so that text after the
    record is an error and not overlooked. Scalar fields come out as text, and a plain cast
    types them; only a row in which that does not settle every field is parsed once more, as
    VARIANT, and only those fields are worked out by kind. Other fields come out as VARIANT.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    fields = list(enumerate(schema.fields))
    src = F.col(source)
    quick = {i: text and _fast(F.col(f"__t{i}"), f.dataType) is not None for i, f in fields}
    t = lambda i: F.col(f"__t{i}")
    if text:
        landed = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType() if quick[i] else T.VariantType()) for i, f in fields]))
        s = df.select(*keep, src.alias("__j"), F.from_json(F.concat(F.lit("["), src, F.lit("]")), landed).alias("__a"))
        s = s.select(*keep, "__j", F.coalesce(F.size("__a") == 1, F.lit(False)).alias("__one"),
                     *[F.get("__a", F.lit(0))[f.name].alias(f"__t{i}") for i, f in fields])
        raw = F.col("__j")
        listed = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
        whole = F.when(F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))
    else:
        s = df.select(*keep, src.alias("__j"), F.lit(True).alias("__one"),
                      *[F.try_variant_get(src, _path(f.name), "variant").alias(f"__t{i}") for i, f in fields])
        raw = whole = F.col("__j")
    s = s.select("*", *[_fast(t(i), f.dataType).alias(f"__q{i}") for i, f in fields if quick[i]])
    none, open_ = F.lit(True), F.lit(False)
    for i, f in fields:
        none = none & t(i).isNull()
        if quick[i]:
            open_ = open_ | (t(i).isNotNull() & F.col(f"__q{i}").isNull())
        if not f.nullable:
            open_ = open_ | t(i).isNull()
    s = s.select("*", (~F.col("__one") | none).alias("__odd"), F.when(~F.col("__one") | none | open_, whole).alias("__w"))
    w, odd = F.col("__w"), F.col("__odd")
    kind = F.schema_of_variant(w)
    bad = odd & raw.isNotNull() & w.isNull()
    null = raw.isNull() | (odd & F.coalesce(F.is_variant_null(w), F.lit(False)))
    record = ~odd | (kind.startswith("OBJECT") & (kind != "OBJECT<>"))
    s = s.select("*", F.coalesce(~null & ~bad & record, F.lit(False)).alias("__ok"))
    ok = F.col("__ok")

    def value(i: int, f: T.StructField) -> Column:
        if _is_nested(f.dataType):
            return F.when(ok, _coerced(t(i), f.dataType, f"$.{f.name}"))
        if not quick[i]:
            return F.when(ok & ~_absent(t(i)), _scalar(t(i), f.dataType, f"$.{f.name}"))
        slow = F.when(ok & t(i).isNotNull(), _scalar(F.try_variant_get(w, _path(f.name), "variant"), f.dataType, f"$.{f.name}"))
        return F.when(F.col(f"__q{i}").isNotNull(), F.col(f"__q{i}")).otherwise(slow)

    s = s.select(*[c for c in s.columns if not c.startswith("__q")], *[value(i, f).alias(f"__x{i}") for i, f in fields])
    shown = raw if text else F.try_variant_get(raw, "$", "string")
    errs = [_err(bad, "$", "bad JSON"),
            _err(odd & ~null & ~bad & ~kind.startswith("OBJECT"), "$", "a struct", shown),
            _err(odd & ~null & (kind == "OBJECT<>"), "$", "empty object for a struct")]
    out = []
    for i, f in fields:
        x, path = F.col(f"__x{i}"), f"$.{f.name}"
        nested = _is_nested(f.dataType)
        out.append((x["v"] if nested else x).alias(f.name))
        if nested:
            own = [x["e"]]
        elif quick[i]:
            own = [] if isinstance(f.dataType, (T.StringType, T.BooleanType)) else [
                _err(t(i).isNotNull() & x.isNull(), path, f.dataType.simpleString(), t(i))]
        else:
            own = _scalar_errors(t(i), x, f.dataType, path)
        errs += [F.when(ok, e) for e in own]
        if not f.nullable:
            there = F.try_variant_get(w, _path(f.name), "variant")
            errs.append(_err(ok & t(i).isNull() & there.isNull(), path, "missing non-nullable field"))
    typed = F.when(ok, F.struct(*out))
    if mode == "strict":
        return s.select(*keep, strict(typed, _pack(errs)).alias("__r")).select(*keep, "__r.*")
    return s.select(*keep, typed.alias("__r"), _pack(errs).alias(ERRORS)).select(*keep, "__r.*", ERRORS)


def coerce_variant_column(df: DataFrame, col: str, schema: T.StructType, mode: str = "strict",
                          keep: list[str] | None = None) -> DataFrame:
    """C14: a VARIANT record column → typed columns of ``schema`` (+ ``_errors`` if permissive)."""
    return _typed(df, col, schema, mode, list(keep or []), text=False)


def coerce_json(df: DataFrame, col: str, schema: T.StructType, mode: str = "strict",
                keep: list[str] | None = None) -> DataFrame:
    """C14: a JSON text column → typed columns of ``schema``.

    Bad JSON fails the job in strict mode and is reported in ``_errors`` in permissive mode.
    """
    return _typed(df, col, schema, mode, list(keep or []), text=True)
