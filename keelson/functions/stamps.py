"""Change stamps and page links as column expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso_text(ts: Column) -> Column:
    """ISO 8601 text of a UTC instant: ``2024-06-30T12:00:00+00:00``, micros only when non-zero."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.when(F.date_format(ts, "SSSSSS") != "000000",
                  F.concat(F.lit("."), F.date_format(ts, "SSSSSS"))).otherwise(F.lit(""))
    return F.concat(base, frac, F.lit("+00:00"))


def typed_stamp(dtype: T.DataType, at) -> Column:
    """A change stamp matching the declared field type.

    Date fields get the date; timestamp fields the instant; text fields the ISO date for
    a field declared ``date`` in a text schema is not knowable, so text gets ISO timestamp.
    ``at`` is a datetime or a timestamp column (e.g. the batch time).
    """
    if isinstance(at, Column):
        at_c = at
    else:
        if isinstance(at, datetime.datetime) and at.tzinfo is not None:
            at = at.astimezone(datetime.timezone.utc).replace(tzinfo=None)
        at_c = F.lit(str(at)).cast("timestamp_ntz")  # UTC wall clock, no Python time zone
    if isinstance(dtype, T.DateType):
        return at_c.cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return at_c.cast(dtype)
    if isinstance(dtype, T.StringType):
        return iso_text(at_c.cast("timestamp"))
    raise ValueError(f"no change stamp for type {dtype.simpleString()}")


def absolute_link(base: Column | str, link: Column) -> Column:
    """A link starting with ``http`` is kept; else base (trailing ``/`` cut) + link."""
    b = F.lit(base) if isinstance(base, str) else base
    return F.when(link.startswith("http"), link).otherwise(
        F.concat(F.regexp_replace(b, "/+$", ""), link))
