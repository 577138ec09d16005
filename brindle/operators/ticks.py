"""Times and whole numbers on one axis of 64-bit numbers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.sources.shared import quoted


def ticks(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp (with or without a zone), days of a date, a whole number as it is."""
    kind, c = df.schema[name].dataType, F.col(quoted(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):  # no session's time zone plays a part
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {quoted(name)})")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"column {name} is {kind.simpleString()}: a time or a whole number is needed")


def length(df: DataFrame, name: str, span: timedelta | int) -> int:
    """A span in the ticks of a column."""
    if isinstance(span, int):
        return span
    if isinstance(df.schema[name].dataType, T.DateType):
        return span // timedelta(days=1)
    return span // timedelta(microseconds=1)
