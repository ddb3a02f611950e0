"""Times as microseconds since 1970-01-01 UTC, whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def ntz_micros(ts: Column) -> Column:
    """Microseconds of a zone-less timestamp, read as UTC.

    Built from the parts of the value: going through TIMESTAMP would shift the hours that a
    daylight-saving change skips in the session time zone.
    """
    second = (F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint")
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * F.lit(86_400_000_000)
        + F.hour(ts).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(ts).cast("bigint") * F.lit(60_000_000)
        + second
    )


def micros_ntz(micros: Column) -> Column:
    """The zone-less UTC timestamp of a number of microseconds."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH))


def micros_of(column: Column, dtype: T.DataType) -> Column:
    """Microseconds of a timestamp column of either kind."""
    return ntz_micros(column) if isinstance(dtype, T.TimestampNTZType) else F.unix_micros(column)


def rfc3339(column: Column, dtype: T.DataType) -> Column:
    """UTC RFC 3339 text of a date or timestamp, without trailing zeros in the fraction."""
    if isinstance(dtype, T.TimestampType):
        column = micros_ntz(F.unix_micros(column))
    text = column.cast("timestamp_ntz").cast("string")
    return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))
