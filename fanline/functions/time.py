"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_us(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch of column ``name`` of ``df``.

    An instant (TIMESTAMP) uses ``unix_micros``; a local time (TIMESTAMP_NTZ)
    is measured on its own clock with no zone conversion, so TTL bucket
    widths stay exact even when the session zone has daylight saving.
    """
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), F.col(name))
    return F.unix_micros(F.col(name))


def diff_ms(start: Column | str, end: Column | str) -> Column:
    """Whole milliseconds from ``start`` to ``end`` (floor), zone-free."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.floor(F.timestamp_diff("MICROSECOND", s, e) / F.lit(1000)).cast("bigint")
