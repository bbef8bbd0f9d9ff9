"""Duration text (``3.seconds``, ``100 millis``, ``10m``) -> milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: duration unit names and their length in milliseconds ----
UNIT_MS = {
    "ns": 1e-6, "nano": 1e-6, "nanos": 1e-6, "nanosecond": 1e-6, "nanoseconds": 1e-6,
    "us": 1e-3, "micro": 1e-3, "micros": 1e-3, "microsecond": 1e-3, "microseconds": 1e-3,
    "ms": 1.0, "milli": 1.0, "millis": 1.0, "millisecond": 1.0, "milliseconds": 1.0,
    "s": 1e3, "second": 1e3, "seconds": 1e3,
    "m": 6e4, "minute": 6e4, "minutes": 6e4,
    "h": 3.6e6, "hour": 3.6e6, "hours": 3.6e6,
    "d": 8.64e7, "day": 8.64e7, "days": 8.64e7,
}

_DURATION_RE = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*\.?\s*([A-Za-z]*)\s*$"


def parse_duration_ms(text: Column | str) -> Column:
    """BIGINT milliseconds, or NULL when the text is not a duration.

    A bare number is milliseconds. Fractions of a millisecond are dropped.
    """
    c = F.col(text) if isinstance(text, str) else text
    num = F.regexp_extract(c, _DURATION_RE, 1)
    unit = F.lower(F.regexp_extract(c, _DURATION_RE, 2))
    factor = F.when(unit == "", F.lit(1.0))
    for name, ms in UNIT_MS.items():
        factor = factor.when(unit == name, F.lit(ms))
    ok = c.rlike(_DURATION_RE)
    return F.when(ok, F.floor(num.try_cast("double") * factor).cast("bigint"))


def duration_sql(col: str) -> str:
    """The same parse in portable SQL (used by the DuckDB oracle)."""
    num = f"regexp_extract({col}, '{_DURATION_RE}', 1)"
    unit = f"lower(regexp_extract({col}, '{_DURATION_RE}', 2))"
    cases = " ".join(f"WHEN {unit} = '{n}' THEN {ms!r}" for n, ms in UNIT_MS.items())
    return (
        f"CASE WHEN regexp_matches({col}, '{_DURATION_RE}') THEN "
        f"CAST(floor(CAST({num} AS DOUBLE) * CASE WHEN {unit} = '' THEN 1.0 {cases} END) AS BIGINT) END"
    )
