"""Column builders for delivery results: retry decision, outcome, tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fanline import constants as C


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_retryable(code: Column | str, error_class: Column | str, error_message: Column | str) -> Column:
    """retry in place iff 5xx, 429, a request timeout, or a closed connection.

    Any other failure (another exception, 1xx-4xx) is not retried in place.
    """
    code, err, msg = _c(code), _c(error_class), _c(error_message)
    by_code = code.between(500, 599) | (code == 429)
    by_error = (err == C.REQUEST_TIMEOUT_CLASS) | F.coalesce(msg.contains(C.CLOSED_CONNECTION_TEXT), F.lit(False))
    return F.when(code.isNotNull(), by_code).otherwise(F.coalesce(by_error, F.lit(False)))


def classify_outcome(code: Column | str) -> Column:
    """2xx Sent; 429 and 5xx Failed; other codes Removed; no response Failed."""
    code = _c(code)
    return (
        F.when(code.isNull(), F.lit(C.FAILED_OUTCOME))
        .when(code.between(200, 299), F.lit(C.SENT))
        .when(code == 429, F.lit(C.FAILED_OUTCOME))
        .when(code.between(500, 599), F.lit(C.FAILED_OUTCOME))
        .otherwise(F.lit(C.REMOVED))
    )


def failed_status(code: Column | str) -> Column:
    """The retry tag: the HTTP code as text, or ``exceptional``."""
    return F.coalesce(_c(code).cast("string"), F.lit(C.EXCEPTIONAL))


def exhausted(failure_count: Column | str, limit: int = C.NUMBER_OF_RETRIES) -> Column:
    """F8: a failing item becomes permanently failed iff count > limit (before +1)."""
    return _c(failure_count) > F.lit(limit)


def subscriber_of_queue(queue: Column | str) -> Column:
    """Inverse of the queue naming rule ``{topic}_{subscriber}_queue``."""
    return F.regexp_extract(_c(queue), r"^[^_]+_(.*)_queue$", 1)
