"""Canonical table schemas of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE_JSON_SCHEMA = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("groupId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        # a string field keeps a nested JSON object as its raw text
        T.StructField("event", T.StringType()),
    ]
)

# Subscription configuration as it arrives: every value is text or absent.
RAW_SUBSCRIPTION_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("subscriber", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("http_method", T.StringType()),
        T.StructField("elements", T.StringType()),
        T.StructField("per", T.StringType()),
        T.StructField("max_connections", T.StringType()),
        T.StructField("min_back_off", T.StringType()),
        T.StructField("max_back_off", T.StringType()),
        T.StructField("max_retries", T.StringType()),
        T.StructField("filter_path", T.StringType()),
    ]
)

SUBSCRIPTION_COLUMNS = [
    "topic",
    "subscriber",
    "uri",
    "http_method",
    "elements",
    "per_ms",
    "max_connections",
    "min_backoff_ms",
    "max_backoff_ms",
    "max_retries",
    "filter_path",
]
