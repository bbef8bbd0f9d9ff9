"""Mapping of the driver tables onto the engine's inputs.

``events`` rows become EVENT envelopes; the subscription catalog is the fixed
configuration below; ATTEMPT, QUEUE and HEARTBEAT rows are derived from
``events`` by fixed rules so every query's work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.sources.catalog import catalog_from_nested, load_subscriptions
from fanline.sources.tables import read_table

# --- fixed values: fixture subscription configuration ----------------------
FIXTURE_TOPICS = {
    "click": {
        "audit-all": {"uri": "http://localhost:9001/audit-all"},
        "high-k": {"uri": "http://localhost:9001/high-k", "filter-path": "$.event[?(@.props.k >= 50)]"},
    },
    "purchase": {
        "billing": {"uri": "http://localhost:9001/billing"},
        "vip": {"uri": "http://localhost:9001/vip", "http-method": "PUT", "filter-path": "$.event[?(@.user_id < 20)]"},
    },
    "error": {
        "alerts": {"uri": "http://localhost:9001/alerts", "filter-path": "$.event[?(@.event_type =~ /ERR.*/i)]"},
        "pager": {
            "uri": "http://localhost:9001/pager",
            "filter-path": "$.event[?(@.props.k >= 90 && @.event_type == 'error')]",
        },
    },
    "view": {
        "sampler": {"uri": "http://localhost:9001/sampler", "filter-path": "$.event[?(@.props.k < 10)]"},
    },
    "empty": "",
}

# --- fixed values: fixture attempt results by k = props.k -------------------
# (low, high, status_code, error_class, error_message)
ATTEMPT_RESULTS = [
    (0, 59, 200, None, None),
    (60, 69, 503, None, None),
    (70, 77, 429, None, None),
    (78, 85, 400, None, None),
    (86, 91, 301, None, None),
    (92, 94, None, "RequestTimeoutException", None),
    (95, 96, None, "RuntimeException", "The http server closed the connection unexpectedly"),
    (97, 99, None, "IllegalStateException", "boom"),
]

# --- fixed values: fixture clocks -------------------------------------------
QUEUE_AS_OF = "2024-01-15 00:00:00"
HEARTBEAT_TIMEOUT_MS = 6 * 3_600_000
DEDUP_TTL_SECONDS = 24 * 3_600
QUEUE_STATES = [C.TODO, C.FAILED, C.IN_PROGRESS, C.PERMANENTLY_FAILED]


def k_of(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def with_k(ev: DataFrame) -> tuple[DataFrame, Column]:
    """Extract k once, in its own projection (the rules below use it many times)."""
    return ev.withColumn("_k", k_of(F.col("props"))), F.col("_k")


def envelope_json(event_type: Column, user_id: Column, props: Column) -> Column:
    """The event payload as JSON text (only ints and strings, so both engines agree)."""
    return F.concat(
        F.lit('{"event":{"event_type":"'), event_type,
        F.lit('","user_id":'), user_id.cast("string"),
        F.lit(',"props":'), props, F.lit("}}"),
    )


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVENT rows: topic/subject = event_type, group_id = user_id, ts twice."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("topic"),
        F.col("event_id"),
        F.col("event_type").alias("subject"),
        F.col("user_id").alias("group_id"),
        F.col("ts").alias("timestamp"),
        envelope_json(F.col("event_type"), F.col("user_id"), F.col("props")).alias("event"),
        F.col("ts").alias("received_at"),
    )


def fixture_catalog(spark: SparkSession) -> DataFrame:
    return load_subscriptions(catalog_from_nested(spark, FIXTURE_TOPICS))


_INDEX: dict = {}


def fixture_index(spark: SparkSession):
    """The fixture catalog's index, built once per session (configuration is
    loaded once at start, as a service would)."""
    from fanline.operators.matching import SubscriptionIndex

    key = id(spark)
    if key not in _INDEX:
        _INDEX[key] = SubscriptionIndex.build(fixture_catalog(spark))
    return _INDEX[key]


def attempt_result_columns(k: Column) -> list[Column]:
    code = error = message = None
    for lo, hi, c, e, m in ATTEMPT_RESULTS:
        cond = k.between(lo, hi)
        code = (F.when(cond, F.lit(c)) if code is None else code.when(cond, F.lit(c))) if c is not None else code
        error = (F.when(cond, F.lit(e)) if error is None else error.when(cond, F.lit(e))) if e is not None else error
        message = (F.when(cond, F.lit(m)) if message is None else message.when(cond, F.lit(m))) if m else message
    return [
        code.cast("int").alias("status_code"),
        error.cast("string").alias("error_class"),
        message.cast("string").alias("error_message"),
    ]


def fixture_attempts_unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ATTEMPT rows before numbering: one per event on queue ``{type}_main_queue``."""
    return attempts_from(read_table(spark, sf_dir, "events"))


def attempts_from(ev: DataFrame) -> DataFrame:
    """ATTEMPT rows from ``events``-shaped rows (batch or stream)."""
    ev, k = with_k(ev)
    return ev.select(
        F.concat(F.col("event_type"), F.lit("_main_queue")).alias("queue"),
        F.col("user_id").alias("item_id"),
        F.col("event_id").alias("attempt_id"),
        F.col("ts").alias("sent_at"),
        F.floor(F.col("value") * 10).cast("bigint").alias("latency_ms"),
        *attempt_result_columns(k),
    )


def fixture_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QUEUE rows: state by k % 4, failure count k % 6, available k minutes later."""
    return queue_rows_from(read_table(spark, sf_dir, "events"))


def queue_rows_from(ev: DataFrame) -> DataFrame:
    """QUEUE rows from ``events``-shaped rows (batch or stream)."""
    ev, k = with_k(ev)
    state = F.element_at(F.array(*map(F.lit, QUEUE_STATES)), (k % 4) + 1)
    return ev.select(
        F.concat(F.col("event_type"), F.lit("_main_queue")).alias("queue"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("received_at"),
        F.col("ts").alias("updated_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), k)).alias("available_at"),
        state.alias("status"),
        (k % 6).cast("int").alias("failure_count"),
        envelope_json(F.col("event_type"), F.col("user_id"), F.col("props")).alias("item"),
    )


def fixture_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("instance_id"), F.col("ts").alias("seen_at"))


def uuid_of(event_id: Column) -> Column:
    """A deterministic UUID text for a numeric id."""
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.lower(F.hex(event_id)), 12, "0"))


def fixture_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON publish bodies built from ``events``; some are invalid by rule on k:
    89 groupId sent as a number, 90-93 no eventId, 94-95 eventId not a UUID,
    96-97 bad timestamp, 98 no subject, 99 no event payload."""
    ev, k = with_k(read_table(spark, sf_dir, "events"))
    ts_text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    payload = F.concat(
        F.lit('{"event_type":"'), F.col("event_type"), F.lit('","user_id":'), F.col("user_id").cast("string"),
        F.lit(',"props":'), F.col("props"), F.lit("}"),
    )
    eid = F.when(k.between(94, 95), F.concat(F.lit("not-a-uuid-"), F.col("event_id").cast("string"))).otherwise(
        uuid_of(F.col("event_id"))
    )
    parts = F.array_compact(
        F.array(
            F.when(~k.between(90, 93), F.concat(F.lit('"eventId":"'), eid, F.lit('"'))),
            F.when(k != 98, F.concat(F.lit('"subject":"'), F.col("event_type"), F.lit('"'))),
            F.when(k == 89, F.concat(F.lit('"groupId":'), F.col("user_id").cast("string"))).otherwise(
                F.concat(F.lit('"groupId":"'), F.col("user_id").cast("string"), F.lit('"'))
            ),
            F.concat(F.lit('"timestamp":"'), F.when(k.between(96, 97), F.lit("yesterday")).otherwise(ts_text), F.lit('"')),
            F.when(k != 99, F.concat(F.lit('"event":'), payload)),
        )
    )
    return ev.select(
        F.col("event_id").alias("source_id"),
        F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("body"),
    )


def fixture_transport(pdf):
    """A stand-in subscriber endpoint: answers each request by the k in its body."""
    import numpy as np
    import pandas as pd

    k = pdf["body"].str.extract(r'"k":\s*(\d+)')[0].astype(float).to_numpy()
    code = np.full(len(pdf), np.nan)
    err = np.full(len(pdf), None, dtype=object)
    msg = np.full(len(pdf), None, dtype=object)
    for lo, hi, c, e, m in ATTEMPT_RESULTS:
        sel = (k >= lo) & (k <= hi)
        if c is not None:
            code[sel] = c
        err[sel] = e
        msg[sel] = m
    lat = (k * 7 % 250).astype("int64")
    return pd.DataFrame(
        {
            "status_code": pd.array(np.where(np.isnan(code), None, code), dtype="Int32"),
            "error_class": err,
            "error_message": msg,
            "latency_ms": lat,
        }
    )
