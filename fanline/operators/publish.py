"""Ledger, queue rows, audit rows, responses, expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.json_text import json_text, payload_json
from fanline.operators.delivery import ISO_MICROS
from fanline.operators.matching import queue_name

ENVELOPE = ["event_id", "subject", "group_id", "timestamp", "event"]


def to_published(events: DataFrame, created_at: Column | str = "received_at") -> DataFrame:
    """an event plus its ``created_at`` (publish time)."""
    c = F.col(created_at) if isinstance(created_at, str) else created_at
    return events.select(*ENVELOPE, c.alias("created_at"))


def from_published(ledger: DataFrame) -> DataFrame:
    """drop ``created_at`` again."""
    return ledger.drop("created_at")


def ledger_rows(status: DataFrame) -> DataFrame:
    """K1: accepted events become ledger rows (unique per key by the dedup)."""
    return to_published(status.where("accepted"))


def queue_rows(fanned: DataFrame, created_at: str = "received_at") -> DataFrame:
    """K2: one ToDo work item per (published event, matching subscriber)."""
    t = F.col(created_at)
    return fanned.select(
        queue_name(F.col("topic"), F.col("subscriber")).alias("queue"),
        "topic",
        "subscriber",
        F.col("event_id").alias("id"),
        *ENVELOPE,
        t.alias("received_at"),
        t.alias("updated_at"),
        t.alias("available_at"),
        F.lit(C.TODO).alias("status"),
        F.lit(0).alias("failure_count"),
    )


def audit_rows(failed: DataFrame, reason: Column | str, bare: bool = False) -> DataFrame:
    """K4: one audit row per failed publish, detail = every field as JSON text + reason."""
    r = F.col(reason) if isinstance(reason, str) else reason
    detail = F.create_map(
        F.lit("eventId"), json_text(F.col("event_id").cast("string")),
        F.lit("subject"), json_text(F.col("subject")),
        F.lit("groupId"), json_text(F.col("group_id").cast("string")),
        F.lit("timestamp"), json_text(F.date_format("timestamp", ISO_MICROS)),
        F.lit("event"), payload_json(F.col("event"), bare),
        F.lit("reason"), r,
    )
    return failed.select(
        "event_id",
        F.lit(C.AUDIT_SOURCE).alias("audit_source"),
        F.lit(C.AUDIT_TYPE).alias("audit_type"),
        detail.alias("detail"),
    )


def publish_response(status: DataFrame) -> DataFrame:
    """K7: HTTP code and body per publish request."""
    st = F.col("status")
    code = (
        F.when(st == C.ST_NO_TOPIC, F.lit(C.CODE_NOT_FOUND))
        .when(st == C.ST_INVALID, F.lit(C.CODE_BAD_REQUEST))
        .when(st.isin(C.ST_PUBLISHED, C.ST_DUPLICATE, C.ST_NO_SUBSCRIBERS), F.lit(C.CODE_CREATED))
        .otherwise(F.lit(C.CODE_SERVER_ERROR))  # any other failure to publish
    )
    published = F.to_json(F.struct(F.col("subscribers").alias("publishedSubscribers")))
    body = (
        F.when(st == C.ST_PUBLISHED, published)
        .when(st == C.ST_DUPLICATE, F.lit(C.MSG_DUPLICATE))
        .when(st == C.ST_NO_SUBSCRIBERS, F.lit(C.MSG_NO_SUBSCRIBERS))
        .when(st == C.ST_NO_TOPIC, F.lit(C.MSG_NO_TOPIC))
    )
    return status.withColumns({"http_code": code, "body": body})


def expire_ledger(ledger: DataFrame, as_of: Column, ttl_seconds: int = C.LEDGER_TTL_SECONDS) -> DataFrame:
    """K8: ledger rows younger than the TTL survive (expired iff age >= ttl)."""
    return ledger.where(F.col("created_at") > as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_seconds)))


INVALID_PAYLOAD_KEY = "Invalid Event payload: "


def invalid_response(parsed: DataFrame) -> DataFrame:
    """K7 for bodies that failed validation: 400 and every error as JSON,
    ``{"Invalid Event payload: ": {path: [{"msg": [msg], "args": []}]}}``."""
    entry = F.transform(
        "errors",
        lambda e: F.struct(
            F.split(e, ": ").getItem(0).alias("key"),
            F.array(
                F.struct(
                    F.array(F.split(e, ": ").getItem(1)).alias("msg"),
                    F.array().cast("array<string>").alias("args"),
                )
            ).alias("value"),
        ),
    )
    body = F.to_json(F.create_map(F.lit(INVALID_PAYLOAD_KEY), F.map_from_entries(entry)))
    return parsed.withColumns({"http_code": F.lit(C.CODE_BAD_REQUEST), "body": body})
