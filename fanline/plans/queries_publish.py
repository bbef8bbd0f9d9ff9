"""Registered queries: ledger, queues, requests, delivery, responses, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.operators import dedup, delivery, publish
from fanline.plans import fixture as fx
from fanline.plans.oracle_sql import AS_OF
from fanline.plans.queries import PUBLISH_STATUS_SQL, publish_status_df
from fanline.plans.registry import query
from fanline.sources import ingest

WITH_STATUS = f"WITH RECURSIVE {PUBLISH_STATUS_SQL}"

LEDGER_SQL = "ledger AS (SELECT event_id, subject, group_id, ts AS timestamp, received_at AS created_at FROM status WHERE accepted)"

QUEUE_ROWS_SQL = """qrows AS (
  SELECT f.queue, f.topic, f.subscriber, f.uri, f.http_method, f.event_id AS id, f.event_id, f.subject, f.group_id,
         f.ts, f.event, f.received_at, 'todo' AS status, 0 AS failure_count
  FROM fanned f JOIN status s ON s.event_id = f.event_id WHERE s.accepted)"""

BODY_SQL = """substring(json_object('eventId', CAST(event_id AS VARCHAR), 'subject', subject,
    'groupId', CAST(group_id AS VARCHAR), 'timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')), 1,
    length(json_object('eventId', CAST(event_id AS VARCHAR), 'subject', subject,
    'groupId', CAST(group_id AS VARCHAR), 'timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'))) - 1)
  || ',' || substring(event, 2)"""


def as_of():
    return F.lit(fx.QUEUE_AS_OF).cast("timestamp_ntz")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.ledger_rows(publish_status_df(spark, sf_dir))


def published_queue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 rows: fan-out of the accepted events."""
    st = publish_status_df(spark, sf_dir).where("accepted")
    fanned = st.withColumn("subscriber", F.explode("subscribers"))
    return publish.queue_rows(fanned)


def published_queue_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(queue, subscriber, id, received_at) of the K2 rows, without the envelope
    travelling through the fold."""
    from fanline.operators.matching import queue_name

    st = publish_status_df(spark, sf_dir, keep=["topic"]).where("accepted")
    fanned = st.withColumn("subscriber", F.explode("subscribers"))
    return fanned.select(
        queue_name(F.col("topic"), F.col("subscriber")).alias("queue"), "subscriber",
        F.col("event_id").alias("id"), "received_at",
    )


@query("published_ledger", f"{WITH_STATUS}, {LEDGER_SQL}\nSELECT event_id, subject, group_id, timestamp, created_at FROM ledger")
def q_published_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + F9: accepted events with their publish time."""
    return ledger(spark, sf_dir).select("event_id", "subject", "group_id", "timestamp", "created_at")


@query(
    "subscriber_queues",
    f"{WITH_STATUS}, {QUEUE_ROWS_SQL}\nSELECT queue, id, status, failure_count, received_at FROM qrows",
)
def q_subscriber_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + F10: one ToDo work item per (published event, subscriber)."""
    return published_queue_rows(spark, sf_dir).select("queue", "id", "status", "failure_count", "received_at")


@query(
    "ledger_lookup",
    f"""{WITH_STATUS}, {LEDGER_SQL}
SELECT event_id, subject, group_id, timestamp, created_at FROM ledger
WHERE event_id = (SELECT max(event_id) FROM ledger) LIMIT 1""",
)
def q_ledger_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + L2: look up one event id (the newest published one) in the ledger."""
    led = ledger(spark, sf_dir)
    out = ingest.ledger_lookup(led, led.select(F.max("event_id")).scalar())
    return out.select("event_id", "subject", "group_id", "timestamp", "created_at")


@query(
    "expire_ledger",
    f"""{WITH_STATUS}, {LEDGER_SQL}
SELECT event_id, created_at FROM ledger WHERE created_at > {AS_OF} - INTERVAL 86400 SECOND""",
)
def q_expire_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the ledger as it stands at the fixture clock after TTL expiry."""
    return publish.expire_ledger(ledger(spark, sf_dir), as_of()).select("event_id", "created_at")


_HIT = """EXISTS (SELECT 1 FROM ledger l WHERE l.group_id = ev.group_id AND l.created_at <= ev.received_at
                 AND l.created_at > ev.received_at - INTERVAL 24 HOUR)"""


@query("not_yet_published", f"{WITH_STATUS}, {LEDGER_SQL}\nSELECT event_id FROM ev WHERE NOT {_HIT}")
def q_not_yet_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with no unexpired ledger row for their key on arrival."""
    ev = fx.fixture_events(spark, sf_dir)
    out = dedup.not_yet_published(ev, ledger(spark, sf_dir), fx.DEDUP_TTL_SECONDS, key="group_id")
    return out.select("event_id")


@query("duplicates", f"{WITH_STATUS}, {LEDGER_SQL}\nSELECT event_id FROM ev WHERE {_HIT}")
def q_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that do have one."""
    ev = fx.fixture_events(spark, sf_dir)
    return dedup.duplicates_of(ev, ledger(spark, sf_dir), fx.DEDUP_TTL_SECONDS, key="group_id").select("event_id")


@query(
    "audit_failures",
    f"""{WITH_STATUS}, d AS (SELECT * FROM status WHERE status = 'duplicate'),
  kv AS (
    SELECT event_id, 'eventId' AS field, '"' || CAST(event_id AS VARCHAR) || '"' AS value FROM d
    UNION ALL SELECT event_id, 'subject', '"' || subject || '"' FROM d
    UNION ALL SELECT event_id, 'groupId', '"' || CAST(group_id AS VARCHAR) || '"' FROM d
    UNION ALL SELECT event_id, 'timestamp', '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"' FROM d
    UNION ALL SELECT event_id, 'event', substring(event, 10, length(event) - 10) FROM d
    UNION ALL SELECT event_id, 'reason', '{C.MSG_DUPLICATE}' FROM d)
SELECT event_id, 'fanline-publisher' AS audit_source, 'TxFailed' AS audit_type, field, value FROM kv""",
)
def q_audit_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: audit rows for refused publishes (the duplicate insert is the failure)."""
    st = publish_status_df(spark, sf_dir).where(F.col("status") == C.ST_DUPLICATE)
    audit = publish.audit_rows(st, F.lit(C.MSG_DUPLICATE), bare=True)
    return audit.select("event_id", "audit_source", "audit_type", F.explode("detail").alias("field", "value"))


@query(
    "publish_response",
    f"""{WITH_STATUS}
SELECT event_id,
  CASE WHEN status = 'no-topic' THEN 404 ELSE 201 END AS http_code,
  CASE status WHEN 'published' THEN '{{"publishedSubscribers":["' || replace(subscribers, ',', '","') || '"]}}'
    WHEN 'duplicate' THEN '{C.MSG_DUPLICATE}' WHEN 'no-subscribers' THEN '{C.MSG_NO_SUBSCRIBERS}'
    WHEN 'no-topic' THEN '{C.MSG_NO_TOPIC}' END AS body
FROM status""",
)
def q_publish_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: HTTP code and body for every publish request."""
    out = publish.publish_response(publish_status_df(spark, sf_dir, keep=[]))
    return out.select("event_id", "http_code", "body")


@query(
    "render_requests",
    f"""{WITH_STATUS}, {QUEUE_ROWS_SQL}
SELECT queue, event_id, http_method AS method, uri, 'application/json' AS content_type, {BODY_SQL} AS body
FROM qrows""",
)
def q_render_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the HTTP request of every queued work item."""
    return delivery.render_requests(published_queue_rows(spark, sf_dir), fx.fixture_catalog(spark), bare=True)


@query(
    "deliver",
    f"""{WITH_STATUS}, {QUEUE_ROWS_SQL}
SELECT queue, event_id,
  CASE WHEN k BETWEEN 0 AND 59 THEN 200 WHEN k BETWEEN 60 AND 69 THEN 503 WHEN k BETWEEN 70 AND 77 THEN 429
       WHEN k BETWEEN 78 AND 85 THEN 400 WHEN k BETWEEN 86 AND 91 THEN 301 END AS status_code,
  CASE WHEN k BETWEEN 92 AND 94 THEN 'RequestTimeoutException' WHEN k BETWEEN 95 AND 96 THEN 'RuntimeException'
       WHEN k BETWEEN 97 AND 99 THEN 'IllegalStateException' END AS error_class,
  CASE WHEN k BETWEEN 95 AND 96 THEN 'The http server closed the connection unexpectedly'
       WHEN k BETWEEN 97 AND 99 THEN 'boom' END AS error_message,
  CAST(k * 7 % 250 AS BIGINT) AS latency_ms
FROM (SELECT qrows.*, CAST(json_extract_string(event, '$.event.props.k') AS INTEGER) AS k FROM qrows)""",
)
def q_deliver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: every request sent through the (deterministic) fixture endpoint."""
    reqs = delivery.render_requests(published_queue_rows(spark, sf_dir), fx.fixture_catalog(spark), bare=True)
    return delivery.deliver(reqs, fx.fixture_transport, C.DEFAULT_MAX_CONNECTIONS)
