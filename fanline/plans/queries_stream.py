"""Registered streaming queries: each runs a Structured Streaming job to
completion (``availableNow``) over the events table and returns what it wrote.

Outputs go to a fresh folder under the session's shared checkpoint folder
(``spark.checkpoint.dir``). The results must equal the batch queries, so
they share their oracles.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline.plans import fixture as fx
from fanline import constants as C
from fanline.plans.oracle_sql import ATT, DUE, EV, QUEUE, chain_sql, dedup_chain
from fanline.plans.queries_delivery import WORK_STATE_SQL
from fanline.plans.queries_metrics import E2E_SQL
from fanline.plans.queries import PUBLISH_STATUS_SQL
from fanline.plans.queries_publish import QUEUE_ROWS_SQL, WITH_STATUS
from fanline.plans.registry import query
from fanline.session import checkpoint_dir
from fanline.streaming import publish as sp
from fanline.streaming.dedup import dedup_ttl_stream
from fanline.streaming.sources import file_stream, table_stream, to_event_rows


# longer than the fixture's month: item ids repeat across it
FIXTURE_SPAN_MS = 60 * 86_400_000


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@query(
    "dedup_ttl_stream",
    f"""WITH RECURSIVE {EV}, {dedup_chain('ev', 'group_id')}
SELECT a.event_id, a.dkey AS group_id, a.ts AS received_at FROM anchors a""",
)
def q_dedup_ttl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 as a stream: keyed state holds the last anchor per key."""
    root = _folder(spark, "dedup-stream")
    st = dedup_ttl_stream(to_event_rows(table_stream(spark, sf_dir, "events")), "group_id", fx.DEDUP_TTL_SECONDS)
    out = st.where("accepted").select("event_id", "group_id", F.col("received_at").cast("timestamp_ntz").alias("received_at"))
    q = (
        out.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


@query(
    "publish_batch",
    f"{WITH_STATUS}, {QUEUE_ROWS_SQL}\nSELECT queue, id, status, failure_count, received_at FROM qrows",
)
def q_publish_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 + K3: the publish stream's committed queue rows (ledger and queues
    are written per batch and made visible together by a marker)."""
    root = _folder(spark, "publish-stream")
    events = to_event_rows(table_stream(spark, sf_dir, "events"))
    q = sp.publish_stream(events, fx.fixture_index(spark), f"{root}/out", f"{root}/ckpt", key="group_id",
                          ttl_seconds=fx.DEDUP_TTL_SECONDS)
    q.awaitTermination()
    rows = sp.read_committed(spark, f"{root}/out", "queues")
    return rows.select("queue", "id", "status", "failure_count",
                       F.col("received_at").cast("timestamp_ntz").alias("received_at"))


def _run(df: DataFrame, root: str, mode: str = "append") -> DataFrame:
    """Drain a streaming frame into parquet under ``root``; returns what was
    written, with the micro-batch id in ``_batch``."""
    def sink(b: DataFrame, i: int) -> None:
        b.withColumn("_batch", F.lit(i).cast("bigint")).write.mode("append").parquet(f"{root}/out")

    q = (
        df.writeStream.outputMode(mode).foreachBatch(sink)
        .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    schema = df.withColumn("_batch", F.lit(0).cast("bigint")).schema
    return df.sparkSession.read.schema(schema).parquet(f"{root}/out")


@query("queue_stream", f"WITH {EV}, {QUEUE}\nSELECT queue, id, status FROM q WHERE {DUE}")
def q_queue_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows read as a stream; each micro-batch selects its due work."""
    from fanline.operators.queue import due_predicate

    root = _folder(spark, "queue-stream")
    rows = fx.queue_rows_from(table_stream(spark, sf_dir, "events"))
    due = rows.where(due_predicate(F.lit(fx.QUEUE_AS_OF).cast("timestamp_ntz"))).select("queue", "id", "status")
    return _run(due, root).drop("_batch")


ROUNDS = 2

#: the rounds of the events table: equal spans of time, and the clock after each
#: (10 minutes behind the newest row so far)
ROUNDS_SQL = f"""span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
  dealt AS (SELECT q.*, least({ROUNDS - 1}, ({ROUNDS} * (epoch_us(received_at) - lo)) // greatest(1, hi - lo)) AS round
            FROM q, span),
  clocks AS (SELECT round, max(max(epoch_us(received_at))) OVER (ORDER BY round) // 1000 - 600000 AS clock_ms
             FROM dealt GROUP BY round)"""


def _in_rounds(spark: SparkSession, sf_dir: str, root: str, build) -> DataFrame:
    """Feed the events table to a stream in rounds of equal spans of time: each round's
    rows are added to the stream's folder and drained (its rows, then a closing
    micro-batch) before the next, all on one checkpoint. Returns what was written."""
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = ev.select(F.min(us), F.max(us)).first()
    if lo is None:
        lo = hi = 0
    nth = F.expr(f"least({ROUNDS - 1}, ({ROUNDS} * (__us - {lo})) div {max(1, hi - lo)})")
    ev = ev.withColumn("__us", us).withColumn("__round", nth).drop("__us")
    schema = ev.drop("__round").schema
    for i in range(ROUNDS):
        ev.where(F.col("__round") == i).drop("__round").write.mode("append").parquet(f"{root}/in")
        out = _run(build(file_stream(spark, f"{root}/in", schema)), root)
    return out


@query(
    "delay_queue_stream",
    f"""WITH {EV}, {QUEUE}, {ROUNDS_SQL},
  due AS (SELECT *, epoch_us(CASE status WHEN 'todo' THEN available_at
                    WHEN 'failed' THEN greatest(updated_at + INTERVAL 1 HOUR, available_at)
                    WHEN 'in-progress' THEN updated_at + INTERVAL 24 HOUR END) AS due_us FROM dealt)
SELECT queue, id, status, make_timestamp(1000 * min(clock_ms)) AS released_at
FROM due JOIN clocks ON clocks.round >= due.round AND due_us < 1000 * clock_ms GROUP BY ALL""",
)
def q_delay_queue_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + S5: queue rows wait in keyed state and come out at the first clock at which
    they are due, over several rounds of the stream."""
    from fanline.streaming.delay_queue import release_due

    root = _folder(spark, "delay-queue")
    # a month goes by in two rounds: wide slots, few keys (a live stream wants narrow ones)
    out = _in_rounds(
        spark, sf_dir, root, lambda raw: release_due(fx.queue_rows_from(raw), slot_ms=24 * 3_600_000, spread=2)
    )
    # a row that came several times is one row of the result, as in the SQL
    out = out.groupBy("queue", "id", "status").agg(F.min("released_at").alias("released_at"))
    return out.withColumn("released_at", F.col("released_at").cast("timestamp_ntz"))


@query(
    "first_response_stream",
    f"""WITH {EV}, {ATT}, {QUEUE}, {E2E_SQL}, {ROUNDS_SQL}
SELECT q.queue, q.id, e2e.e2e_ms FROM q LEFT JOIN e2e ON e2e.queue = q.queue AND e2e.id = q.id
  AND e2e.e2e_ms <= 86400000
WHERE epoch_us(q.received_at + INTERVAL 24 HOUR) <= 1000 * (SELECT max(clock_ms) FROM clocks)""",
)
def q_first_response_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per work item whose 24 hours have passed: its first response or NULL."""
    from fanline.streaming.first_response import first_response_stream

    def build(raw: DataFrame) -> DataFrame:
        enq = fx.queue_rows_from(raw).select("queue", "id", F.col("received_at").cast("timestamp").alias("enqueued_at"))
        att = fx.attempts_from(raw)
        handled = F.col("sent_at").cast("timestamp") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.col("latency_ms") / 1000
        )
        resp = att.select("queue", F.col("attempt_id").alias("id"), handled.alias("handled_at"))
        return first_response_stream(enq, resp, ["queue", "id"])

    return _in_rounds(spark, sf_dir, _folder(spark, "first-response"), build).select("queue", "id", "e2e_ms")


@query(
    "active_gauge_stream",
    """WITH covered AS (SELECT user_id, unnest(generate_series(date_trunc('hour', ts) + INTERVAL 1 HOUR,
                date_trunc('hour', ts) + INTERVAL 6 HOUR, INTERVAL 1 HOUR)) AS moment FROM events)
SELECT moment, count(DISTINCT user_id) AS active FROM covered
WHERE epoch_ms(moment) <= (SELECT epoch_us(max(ts)) // 1000 - 600000 FROM events) GROUP BY moment""",
)
def q_active_gauge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 + A7: active members at every full hour, over several rounds of the stream."""
    from fanline.streaming.gauge import active_gauge_stream

    def build(raw: DataFrame) -> DataFrame:
        hb = raw.select(F.col("user_id").alias("instance_id"), F.col("ts").alias("seen_at"))
        return active_gauge_stream(hb, "6 hours", "1 hour", "10 minutes")

    out = _in_rounds(spark, sf_dir, _folder(spark, "gauge"), build)
    return out.select(F.col("at").cast("timestamp_ntz").alias("moment"), "active")


@query("work_state_stream", WORK_STATE_SQL)
def q_work_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 as a stream: per-item state; the last update per item is its state."""
    from fanline.operators.queue import outcomes_from_attempts
    from fanline.streaming.state import work_state_stream

    root = _folder(spark, "work-stream")
    att = outcomes_from_attempts(fx.attempts_from(table_stream(spark, sf_dir, "events")))
    upd = _run(work_state_stream(att, finished_ttl_ms=FIXTURE_SPAN_MS), root, "update").where("NOT due_again")
    last = upd.groupBy("queue", "item_id").agg(
        F.max_by(F.struct("state", "failure_count", "dispatches"), "_batch").alias("s")
    )
    return last.select("queue", "item_id", "s.state", "s.failure_count", "s.dispatches")


@query("latency_stream", f"WITH {EV}, {ATT}, {QUEUE}, {E2E_SQL}\nSELECT queue, id, e2e_ms FROM e2e")
def q_latency_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enqueue and response streams joined within a time bound."""
    from fanline.streaming.state import latency_stream

    root = _folder(spark, "latency-stream")
    enq = fx.queue_rows_from(table_stream(spark, sf_dir, "events")).select(
        "queue", "id", F.col("received_at").cast("timestamp").alias("enqueued_at")
    )
    att = fx.attempts_from(table_stream(spark, sf_dir, "events"))
    handled = F.col("sent_at").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("latency_ms") / 1000
    )
    resp = att.select("queue", F.col("attempt_id").alias("id"), handled.alias("handled_at"))
    return _run(latency_stream(enq, resp, ["queue", "id"]), root).drop("_batch")


@query(
    "presence_stream",
    """WITH hb AS (SELECT user_id AS instance_id, max(ts) AS last_seen_at FROM events GROUP BY user_id),
  clock AS (SELECT max(ts) - INTERVAL 1 MINUTE AS watermark FROM events)
SELECT instance_id, last_seen_at, TRUE AS active FROM hb
UNION ALL
SELECT instance_id, last_seen_at, FALSE FROM hb, clock WHERE last_seen_at + INTERVAL 6 HOUR < watermark""",
)
def q_presence_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership transitions. Every instance is reported active; once the
    watermark (newest heartbeat - 1 minute) passes last-seen + timeout, it is
    reported inactive and its state dropped."""
    from fanline.streaming.state import presence_stream

    root = _folder(spark, "presence-stream")
    hb = table_stream(spark, sf_dir, "events").select(F.col("user_id").alias("instance_id"), F.col("ts").alias("seen_at"))
    out = _run(presence_stream(hb, fx.HEARTBEAT_TIMEOUT_MS), root, "update").drop("_batch")
    return out.withColumn("last_seen_at", F.col("last_seen_at").cast("timestamp_ntz"))


@query("deliver_stream", f"WITH {EV}, {ATT}\nSELECT attempt_id AS event_id, queue, outcome FROM att")
def q_deliver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery query for every queue, through the fixture endpoint."""
    from fanline.streaming.state import run_delivery

    root = _folder(spark, "deliver-stream")
    ev = table_stream(spark, sf_dir, "events")
    req = ev.select(
        F.concat("event_type", F.lit("_main_queue")).alias("queue"), "event_id",
        fx.envelope_json(F.col("event_type"), F.col("user_id"), F.col("props")).alias("body"),
    )
    q = run_delivery(req, fx.fixture_transport, f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "queue", "outcome")


@query(
    "retry_stream",
    f"""WITH {EV}, {ATT}, {chain_sql(C.DEFAULT_MAX_RETRIES)},
  b AS (SELECT queue, item_id, attempt_id, attempt_no,
          CASE WHEN attempt_no > 1 THEN least(600000.0, 100.0 * pow(2.0, attempt_no - 2)) ELSE 0.0 END AS delay_ms
        FROM chain)
SELECT queue, item_id, attempt_id, attempt_no, delay_ms,
       sum(delay_ms) OVER (PARTITION BY queue, item_id ORDER BY attempt_no) AS cum_delay_ms
FROM b""",
)
def q_retry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-item retry chain and back-off, continued across micro-batches."""
    from fanline.streaming.state import retry_stream

    root = _folder(spark, "retry-stream")
    att = fx.attempts_from(table_stream(spark, sf_dir, "events"))
    return _run(retry_stream(att, idle_ttl_ms=FIXTURE_SPAN_MS), root).drop("_batch")


@query(
    "throttle_stream",
    f"""WITH {EV}, {QUEUE},
  r AS (SELECT queue, id, row_number() OVER (PARTITION BY queue ORDER BY received_at, id) AS cum,
               min(received_at) OVER (PARTITION BY queue) AS t0 FROM q)
SELECT queue, id, CAST(floor((cum - 1) / 60) AS BIGINT) AS slot,
       t0 + CAST(floor((cum - 1) / 60) AS BIGINT) * INTERVAL 3 SECOND AS send_at
FROM r""",
)
def q_throttle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """60 elements per 3 s per queue, slots carried across micro-batches."""
    from fanline.streaming.state import throttle_stream

    root = _folder(spark, "throttle-stream")
    rows = fx.queue_rows_from(table_stream(spark, sf_dir, "events")).select("queue", "id", "received_at")
    out = _run(throttle_stream(rows), root).drop("_batch")
    return out.withColumn("send_at", F.col("send_at").cast("timestamp_ntz"))


@query(
    "publish_incremental",
    f"""WITH RECURSIVE {PUBLISH_STATUS_SQL}
SELECT event_id, status, CASE WHEN status = 'no-topic' THEN 404 ELSE 201 END AS http_code,
  CASE status WHEN 'published' THEN '{{"publishedSubscribers":["' || replace(subscribers, ',', '","') || '"]}}'
    WHEN 'duplicate' THEN '{C.MSG_DUPLICATE}' WHEN 'no-subscribers' THEN '{C.MSG_NO_SUBSCRIBERS}'
    WHEN 'no-topic' THEN '{C.MSG_NO_TOPIC}' END AS body
FROM status""",
)
def q_publish_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events published in two time-ordered batches against the committed
    ledger (``fanline.api.publish``); equal to publishing them at once."""
    from fanline import api

    root = _folder(spark, "incremental")
    ev = fx.fixture_events(spark, sf_dir)
    cut = ev.select(F.percentile_approx("received_at", 0.5)).first()[0]
    idx = fx.fixture_index(spark)
    for i, part in enumerate([ev.where(F.col("received_at") < cut), ev.where(F.col("received_at") >= cut)]):
        api.publish(part, idx, root, i, key="group_id", ttl_seconds=fx.DEDUP_TTL_SECONDS)
    return sp.read_committed(spark, root, "responses").select("event_id", "status", "http_code", "body")
