"""Batch == stream: the streaming forms replay the batch results."""

import os
import time

import pytest
from pyspark.sql import functions as F

from support import SF_CHECK
from fanline.operators import dedup, matching
from fanline.operators.queue import outcomes_from_attempts, work_state
from fanline.plans import fixture as fx
from fanline.streaming import publish as sp
from fanline.streaming.dedup import dedup_ttl_stream
from fanline.streaming.sources import file_stream, to_event_rows
from fanline.streaming.state import latency_stream, presence_stream, run_delivery, work_state_stream


@pytest.fixture(scope="module")
def chunks(spark):
    """The sf0.01 events table split into 4 files in time order (one per micro-batch)."""
    import tempfile

    d = tempfile.mkdtemp(prefix="fanline-chunks-", dir="/tmp")
    ev = spark.read.parquet(os.path.join(SF_CHECK, "events.parquet"))
    bounds = ev.select(F.percentile_approx("ts", [0.25, 0.5, 0.75], 10000)).first()[0]
    edges = [None, *bounds, None]
    for lo, hi in zip(edges, edges[1:]):
        part = ev
        if lo is not None:
            part = part.where(F.col("ts") >= lo)
        if hi is not None:
            part = part.where(F.col("ts") < hi)
        part.coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)
    return d, ev.schema


def _drain(df, scratch, name, mode="append"):
    out = os.path.join(scratch, name)
    q = (
        df.writeStream.outputMode(mode)
        .foreachBatch(lambda b, i: b.withColumn("_batch", F.lit(i)).write.mode("append").parquet(out))
        .option("checkpointLocation", os.path.join(scratch, name + "-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(600)
    return out


def test_dedup_stream_equals_batch(spark, chunks, scratch):
    d, schema = chunks
    raw = file_stream(spark, d, schema, max_files_per_trigger=1)
    st = dedup_ttl_stream(to_event_rows(raw), "group_id", fx.DEDUP_TTL_SECONDS)
    out = _drain(st.select("event_id", "accepted", "duplicate"), scratch, "dedup")
    res = spark.read.parquet(out)
    assert res.select("_batch").distinct().count() == 4
    got = sorted(map(tuple, res.select("event_id", "accepted", "duplicate").collect()))
    batch = dedup.ttl_status(fx.fixture_events(spark, SF_CHECK), "group_id", fx.DEDUP_TTL_SECONDS)
    assert got == sorted(map(tuple, batch.select("event_id", "accepted", "duplicate").collect()))


def test_publish_stream_commits_atomically_and_replays(spark, chunks, scratch):
    d, schema = chunks
    idx = fx.fixture_index(spark)
    raw = file_stream(spark, d, schema, max_files_per_trigger=2)
    root = os.path.join(scratch, "published")
    q = sp.publish_stream(to_event_rows(raw), idx, root, os.path.join(scratch, "pub-ckpt"), key="group_id",
                          ttl_seconds=fx.DEDUP_TTL_SECONDS)
    q.awaitTermination(600)
    ledger = sp.read_committed(spark, root, "ledger")
    queues = sp.read_committed(spark, root, "queues")
    from fanline.plans.queries import publish_status_df

    st = publish_status_df(spark, SF_CHECK)
    assert sorted(r.event_id for r in ledger.collect()) == sorted(r.event_id for r in st.where("accepted").collect())
    assert queues.count() == st.where("accepted").select(F.explode("subscribers")).count() == 3219
    responses = sp.read_committed(spark, root, "responses")
    assert responses.count() == 10000
    assert responses.where("http_code = 404").count() == st.where("status = 'no-topic'").count()
    # replaying batch 0 leaves the committed result unchanged
    n_before = queues.count()
    b0 = spark.read.parquet(os.path.join(root, "ledger", "batch_id=0"))
    q0 = spark.read.parquet(os.path.join(root, "queues", "batch_id=0"))
    sp.commit_batch(b0, q0, 0, root + "-replay")
    sp.commit_batch(b0, q0, 0, root + "-replay")
    assert sp.read_committed(spark, root + "-replay", "queues").count() == q0.count()
    assert sp.read_committed(spark, root, "queues").count() == n_before
    # a batch without its marker is invisible
    q0.write.mode("overwrite").partitionBy("queue").parquet(os.path.join(root, "queues", "batch_id=99"))
    assert sp.read_committed(spark, root, "queues").count() == n_before


def _attempt_rows(raw):
    k = fx.k_of(F.col("props"))
    return raw.select(
        F.concat(F.col("event_type"), F.lit("_main_queue")).alias("queue"),
        F.col("user_id").alias("item_id"),
        F.col("event_id").alias("attempt_id"),
        F.col("ts").alias("sent_at"),
        *fx.attempt_result_columns(k),
    )


def test_work_state_stream_equals_batch(spark, chunks, scratch):
    d, schema = chunks
    raw = file_stream(spark, d, schema, max_files_per_trigger=1)
    # the fixture reuses item ids for a month: keep finished items longer than that
    stream = work_state_stream(_attempt_rows(raw), finished_ttl_ms=60 * 86_400_000)
    out = _drain(stream, scratch, "work", mode="update")
    res = spark.read.parquet(out)
    from pyspark.sql import Window

    res = res.where("NOT due_again")
    last = res.withColumn("_r", F.row_number().over(Window.partitionBy("queue", "item_id").orderBy(F.desc("_batch"))))
    got = sorted(map(tuple, last.where("_r = 1").select("queue", "item_id", "state", "failure_count", "dispatches").collect()))
    batch = work_state(outcomes_from_attempts(_attempt_rows(spark.read.parquet(d))), ["queue", "item_id"],
                       ["sent_at", "attempt_id"])
    assert got == sorted(map(tuple, batch.collect()))


def test_latency_stream_equals_batch(spark, chunks, scratch):
    d, schema = chunks
    raw = file_stream(spark, d, schema, max_files_per_trigger=1)
    raw2 = file_stream(spark, d, schema, max_files_per_trigger=1)
    enq = raw.select(F.concat("event_type", F.lit("_main_queue")).alias("queue"), F.col("event_id").alias("id"),
                     F.col("ts").cast("timestamp").alias("enqueued_at"))
    lat = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor(F.col("value") * 10) / 1000)
    resp = raw2.select(F.concat("event_type", F.lit("_main_queue")).alias("queue"), F.col("event_id").alias("id"),
                       (F.col("ts").cast("timestamp") + lat).alias("handled_at"))
    out = _drain(latency_stream(enq, resp, ["queue", "id"]), scratch, "lat")
    got = sorted(map(tuple, spark.read.parquet(out).select("queue", "id", "e2e_ms").collect()))
    from fanline.plans.queries_metrics import q_e2e_latency

    assert got == sorted(map(tuple, q_e2e_latency(spark, SF_CHECK).collect()))


def test_presence_stream(spark, chunks, scratch):
    d, schema = chunks
    raw = file_stream(spark, d, schema, max_files_per_trigger=1)
    hb = raw.select(F.col("user_id").alias("instance_id"), F.col("ts").alias("seen_at"))
    out = _drain(presence_stream(hb, timeout_ms=fx.HEARTBEAT_TIMEOUT_MS), scratch, "presence", mode="update")
    res = spark.read.parquet(out)
    assert res.select("instance_id").distinct().count() == 150
    # an instance reported inactive was silent for longer than the timeout
    ev = spark.read.parquet(d)
    nxt = ev.select(F.col("user_id").alias("instance_id"), F.col("ts").cast("timestamp").alias("t"))
    gone = res.where("NOT active").select("instance_id", "last_seen_at")
    bad = gone.join(nxt, "instance_id").where(
        (F.col("t") > F.col("last_seen_at"))
        & (F.col("t") <= F.col("last_seen_at") + F.expr("INTERVAL 6 HOURS"))
    )
    assert gone.count() > 0 and bad.count() == 0


def test_run_delivery_equals_batch(spark, chunks, scratch):
    d, schema = chunks
    raw = file_stream(spark, d, schema, max_files_per_trigger=2)
    req = raw.select(F.concat("event_type", F.lit("_main_queue")).alias("queue"), "event_id",
                     fx.envelope_json(F.col("event_type"), F.col("user_id"), F.col("props")).alias("body"))
    sink = os.path.join(scratch, "attempts")
    q = run_delivery(req, fx.fixture_transport, sink, os.path.join(scratch, "deliv-ckpt"))
    q.awaitTermination(600)
    got = spark.read.parquet(sink)
    assert got.count() == 10000
    sent = got.where("outcome = 'Sent'").count()
    assert sent == 5960


def test_retry_stream_across_batches_equals_batch(spark, chunks, scratch):
    from fanline import constants as C
    from fanline.operators.delivery import backoff_schedule, number_attempts, retry_chain
    from fanline.streaming.state import retry_stream

    d, schema = chunks
    raw = file_stream(spark, d, schema, max_files_per_trigger=1)
    out = _drain(retry_stream(fx.attempts_from(raw), idle_ttl_ms=60 * 86_400_000), scratch, "retry")
    got = sorted(map(tuple, spark.read.parquet(out).select("attempt_id", "attempt_no", "delay_ms", "cum_delay_ms").collect()))
    a = number_attempts(fx.attempts_from(spark.read.parquet(d)), ["queue", "item_id"], ["sent_at", "attempt_id"])
    ch = retry_chain(a, ["queue", "item_id"], C.DEFAULT_MAX_RETRIES)
    b = backoff_schedule(ch, ["queue", "item_id"], C.DEFAULT_MIN_BACKOFF_MS, C.DEFAULT_MAX_BACKOFF_MS)
    assert got == sorted(map(tuple, b.select("attempt_id", "attempt_no", "delay_ms", "cum_delay_ms").collect()))


def test_throttle_stream_across_batches_equals_batch(spark, chunks, scratch):
    from fanline import constants as C
    from fanline.operators.delivery import throttle_schedule
    from fanline.streaming.state import throttle_stream

    d, schema = chunks
    raw = file_stream(spark, d, schema, max_files_per_trigger=1)
    rows = fx.queue_rows_from(raw).select("queue", "id", "received_at")
    out = _drain(throttle_stream(rows), scratch, "throttle")
    res = spark.read.parquet(out)
    assert res.select("_batch").distinct().count() == 4
    got = sorted(map(tuple, res.select("queue", "id", "slot", F.col("send_at").cast("timestamp_ntz")).collect()))
    brows = fx.queue_rows_from(spark.read.parquet(d)).select("queue", "id", "received_at")
    b = throttle_schedule(brows, "queue", ["received_at", "id"], C.DEFAULT_ELEMENTS, C.DEFAULT_PER_MS)
    assert got == sorted(map(tuple, b.select("queue", "id", "slot", "send_at").collect()))


def test_delivery_restarts_from_checkpoint_exactly_once(spark, scratch):
    """Stop, add input, restart on the same checkpoint: every request once."""
    src = os.path.join(scratch, "in")
    ev = spark.read.parquet(os.path.join(SF_CHECK, "events.parquet"))
    halves = ev.randomSplit([0.5, 0.5], seed=3)
    schema = ev.schema
    sink, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")

    def start():
        raw = file_stream(spark, src, schema, max_files_per_trigger=1)
        req = raw.select(F.concat("event_type", F.lit("_main_queue")).alias("queue"), "event_id",
                         fx.envelope_json(F.col("event_type"), F.col("user_id"), F.col("props")).alias("body"))
        return run_delivery(req, fx.fixture_transport, sink, ckpt)

    halves[0].coalesce(1).write.mode("append").parquet(src)
    start().awaitTermination(600)
    first = spark.read.parquet(sink).count()
    halves[1].coalesce(1).write.mode("append").parquet(src)
    start().awaitTermination(600)
    got = spark.read.parquet(sink)
    assert 0 < first < 10000
    assert got.count() == 10000 and got.select("event_id").distinct().count() == 10000


def test_publish_stream_from_bodies(spark, scratch):
    """D2 from raw bodies: valid ones are published, invalid ones answered 400."""
    from fanline.plans.queries_ingest import q_publish_endpoint

    src = os.path.join(scratch, "bodies")
    fx.fixture_bodies(spark, SF_CHECK).coalesce(2).write.parquet(src)
    schema = spark.read.parquet(src).schema
    root = os.path.join(scratch, "pub")
    q = sp.publish_stream(sp.events_from_bodies(file_stream(spark, src, schema), F.col("timestamp")), fx.fixture_index(spark),
                          os.path.join(root, "out"), os.path.join(root, "ckpt"), key="group_id",
                          ttl_seconds=fx.DEDUP_TTL_SECONDS)
    q.awaitTermination(600)
    r = sp.rejected_stream(file_stream(spark, src, schema), os.path.join(root, "rejected"), os.path.join(root, "rckpt"))
    r.awaitTermination(600)
    endpoint = q_publish_endpoint(spark, SF_CHECK)
    published = endpoint.where("body LIKE '%publishedSubscribers%'").count()
    assert sp.read_committed(spark, os.path.join(root, "out"), "ledger").count() == published
    assert spark.read.parquet(os.path.join(root, "rejected")).count() == endpoint.where("http_code = 400").count()


def test_paced_delivery_waits_for_slots(spark):
    """D5 on the delivery path: rows are sent no earlier than their send_at."""
    import datetime as dt
    import time as _t

    from fanline.operators.delivery import deliver

    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)  # send_at is read as UTC
    rows = [("q", i, '{"event":{"props":{"k":1}}}', now + dt.timedelta(seconds=1.5 * (i % 2))) for i in range(6)]
    req = spark.createDataFrame(rows, "queue string, event_id long, body string, send_at timestamp_ntz")
    t0 = _t.time()
    out = deliver(req, fx.fixture_transport, max_connections=2, pace=True).collect()
    assert len(out) == 6 and all(r.status_code == 200 for r in out)
    assert _t.time() - t0 >= 1.4


def test_failed_commit_is_audited_and_raised(spark, chunks, scratch, monkeypatch):
    """K4: a batch that cannot commit is audited (every accepted event), then fails the query."""
    d, schema = chunks

    def broken(*args, **kwargs):
        raise RuntimeError("write refused by storage")

    monkeypatch.setattr(sp, "commit_batch", broken)
    root = os.path.join(scratch, "pubfail")
    q = sp.publish_stream(to_event_rows(file_stream(spark, d, schema, max_files_per_trigger=1)), fx.fixture_index(spark),
                          os.path.join(root, "out"), os.path.join(root, "ckpt"), key="group_id",
                          ttl_seconds=fx.DEDUP_TTL_SECONDS)
    import pytest as _pytest

    with _pytest.raises(Exception):
        q.awaitTermination(600)
    audit = spark.read.parquet(os.path.join(root, "out-audit"))
    rows = audit.select("audit_source", "audit_type", F.col("detail")["reason"].alias("reason")).distinct().collect()
    assert len(rows) == 1 and rows[0].audit_type == "TxFailed" and "write refused by storage" in rows[0].reason
    assert audit.count() > 0


def test_in_progress_item_is_due_again_after_24h(spark, scratch):
    """D3: a picked item without a result becomes due again one day later."""
    import datetime as dt

    src = os.path.join(scratch, "picks")
    t0 = dt.datetime(2024, 1, 1)
    schema = "queue string, item_id long, attempt_id long, sent_at timestamp_ntz, outcome string"
    first = [("q", 1, 1, t0, "Picked"), ("q", 2, 2, t0, "Picked"), ("q", 2, 3, t0 + dt.timedelta(minutes=5), "Sent")]
    later = [("q", 3, 4, t0 + dt.timedelta(hours=25), "Picked")]  # moves the watermark past t0 + 24 h
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(src)
    import time as _t

    _t.sleep(1.1)
    spark.createDataFrame(later, schema).coalesce(1).write.mode("append").parquet(src)
    stream = file_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
    out = _drain(work_state_stream(stream), scratch, "picks-out", mode="update")
    rows = {(r.item_id, r.state, r.due_again) for r in spark.read.parquet(out).collect()}
    assert (1, "in-progress", True) in rows  # item 1 timed out
    assert (2, "succeeded", False) in rows and not any(i == 2 and d for i, _, d in rows)
