"""Golden values of the fixture mapping at sf0.01 (computed independently in DuckDB)."""

from collections import Counter

from pyspark.sql import functions as F

from support import SF_CHECK
from fanline.plans import queries, queries_delivery


def test_fan_out_per_subscriber(spark):
    rows = queries.q_fan_out(spark, SF_CHECK).groupBy("subscriber").count().collect()
    assert {r[0]: r[1] for r in rows} == {
        "audit-all": 2006, "high-k": 1006, "alerts": 2014, "pager": 200, "billing": 1981, "vip": 266, "sampler": 191
    }


def test_dedup_alone(spark):
    r = queries.q_dedup_ttl(spark, SF_CHECK).agg(F.count("*"), F.sum("event_id")).first()
    assert (r[0], r[1]) == (3128, 15512766)


def test_publish_status(spark):
    got = Counter(r.status for r in queries.q_publish_status(spark, SF_CHECK).collect())
    assert got == {"duplicate": 5744, "no-topic": 884, "no-subscribers": 766, "published": 2606}


def test_outcomes_and_retryable(spark):
    a = queries_delivery.q_outcomes(spark, SF_CHECK).join(queries_delivery.q_retryable(spark, SF_CHECK), "attempt_id")
    got = Counter((r.outcome, r.retryable) for r in a.collect())
    assert got[("Sent", False)] == 5960
    assert got[("Removed", False)] == 1411
    assert got[("Failed", True)] == 2314
    assert got[("Failed", False)] == 315


def test_retry_chain_rows_per_attempt(spark):
    got = Counter(r.attempt_no for r in queries_delivery.q_retry_chain(spark, SF_CHECK).collect())
    assert [got[1], got[2], got[3]] == [750, 191, 52]


def test_due_work(spark):
    got = Counter(r.status for r in queries_delivery.q_due_work(spark, SF_CHECK).collect())
    assert got == {"todo": 1179, "failed": 1154, "in-progress": 1064}


def test_active_members(spark):
    from fanline.plans import queries_metrics

    r = queries_metrics.q_active_members(spark, SF_CHECK).first()
    assert (r.active, r.total) == (64, 150)


def test_retry_span_matches_formula(spark):
    from fanline.plans import queries_metrics

    spans = {r.worst_case_span_s for r in queries_metrics.q_retry_span(spark, SF_CHECK).collect()}
    assert spans == {83019.1}


def test_join_form_of_matching_equals_inline(spark, monkeypatch):
    """Catalogs too large to inline are joined; the result must not change."""
    from fanline.operators import matching
    from fanline.plans import fixture as fx

    ev = fx.fixture_events(spark, SF_CHECK)
    idx = matching.SubscriptionIndex.build(fx.fixture_catalog(spark))
    inline = sorted(map(tuple, matching.fan_out(ev, idx).select("event_id", "subscriber", "queue").collect()))
    inline_idx, idx = idx, matching.SubscriptionIndex.build(fx.fixture_catalog(spark), inline=False)
    joined = sorted(map(tuple, matching.fan_out(ev, idx).select("event_id", "subscriber", "queue").collect()))
    assert inline == joined
    m = matching.publishable(ev, idx).select("event_id", "topic_known", F.array_join("subscribers", ",")).collect()
    m2 = matching.publishable(ev, inline_idx).select("event_id", "topic_known", F.array_join("subscribers", ",")).collect()
    assert sorted(map(tuple, m)) == sorted(map(tuple, m2))


def test_json_lines_source_round_trip(spark, scratch):
    """S1 from files: bodies written as JSON lines read back and validated."""
    import os

    from fanline.plans import fixture as fx
    from fanline.sources import ingest

    path = os.path.join(scratch, "bodies")
    fx.fixture_bodies(spark, SF_CHECK).select("body").write.text(path)
    parsed = ingest.parse_bodies(ingest.read_event_bodies(spark, path))
    assert parsed.count() == 10000
    assert ingest.valid_events(parsed).count() == 8873
    bad = Counter(e for r in ingest.invalid_events(parsed).select("errors").collect() for e in r.errors)
    assert set(bad) == {
        "obj.groupId: error.expected.jsstring", "obj.eventId: error.path.missing", "obj.eventId: error.expected.uuid",
        "obj.timestamp: error.expected.date.isoformat", "obj.subject: error.path.missing", "obj.event: error.path.missing",
    }


def test_incremental_publish_equals_one_shot(spark, scratch):
    """Two batches published against the ledger give the one-shot statuses."""
    import os

    from fanline import api
    from fanline.plans import fixture as fx
    from fanline.plans.queries import publish_status_df

    ev = fx.fixture_events(spark, SF_CHECK)
    cut = ev.select(F.percentile_approx("received_at", 0.5)).first()[0]
    root = os.path.join(scratch, "svc")
    r0 = api.publish(ev.where(F.col("received_at") < cut), fx.fixture_index(spark), root, 0, key="group_id",
                     ttl_seconds=fx.DEDUP_TTL_SECONDS)
    r1 = api.publish(ev.where(F.col("received_at") >= cut), fx.fixture_index(spark), root, 1, key="group_id",
                     ttl_seconds=fx.DEDUP_TTL_SECONDS)
    got = sorted((r.event_id, r.status) for r in r0.unionByName(r1).collect())
    want = sorted((r.event_id, r.status) for r in publish_status_df(spark, SF_CHECK, keep=[]).collect())
    assert got == want


def test_incremental_status_with_hot_keys(spark):
    """Ledger seeds work on the hot-key path too."""
    from fanline import api
    from fanline.plans import fixture as fx
    from fanline.plans.queries import publish_status_df

    ev = fx.fixture_events(spark, SF_CHECK)
    cut = ev.select(F.percentile_approx("received_at", 0.5)).first()[0]
    idx = fx.fixture_index(spark)
    first = api.publish_events(ev.where(F.col("received_at") < cut), idx, None, "group_id", fx.DEDUP_TTL_SECONDS)
    ledger = first.where("accepted").select("group_id", F.col("received_at").alias("created_at"))
    second = api.publish_events(ev.where(F.col("received_at") >= cut), idx, ledger, "group_id", fx.DEDUP_TTL_SECONDS,
                                hot_threshold=20)
    got = sorted((r.event_id, r.status) for r in first.unionByName(second).select("event_id", "status").collect())
    want = sorted((r.event_id, r.status) for r in publish_status_df(spark, SF_CHECK, keep=[]).collect())
    assert got == want


def test_readme_flow_publish_then_deliver(spark, scratch):
    """Publish a batch, pick the next due work per queue, render and deliver it."""
    import os

    from fanline import api
    from fanline.operators import delivery, queue
    from fanline.plans import fixture as fx
    from fanline.streaming.publish import read_committed

    root = os.path.join(scratch, "flow")
    api.publish(fx.fixture_events(spark, SF_CHECK), fx.fixture_index(spark), root, 0, key="group_id",
                ttl_seconds=fx.DEDUP_TTL_SECONDS)
    queues = read_committed(spark, root, "queues")
    assert queues.count() == 3219
    due = queue.next_due(queues, F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"), n=4)
    assert due.count() == 7 * 4  # four per subscriber queue
    attempts = delivery.deliver(delivery.render_requests(due, fx.fixture_catalog(spark)), fx.fixture_transport)
    got = attempts.collect()
    assert len(got) == 28 and {r.queue for r in got} == {r.queue for r in due.collect()}
