"""Publishing on the default key, replays, streams of several batches, real bodies."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from fanline import api
from fanline.operators import delivery, publish
from fanline.plans import fixture as fx
from fanline.sources.catalog import catalog_from_nested, load_subscriptions
from fanline.streaming import publish as sp
from fanline.streaming.sources import file_stream

T0 = dt.datetime(2024, 3, 1)
SCHEMA = (
    "topic string, event_id string, subject string, group_id string, timestamp timestamp, event string, "
    "received_at timestamp"
)


def events(spark, rows):
    out = [(t, i, t, "g", T0, '{"event":{"event_type":"%s"}}' % t, T0 + dt.timedelta(hours=h)) for t, i, h in rows]
    return spark.createDataFrame(out, SCHEMA)


def statuses(df):
    return sorted((r.event_id, r.status) for r in df.collect())


def test_default_key_over_three_batches_and_a_replay(spark, scratch):
    index, root = fx.fixture_index(spark), os.path.join(scratch, "pub")
    one = events(spark, [("click", "a", 0), ("click", "a", 1), ("purchase", "b", 2), ("empty", "c", 2), ("nowhere", "d", 3)])
    two = events(spark, [("click", "a", 23), ("click", "e", 23), ("click", "b", 25)])
    three = events(spark, [("click", "a", 24), ("click", "e", 46), ("click", "b", 26)])
    want = [("a", "duplicate"), ("a", "published"), ("b", "published"), ("c", "no-subscribers"), ("d", "no-topic")]
    assert statuses(api.publish(one, index, root, 0)) == want
    second = [("a", "duplicate"), ("b", "duplicate"), ("e", "published")]
    assert statuses(api.publish(two, index, root, 1)) == second
    ledger = sorted(map(tuple, sp.read_committed(spark, root, "ledger").collect()))
    assert statuses(api.publish(two, index, root, 1)) == second  # a replay changes nothing
    assert sorted(map(tuple, sp.read_committed(spark, root, "ledger").collect())) == ledger
    assert statuses(api.publish(three, index, root, 2)) == [("a", "published"), ("b", "published"), ("e", "duplicate")]


def test_an_unreadable_ledger_is_an_error(spark, scratch):
    index, root = fx.fixture_index(spark), os.path.join(scratch, "pub")
    api.publish(events(spark, [("click", "a", 0)]), index, root, 0)
    with open(os.path.join(root, "ledger", "batch_id=0", "part-broken.parquet"), "w") as f:
        f.write("no table")
    with pytest.raises(Exception):
        api.publish(events(spark, [("click", "a", 1)]), index, root, 1)


def body(i, stamp, payload, subject="click"):
    uid = f"00000000-0000-4000-8000-{i:012d}"
    return json.dumps({"eventId": uid, "subject": subject, "groupId": "g", "timestamp": stamp, "event": payload})


def test_every_streamed_body_gets_a_response(spark, scratch):
    """Publisher times from 2000 to 2200 over three micro-batches, one id resent."""
    src, root = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    stamps = ["2200-01-01T00:00:00.000Z", "2024-01-01T00:00:00.000Z", "2000-01-01T00:00:00.000Z"]
    for k, stamp in enumerate(stamps):
        rows = [(body(10 * k + j, stamp, {"props": {"k": 60}}),) for j in range(3)] + [(body(0, stamp, {"x": 1}),)]
        spark.createDataFrame(rows, "body string").coalesce(1).write.mode("append").parquet(src)
        stream = sp.events_from_bodies(file_stream(spark, src, spark.read.parquet(src).schema))
        q = sp.publish_stream(stream, fx.fixture_index(spark), root, os.path.join(scratch, "ckpt"))
        q.awaitTermination(600)
    got = sp.read_committed(spark, root, "responses").collect()
    assert len(got) == 12
    assert sum(r.status == "published" for r in got) == 9 and sum(r.status == "duplicate" for r in got) == 3


PAYLOADS = [{"a": 1, "b": "x}"}, [1, 2], 'text " quoted', 'looks {"like":1}', 5, True, None, {"event": {"event": 1}}]


def test_requests_and_audits_of_real_bodies(spark):
    rows = [("click", "audit-all", f"id{k}", "click", "g", T0, body(k, "2024-03-01T00:00:00.000Z", p), "q") for k, p in enumerate(PAYLOADS)]
    df = spark.createDataFrame(
        rows, "topic string, subscriber string, event_id string, subject string, group_id string, timestamp timestamp, event string, queue string"
    )
    subs = spark.createDataFrame([("click", "audit-all", "u", "POST")], "topic string, subscriber string, uri string, http_method string")
    for r in delivery.render_requests(df, subs).collect():
        pairs = json.loads(r.body, object_pairs_hook=list)
        assert [k for k, _ in pairs] == ["eventId", "subject", "groupId", "timestamp", "event"]
        assert json.loads(r.body)["event"] == PAYLOADS[int(r.event_id[2:])]
    for r in publish.audit_rows(df, F.lit("boom")).collect():
        assert json.loads(r.detail["event"]) == PAYLOADS[int(r.event_id[2:])] and r.detail["reason"] == "boom"


def test_other_failures_are_server_errors(spark):
    names = ["published", "duplicate", "no-subscribers", "no-topic", "invalid", "failed", None]
    df = spark.createDataFrame([(n, ["s"]) for n in names], "status string, subscribers array<string>")
    assert [r.http_code for r in publish.publish_response(df).collect()] == [201, 201, 201, 404, 400, 500, 500]


def test_one_row_per_subscription_is_the_same_on_every_run(spark):
    raw = catalog_from_nested(spark, {"t": {"s": {"uri": "b", "elements": "2"}}})
    both = raw.union(catalog_from_nested(spark, {"t": {"s": {"uri": "a", "elements": "1"}}}))
    for n in (1, 3, 7):
        (row,) = load_subscriptions(both.repartition(n)).collect()
        assert (row.uri, row.elements) == ("a", 1)


def test_payload_text_is_cut_as_it_was_sent():
    from fanline.functions.json_text import _member_text

    cases = {
        '{"a":{"event":1},"event": 1.10 ,"z":[]}': "1.10", '{"event":1e400,"a":2}': "1e400", '{"event":12345678901234567890.10}': "12345678901234567890.10",
        '{"a":"\\"event\\":7","event":"x, \\"y\\" }"}': '"x, \\"y\\" }"', '{"event":1,"event":[1.0, 2]}': "[1.0, 2]",
        '{"a":1}': None, "[]": None, "": None, '{"event":': None, "{": None, '{"event":{"b":{}}}': '{"b":{}}',
    }
    assert {k: _member_text(k, "event") for k in cases} == cases


def test_jitter_is_the_same_on_any_partitioning(spark):
    from fanline.operators.delivery import unit_random

    df = spark.range(200).select((F.col("id") % 7).cast("string").alias("queue"), "id")
    runs = [{(r.queue, r.id): r.u for r in df.repartition(n).select("queue", "id", unit_random(3, F.col("queue"), F.col("id")).alias("u")).collect()} for n in (1, 5)]
    assert runs[0] == runs[1] and all(0 <= u < 1 for u in runs[0].values()) and len(set(runs[0].values())) == 200
    assert 0.4 < sum(runs[0].values()) / 200 < 0.6
