"""The hot-key paths must equal the plain per-key computations exactly."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import SF_CHECK
from fanline.operators import dedup, matching
from fanline.operators.dedup import fold_sorted
from fanline.operators.hotkeys import Scan, asof_next, keyed_window
from fanline.plans import fixture as fx


def _data(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.6 else rnd.randint(1, 20)  # key 0 is hot
        v = rnd.choice([None, rnd.randint(-50, 50)])
        rows.append((k, rnd.randint(0, 10_000), i, v))
    return spark.createDataFrame(rows, "k long, t long, id long, v long")


def test_keyed_window_hot_equals_plain(spark):
    df = _data(spark)
    scans = {
        "rn": Scan("row_number"), "s": Scan("sum", "v"), "sx": Scan("sum", "v", exclusive=True),
        "mn": Scan("min", "v"), "mx": Scan("max", "v", exclusive=True), "lst": Scan("last", "v", exclusive=True),
    }
    hot = keyed_window(df, ["k"], ["t", "id"], scans, threshold=100)
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = keyed_window(df, ["k"], ["t", "id"], scans, threshold=10**9)
    cols = ["id", *scans]
    assert sorted(map(tuple, hot.select(cols).collect())) == sorted(map(tuple, plain.select(cols).collect()))
    rn = df.withColumn("rn", F.row_number().over(w)).select("id", "rn")
    assert sorted(map(tuple, rn.collect())) == sorted(map(tuple, hot.select("id", "rn").collect()))


def test_asof_next_brute_force(spark):
    rnd = random.Random(5)
    # negative ids and times (before 1970) must work too
    ev = [(rnd.choice([1, 1, 1, 2]), rnd.randint(-500, 500), i - 300) for i in range(600)]
    pr = [(rnd.choice([1, 2, 3]), rnd.randint(-520, 520), 10_000 + i) for i in range(300)]
    events = spark.createDataFrame(ev, "k long, t long, eid long")
    probes = spark.createDataFrame(pr, "k long, t long, pid long")
    got = {r.pid: r.nid for r in asof_next(probes, events, "k", 7).collect()}
    for k, t, pid in pr:
        cands = sorted((et, eid) for ek, et, eid in ev if ek == k and et >= t)
        assert got[pid] == (cands[0][1] if cands else None), pid


def brute_fold(rows, ttl):
    """Reference fold in plain Python: (key, t, id, eligible) -> {id: (accepted, duplicate)}."""
    out, by = {}, {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for _, rs in by.items():
        last = None
        for k, t, i, e in sorted(rs, key=lambda r: (r[1], r[2])):
            acc = bool(e) and (last is None or t >= last + ttl)
            dup = (not acc) and last is not None and t < last + ttl
            if acc:
                last = t
            out[i] = (acc, dup)
    return out


def test_ttl_status_hot_and_cold_equal_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(2500):
        k = 0 if rnd.random() < 0.5 else rnd.randint(1, 30)
        rows.append((k, rnd.randint(0, 200_000) * 1_000_000, i, rnd.random() < 0.8))
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    sdf = spark.createDataFrame(
        [(k, base + dt.timedelta(microseconds=t), i, e) for k, t, i, e in rows],
        "k long, received_at timestamp_ntz, event_id long, e boolean",
    )
    expect = brute_fold(rows, 3600 * 1_000_000)
    for threshold in (10**9, 200):
        got = dedup.ttl_status(sdf, "k", 3600, eligible=F.col("e"), hot_threshold=threshold)
        res = {r.event_id: (r.accepted, r.duplicate) for r in got.collect()}
        assert res == expect, threshold


def test_publish_status_with_all_keys_hot(spark):
    ev = fx.fixture_events(spark, SF_CHECK)
    m = matching.publishable(ev, matching.SubscriptionIndex.build(fx.fixture_catalog(spark)))
    cols = ["event_id", "accepted", "duplicate"]
    cold = dedup.ttl_status(m, "group_id", 86400, eligible=F.col("publishable")).select(cols)
    hot = dedup.ttl_status(m, "group_id", 86400, eligible=F.col("publishable"), hot_threshold=40).select(cols)
    assert sorted(map(tuple, cold.collect())) == sorted(map(tuple, hot.collect()))


def test_work_state_with_hot_items_equals_cold(spark):
    """Two-column keys through the hot path: every work item forced hot."""
    from fanline.operators.queue import outcomes_from_attempts, work_state

    a = outcomes_from_attempts(fx.fixture_attempts_unnumbered(spark, SF_CHECK))
    keys, order = ["queue", "item_id"], ["sent_at", "attempt_id"]
    cold = work_state(a, keys, order)
    hot = work_state(a, keys, order, threshold=5)
    assert sorted(map(tuple, cold.collect())) == sorted(map(tuple, hot.collect()))


def test_throttle_with_hot_queue_equals_plain(spark):
    from fanline.operators.delivery import throttle_schedule

    rows = fx.queue_rows_from(spark.read.parquet(f"{SF_CHECK}/events.parquet")).select("queue", "id", "received_at")
    a = throttle_schedule(rows, "queue", ["received_at", "id"], 60, 3000)
    b = throttle_schedule(rows, "queue", ["received_at", "id"], 60, 3000, threshold=300)
    cols = ["queue", "id", "slot", "send_at"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_hot_queue_bound_from_topic_counts(spark):
    """Queues of topics above the threshold are offered as hot; the schedule is unchanged."""
    from fanline.plans.queries_metrics import hot_queues, q_throttle_schedule
    from fanline.operators.delivery import throttle_schedule
    from fanline.plans.queries_publish import published_queue_keys

    hot = hot_queues(spark, SF_CHECK, threshold=1500)
    assert {r.queue for r in hot.collect()} >= {"click_audit-all_queue", "click_high-k_queue"}
    rows = published_queue_keys(spark, SF_CHECK)
    a = throttle_schedule(rows, "queue", ["received_at", "id"], 60, 3000, threshold=1500, hot=hot)
    b = q_throttle_schedule(spark, SF_CHECK)
    cols = ["queue", "id", "slot", "send_at"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_hot_path_without_eligible_rows(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(1, base + dt.timedelta(minutes=i), i, False) for i in range(300)]
    sdf = spark.createDataFrame(rows, "k long, received_at timestamp_ntz, event_id long, e boolean")
    got = dedup.ttl_status(sdf, "k", 3600, eligible=F.col("e"), hot_threshold=50).collect()
    assert len(got) == 300 and not any(r.accepted or r.duplicate for r in got)


def test_null_key_can_be_hot(spark):
    """A missing key is a classic hot key: the hot paths must treat NULL as a key."""
    import datetime as dt

    rnd = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1500):
        k = None if rnd.random() < 0.6 else rnd.randint(1, 5)
        rows.append((k, base + dt.timedelta(seconds=rnd.randint(0, 400_000)), i, rnd.random() < 0.8))
    sdf = spark.createDataFrame(rows, "k long, received_at timestamp_ntz, event_id long, e boolean")
    cold = dedup.ttl_status(sdf, "k", 3600, eligible=F.col("e"), hot_threshold=10**9)
    hot = dedup.ttl_status(sdf, "k", 3600, eligible=F.col("e"), hot_threshold=100)
    cols = ["event_id", "accepted", "duplicate"]
    assert sorted(map(tuple, cold.select(cols).collect())) == sorted(map(tuple, hot.select(cols).collect()))
    scans = {"rn": Scan("row_number"), "s": Scan("sum", "event_id", exclusive=True)}
    a = keyed_window(sdf, ["k"], ["received_at", "event_id"], scans, threshold=10**9)
    b = keyed_window(sdf, ["k"], ["received_at", "event_id"], scans, threshold=100)
    assert sorted(map(tuple, a.select("event_id", "rn", "s").collect())) == sorted(
        map(tuple, b.select("event_id", "rn", "s").collect())
    )


@pytest.mark.parametrize("rows, span, share", [(4000, 300_000, 0.9), (4000, 5_000, 0.5), (1500, 20_000_000, 0.05), (600, 40, 1.0)])
def test_slices_compose_dense_sparse_and_tied_keys(spark, rows, span, share):
    """Many slices per TTL, many TTLs per slice, slices without eligible rows, ties."""
    import datetime as dt

    rnd = random.Random(rows + span)
    data = [(rnd.choice(["a", "a", "a", None, "b"]), rnd.randint(0, span), i, rnd.random() < share) for i in range(rows)]
    base = dt.datetime(2024, 1, 1)
    sdf = spark.createDataFrame(
        [(k, base + dt.timedelta(seconds=t), i, e) for k, t, i, e in data], "k string, received_at timestamp_ntz, event_id long, e boolean"
    )
    expect = brute_fold(data, 3600)
    got = dedup.ttl_status(sdf, "k", 3600, eligible=F.col("e"), hot_threshold=97).collect()
    assert {r.event_id: (r.accepted, r.duplicate) for r in got} == expect


def test_transfer_function_equals_the_fold():
    from fanline.operators.ttl_slices import transfer

    rng = np.random.default_rng(4)
    for _ in range(50):
        t = np.sort(rng.integers(0, 500, rng.integers(1, 60)))
        at, exits = transfer(t, 40)
        known = dict(zip(at.tolist(), exits.tolist()))
        for last in range(int(t[0]) - 60, int(t[0]) + 1):  # every anchor that may lie before the slice
            acc, _ = fold_sorted(np.zeros(len(t)), t, np.ones(len(t), bool), 40, {0: last})
            taken = np.flatnonzero(acc)
            if len(taken):
                assert known[int(taken[0])] == t[taken[-1]]


def test_slices_are_bounded_by_the_cores(spark):
    from fanline.operators.hotkeys import slice_count

    hot = spark.createDataFrame([("a", 30_000)], "k string, _n long")
    assert slice_count(hot, 3) == 4 * spark.sparkContext.defaultParallelism
    assert slice_count(hot, 20_000) == 2
    assert slice_count(spark.createDataFrame([("a", 10**9)], "k string, _n long"), 3) == 500
