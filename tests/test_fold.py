"""The partition fold is independent of how Arrow splits a partition into batches."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from fanline.operators.dedup import _fold_partitions, fold_sorted


@pytest.mark.parametrize("batch", [1, 7, 1000, 9999, 100000])
def test_fold_is_batch_split_invariant(batch):
    rng = np.random.default_rng(1)
    n = 20000
    df = pd.DataFrame(
        {
            "k": rng.integers(0, 40, n),
            "ts": pd.to_datetime(rng.integers(0, 10**12, n), unit="us"),
            "e": rng.random(n) < 0.8,
        }
    ).sort_values(["k", "ts"], kind="mergesort").reset_index(drop=True)
    ttl = 3600 * 10**6
    acc, dup = fold_sorted(df.k.to_numpy(), df.ts.to_numpy(dtype="datetime64[us]").astype(np.int64), df.e.to_numpy(), ttl)
    parts = pa.Table.from_pandas(df, preserve_index=False).to_batches(max_chunksize=batch)
    out = pa.Table.from_batches(list(_fold_partitions("k", "ts", "e", ttl)(iter(parts)))).to_pandas()
    assert (out.accepted.to_numpy() == acc).all() and (out.duplicate.to_numpy() == dup).all()


def test_fold_matches_sequential_definition():
    rng = np.random.default_rng(7)
    k = np.sort(rng.integers(0, 5, 3000))
    t = np.zeros(3000, dtype=np.int64)
    for key in range(5):
        m = k == key
        t[m] = np.sort(rng.integers(0, 10**6, m.sum()))
    e = rng.random(3000) < 0.7
    ttl = 20_000
    acc, dup = fold_sorted(k, t, e, ttl)
    last = {}
    for i in range(3000):
        lk = last.get(k[i])
        a = bool(e[i]) and (lk is None or t[i] >= lk + ttl)
        assert acc[i] == a
        assert dup[i] == ((not a) and lk is not None and t[i] < lk + ttl)
        if a:
            last[k[i]] = t[i]


def test_large_integers_beside_null_keep_their_value(spark):
    """Keys one apart above 2**53, NULL keys, and NULLs in a passed column."""
    from datetime import datetime

    from fanline.operators import dedup

    at = datetime(2024, 1, 1)
    rows = [(2**53, at, 1, None), (2**53 + 1, at, 2, 2**53 + 3), (None, at, 3, 2**53 + 5), (None, at, 4, None)]
    df = spark.createDataFrame(rows, "k long, received_at timestamp, event_id long, passed long")
    for threshold in (1, 10**6):
        got = {r.event_id: r for r in dedup.ttl_status(df, "k", 3600, hot_threshold=threshold).collect()}
        assert {i: (r.k, r.passed) for i, r in got.items()} == {e: (k, p) for k, _, e, p in rows}
        assert [got[i].accepted for i in (1, 2)] == [True, True]
        assert sorted([got[3].accepted, got[4].accepted]) == [False, True]


@pytest.mark.parametrize("threshold", [3, 10**6])
def test_key_that_is_its_own_tiebreak(spark, threshold):
    """A resent event id: key and tiebreak are the same column and repeat."""
    from datetime import datetime, timedelta

    from fanline.operators import dedup

    at = datetime(2024, 1, 1)
    rows = [(i, at + timedelta(hours=h)) for i in (7, 8) for h in (0, 0, 1, 5, 24, 24, 25, 30, 49, 49, 49, 60)]
    df = spark.createDataFrame(rows, "event_id long, received_at timestamp")
    got = dedup.ttl_status(df, "event_id", 86400, hot_threshold=threshold).collect()
    assert len(got) == len(rows)
    for i in (7, 8):
        hours = sorted((r.received_at - at).total_seconds() / 3600 for r in got if r.event_id == i and r.accepted)
        assert hours == [0, 24, 49]
        assert sum(r.duplicate for r in got if r.event_id == i) == 9
