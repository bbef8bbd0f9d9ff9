import pytest

from fanline import constants as C
from fanline.functions.http import classify_outcome, failed_status, is_retryable
from fanline.operators.queue import work_state

CLOSED = "The http server closed the connection unexpectedly"

# (status_code, error_class, error_message) -> (retry?, outcome)
CASES = [
    ((200, None, None), (False, "Sent")),
    ((201, None, None), (False, "Sent")),
    ((301, None, None), (False, "Removed")),
    ((400, None, None), (False, "Removed")),
    ((404, None, None), (False, "Removed")),
    ((429, None, None), (True, "Failed")),
    ((500, None, None), (True, "Failed")),
    ((503, None, None), (True, "Failed")),
    ((100, None, None), (False, "Removed")),
    ((None, "RequestTimeoutException", None), (True, "Failed")),
    ((None, "RuntimeException", CLOSED + " while reading"), (True, "Failed")),
    ((None, "IllegalStateException", "boom"), (False, "Failed")),
    ((None, "RuntimeException", "other"), (False, "Failed")),
]


def test_retry_and_outcome_truth_table(spark):
    df = spark.createDataFrame([c for c, _ in CASES], "code int, err string, msg string")
    got = df.select(is_retryable("code", "err", "msg"), classify_outcome("code"), failed_status("code")).collect()
    for (inp, (retry, outcome)), row in zip(CASES, got):
        assert (row[0], row[1]) == (retry, outcome), inp
        assert row[2] == (str(inp[0]) if inp[0] is not None else "exceptional")


@pytest.mark.parametrize("limit,expected_dispatches", [(3, 5), (0, 2)])
def test_failure_limit_is_checked_before_incrementing(spark, limit, expected_dispatches):
    rows = [("q", 1, i, C.FAILED_OUTCOME) for i in range(10)]
    df = spark.createDataFrame(rows, "queue string, item_id long, sent_at long, outcome string")
    (r,) = work_state(df.withColumn("attempt_id", df.sent_at), ["queue", "item_id"], ["sent_at", "attempt_id"], limit).collect()
    assert r.state == C.PERMANENTLY_FAILED
    assert r.dispatches == expected_dispatches
    assert r.failure_count == limit + 1


def test_work_state_transitions(spark):
    rows = [
        ("q", 1, 0, "Failed"), ("q", 1, 1, "Sent"), ("q", 1, 2, "Failed"),
        ("q", 2, 0, "Removed"), ("q", 2, 1, "Sent"),
        ("q", 3, 0, "Failed"), ("q", 3, 1, "Failed"),
    ]
    df = spark.createDataFrame(rows, "queue string, item_id long, sent_at long, outcome string")
    df = df.withColumn("attempt_id", df.sent_at)
    got = {r.item_id: (r.state, r.failure_count, r.dispatches) for r in
           work_state(df, ["queue", "item_id"], ["sent_at", "attempt_id"]).collect()}
    assert got == {1: ("succeeded", 1, 2), 2: ("permanently-failed", 0, 1), 3: ("failed", 2, 2)}


def test_backoff_delays_and_jitter_bounds(spark):
    from pyspark.sql import functions as F

    from fanline.operators.delivery import backoff_delay_ms, jittered

    df = spark.range(0, 150).select(F.col("id").alias("n"))
    d = df.select("n", backoff_delay_ms(F.col("n"), 100, 600_000).alias("d"))
    j = d.select("n", "d", jittered(F.col("d"), [F.col("n")]).alias("j")).collect()
    assert [r.d for r in j[:5]] == [100.0, 200.0, 400.0, 800.0, 1600.0]
    assert all(r.d == 600_000.0 for r in j if r.n >= 13)
    assert all(r.d <= r.j < r.d * 1.2 for r in j)
    assert round(sum(r.d for r in j) / 1000, 1) == 83019.1  # the ~23 h worst-case span


def test_work_state_with_picks(spark):
    rows = [
        ("q", 1, 0, "Picked"), ("q", 1, 1, "Failed"), ("q", 1, 2, "Picked"),   # picked again, no result yet
        ("q", 2, 0, "Picked"), ("q", 2, 1, "Sent"), ("q", 2, 2, "Picked"),     # finished: later picks ignored
        ("q", 3, 0, "Picked"), ("q", 3, 1, "Failed"),
    ]
    df = spark.createDataFrame(rows, "queue string, item_id long, sent_at long, outcome string")
    df = df.withColumn("attempt_id", df.sent_at)
    got = {r.item_id: (r.state, r.failure_count, r.dispatches) for r in
           work_state(df, ["queue", "item_id"], ["sent_at", "attempt_id"]).collect()}
    assert got == {1: ("in-progress", 1, 1), 2: ("succeeded", 0, 1), 3: ("failed", 1, 1)}
