"""Streams that fold many work items, or all rows of a queue, in one call."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fanline.streaming.sources import file_stream
from fanline.streaming.state import retry_stream, throttle_stream, work_state_stream

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("queue string, item_id long, attempt_id long, sent_at timestamp, status_code int, "
          "error_class string, error_message string")


def drain(spark, scratch, waves, build, mode):
    folder, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for rows in waves:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        q = (
            build(file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)).writeStream.outputMode(mode)
            .foreachBatch(lambda b, i: b.withColumn("_batch", F.lit(i)).write.mode("append").parquet(out))
            .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start()
        )
        q.awaitTermination(300)
    return spark.read.parquet(out).orderBy("_batch").collect()


def attempt(item, n, minutes, code, queue="q"):
    return (queue, item, n, T0 + dt.timedelta(minutes=minutes), code, None, None)


def test_items_of_one_group_keep_their_own_state_and_timer(spark, scratch):
    waves = [
        [attempt(1, 1, 0, 503), attempt(2, 2, 0, 200), attempt(None, 3, 1, 400), attempt(0, 4, 1, 429, None)],
        [attempt(1, 5, 30, 503), attempt(3, 6, 200, 503), attempt(2, 7, 31, 503)],
        [attempt(1, 8, 205, 200), attempt(4, 9, 206, 200)],
    ]
    got = drain(spark, scratch, waves, lambda df: work_state_stream(df, parts=1), "update")
    seen = {}
    for r in got:
        seen.setdefault((r.queue, r.item_id), []).append((r.state, r.failure_count, r.dispatches, r.due_again))
    assert seen["q", 1] == [("failed", 1, 1, False), ("failed", 2, 2, False), ("failed", 2, 2, True),
                            ("succeeded", 2, 3, False)]
    assert seen["q", 2] == [("succeeded", 0, 1, False)] * 2  # a late result is ignored
    assert seen["q", None] == [("permanently-failed", 0, 1, False)]
    assert seen[None, 0] == [("failed", 1, 1, False), ("failed", 1, 1, True)]
    assert seen["q", 3] == [("failed", 1, 1, False)] and seen["q", 4] == [("succeeded", 0, 1, False)]


def test_chains_of_one_group_go_on_across_micro_batches(spark, scratch):
    waves = [
        [attempt(1, 1, 0, 503), attempt(1, 2, 1, 503), attempt(2, 3, 1, 200), attempt(None, 4, 1, 503)],
        [attempt(1, 5, 2, 200), attempt(1, 6, 3, 503), attempt(2, 7, 2, 503), attempt(None, 8, 2, 503)],
    ]
    got = drain(spark, scratch, waves, lambda df: retry_stream(df, parts=1), "append")
    rows = {(r.item_id, r.attempt_id, r.attempt_no, r.delay_ms, r.cum_delay_ms) for r in got}
    assert rows == {(1, 1, 1, 0.0, 0.0), (1, 2, 2, 100.0, 100.0), (1, 5, 3, 200.0, 300.0), (2, 3, 1, 0.0, 0.0),
                    (None, 4, 1, 0.0, 0.0), (None, 8, 2, 100.0, 100.0)}


def test_throttle_groups_hold_times_and_ids_only(spark, scratch):
    schema = "queue string, id long, received_at timestamp, item string"
    rows = [("q", None if i == 7 else i, T0 + dt.timedelta(seconds=i), "x" * 50) for i in range(200)]
    spark.createDataFrame(rows, schema).write.parquet(os.path.join(scratch, "in"))
    st = throttle_stream(file_stream(spark, os.path.join(scratch, "in"), spark.createDataFrame([], schema).schema))
    plan = st._jdf.queryExecution().analyzed().toString()
    group = next(x for x in plan.splitlines() if "FlatMapGroupsInPandasWithState" in x)
    assert "item#" not in group
    out = os.path.join(scratch, "out")
    st.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start().awaitTermination(300)
    got = {r.id: (r.slot, r.send_at) for r in spark.read.parquet(out).collect()}
    assert got == {None if i == 7 else i: (i // 60, T0 + dt.timedelta(seconds=3 * (i // 60))) for i in range(200)}
