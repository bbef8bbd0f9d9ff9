"""Rows released over several micro-batches = the batch's due rows at each clock."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fanline.operators.queue import due_work
from fanline.streaming.delay_queue import release_due
from fanline.streaming.sources import file_stream

SCHEMA = ("queue string, id long, status string, received_at timestamp, updated_at timestamp, "
          "available_at timestamp")
T0 = dt.datetime(2024, 3, 1)


def rounds():
    """Four rounds of an hour; one queue holds most rows; waits of 0 to 30 hours."""
    out = []
    for r, hour in enumerate((0, 2, 20, 40)):
        rows = []
        for i in range(60):
            t = T0 + dt.timedelta(hours=hour, seconds=47 * i + 0.25)
            st = ("todo", "failed", "in-progress", "permanently-failed", "todo")[i % 5]
            queue = "hot" if i % 3 else (None if i == 3 else f"q{i % 4}")
            rows.append((queue, r * 100 + i, st, t, t, t + dt.timedelta(minutes=(i * 37) % 1800)))
        out.append(rows)
    out[1].append(out[1][0])  # a repeated row
    out[1].append(("q2", 902, "todo", None, T0, T0 + dt.timedelta(hours=3)))  # no time of its own
    out[2].append(("q1", 900, "todo", T0 + dt.timedelta(hours=20), None, None))  # never due
    out[2].append(("q1", 901, "in-progress", T0 + dt.timedelta(hours=20), None, None))
    return out


def drain(spark, scratch, waves):
    folder, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for rows in waves:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        released = release_due(file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema))
        q = (
            released.writeStream.foreachBatch(
                lambda b, i: b.withColumn("_batch", F.lit(i)).write.mode("append").parquet(out))
            .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start()
        )
        q.awaitTermination(300)
    return spark.read.parquet(out)


def test_released_rows_equal_due_work_at_each_clock(spark, scratch):
    waves = rounds()
    got = drain(spark, scratch, waves).collect()
    clocks = sorted({r.released_at for r in got})
    assert len(clocks) >= 3
    for n, wave in enumerate(waves):
        # after the wave's closing batch the clock stands 10 minutes behind its newest row
        clock = max(r[3] for r in wave if r[3]) - dt.timedelta(minutes=10)
        known = spark.createDataFrame([r for w in waves[: n + 1] for r in w], SCHEMA)
        due = due_work(known, F.lit(clock).cast("timestamp"))
        want = sorted((r.queue or "", r.id) for r in due.collect())
        assert sorted((r.queue or "", r.id) for r in got if r.released_at <= clock) == want, n
    assert all(r.due_at < r.released_at for r in got)
    assert not {900, 901} & {r.id for r in got}


def test_query_gives_a_repeated_row_once_as_its_sql(spark, scratch):
    from fanline.plans.queries_stream import q_delay_queue_stream

    ev = [(i, T0 + dt.timedelta(hours=i), i % 3, "click", 1.0, '{"k": %d}' % (i % 7)) for i in (*range(40), 5, 5)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(ev, schema).write.parquet(os.path.join(scratch, "events.parquet"))
    ids = [r.id for r in q_delay_queue_stream(spark, scratch).collect()]
    assert 5 in ids and len(ids) == len(set(ids))


def test_rows_that_never_fall_due_move_the_clock(spark, scratch):
    last = ("q1", 1, "permanently-failed", T0 + dt.timedelta(hours=5), T0, T0)
    got = drain(spark, scratch, [[("q1", 2, "todo", T0, T0, T0), last]]).collect()
    assert [(r.id, r.released_at) for r in got] == [(2, T0 + dt.timedelta(hours=4, minutes=50))]


def test_rows_wait_in_any_state_store(spark, scratch):
    """A session that names no state store has Spark's own default one."""
    name = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        waves = rounds()
        waves[0].append(("q3", None, "todo", T0, T0, T0))  # no id
        got = drain(spark, scratch, waves[:2]).collect()
    finally:
        spark.conf.set(name, was)
    assert any(r.id is None and r.status == "todo" for r in got)
    assert len({r.released_at for r in got}) == 2 and all(r.due_at < r.released_at for r in got)
