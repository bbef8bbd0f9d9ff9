"""Active members at each moment, over several micro-batches, against a plain count."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fanline.streaming.gauge import active_gauge_stream
from fanline.streaming.sources import file_stream

T0 = dt.datetime(2024, 3, 1)


def test_gauge_equals_a_plain_count(spark, scratch):
    def at(s):
        return T0 + dt.timedelta(seconds=s)

    beats = [(1, s) for s in range(0, 300, 3)]  # one instance sends a third of all
    beats += [(i, 7 * i + 11 * k) for i in range(2, 9) for k in range(i)] + [(9, 0), (9, 30), (9, 60), (10, 299)]
    folder, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for lo in (0, 100, 200):
        rows = [(i, at(s)) for i, s in beats if lo <= s < lo + 100] + [(None, at(lo)), (3, None)]
        df = spark.createDataFrame(rows + rows[:2], "instance_id long, seen_at timestamp")
        df.coalesce(1).write.mode("append").parquet(folder)
        q = (
            active_gauge_stream(file_stream(spark, folder, df.schema), "30 seconds", "10 seconds", "10 seconds")
            .writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(out))
            .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start()
        )
        q.awaitTermination(300)
    got = {r.at: r.active for r in spark.read.parquet(out).collect()}
    clock = max(s for _, s in beats) - 10
    want = {at(m): len({i for i, s in beats if m - 30 <= s < m}) for m in range(10, clock + 1, 10)}
    assert got == {m: n for m, n in want.items() if n}
    assert spark.read.parquet(out).count() == len(got)
