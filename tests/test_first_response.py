"""The first of several responses per item over several micro-batches, and items without one."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fanline.streaming.first_response import first_response_stream
from fanline.streaming.sources import file_stream

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "kind string, queue string, id long, at timestamp"


def test_first_response_per_item(spark, scratch):
    def at(hours, seconds=0.0):
        return T0 + dt.timedelta(hours=hours, seconds=seconds)

    waves = [
        [("e", "a", i, at(0, i)) for i in range(20)] + [("r", "a", 0, at(0, 9.5)), ("r", "a", 0, at(0, 4.25)), ("r", "a", 1, at(0, 0.5))],
        [("r", "a", 1, at(3)), ("r", "a", 2, at(3)), ("r", "b", 3, at(3)), ("e", None, 5, at(3)), ("r", None, 5, at(4)),
         ("e", "a", 4, None), ("r", "a", 6, None)],
        [("r", "a", 0, at(20)), ("r", "a", 19, at(23.99)), ("e", "a", 100, at(20))],
        [("r", "a", 7, at(25)), ("e", "a", 101, at(60)), ("r", "z", 9, at(60))],
        [("e", "a", 102, at(61)), ("r", "z", 9, at(61))],
    ]
    folder, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for rows in waves:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        raw = file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)
        enq = raw.where("kind = 'e'").select("queue", "id", F.col("at").alias("enqueued_at"))
        resp = raw.where("kind = 'r'").select("queue", "id", F.col("at").alias("handled_at"))
        q = (
            first_response_stream(enq, resp, ["queue", "id"]).writeStream
            .foreachBatch(lambda b, i: b.write.mode("append").parquet(out))
            .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start()
        )
        q.awaitTermination(300)
    got = spark.read.parquet(out).collect()
    timed = {(r.queue, r.id): r.e2e_ms for r in got}
    want = {("a", i): None for i in range(20)}
    want[("a", 0)] = 4250  # the least of three
    want[("a", 1)] = 3 * 3_600_000 - 1000  # an answer before its item does not count
    want[("a", 2)] = 3 * 3_600_000 - 2000
    want[("a", 19)] = round(23.99 * 3_600_000) - 19_000
    want[(None, 5)] = None  # a NULL key meets nothing
    want[("a", 100)] = None
    assert timed == want  # 7 was answered after its bound; 101 and 102 are still open
    assert len(got) == len(timed)
