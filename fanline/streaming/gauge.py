"""D7 + A7: the number of active members over time, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_gauge_stream(heartbeats: DataFrame, timeout: str = "30 seconds", every: str = "10 seconds",
                        watermark: str = "1 minute") -> DataFrame:
    """(at, active long): at every multiple of ``every``, the instances whose newest
    heartbeat before ``at`` is at most ``timeout`` old; written once the watermark has
    passed ``at``.

    A heartbeat falls into the sliding windows that end while it counts; one stateful
    aggregate keeps an instance once per window, a second one counts them, with a
    map-side step, so neither a hot instance nor a long member list meets one task.
    State holds ``timeout / every`` rows per live instance. Moments without a member
    give no row; heartbeats without an instance or a time do not count.
    """
    hb = heartbeats.where(F.col("instance_id").isNotNull() & F.col("seen_at").isNotNull())
    hb = hb.withColumn("seen_at", F.col("seen_at").cast("timestamp")).withWatermark("seen_at", watermark)
    seen = hb.groupBy(F.window("seen_at", timeout, every).alias("window"), "instance_id").agg(F.count(F.lit(1)).alias("n"))
    active = seen.groupBy("window").agg(F.count(F.lit(1)).alias("active"))
    return active.select(F.col("window.end").alias("at"), "active")
