"""The first response per work item, and the items that had none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_response_stream(enqueued: DataFrame, responses: DataFrame, keys: list[str], bound: str = "24 hours",
                          watermark: str = "10 minutes") -> DataFrame:
    """(keys..., enqueued_at, e2e_ms): one row per enqueued item, written when its
    ``bound`` has passed on the watermark of both streams.

    A stream-stream left outer join within ``bound`` feeds a second stateful operator
    that keeps the least response time of an item; an item without a response in time
    has a NULL ``e2e_ms``. Both states hold the items of one bound. An item enqueued
    twice at one time counts once; items and responses without a time, and responses
    before their item or to a NULL key, do not count.
    """
    e = enqueued.where(F.col("enqueued_at").isNotNull()).withWatermark("enqueued_at", watermark).select(*keys, "enqueued_at").alias("e")
    r = responses.withWatermark("handled_at", watermark).select(*keys, "handled_at").alias("r")
    cond = [F.col(f"e.{k}") == F.col(f"r.{k}") for k in keys]
    cond.append(F.col("r.handled_at") >= F.col("e.enqueued_at"))
    cond.append(F.col("r.handled_at") <= F.col("e.enqueued_at") + F.expr(f"INTERVAL {bound}"))
    met = e.join(r, cond, "left_outer").select(
        *[F.col(f"e.{k}").alias(k) for k in keys], F.col("e.enqueued_at").alias("enqueued_at"),
        F.unix_micros("r.handled_at").alias("handled_us"),
    )
    first = met.groupBy(*keys, "enqueued_at").agg(F.min("handled_us").alias("handled_us"))
    ms = F.floor((F.col("handled_us") - F.unix_micros("enqueued_at")) / 1000).cast("bigint")
    return first.select(*keys, "enqueued_at", ms.alias("e2e_ms"))
