"""Counters, latency distributions, cluster membership.

Every metric is an aggregation with a partial (map-side) step; exact
percentiles are ranks picked from counted values (``quantiles``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.http import failed_status, is_retryable
from fanline.functions.time import diff_ms
from fanline.operators.quantiles import exact_quantiles


def event_counters(status: DataFrame) -> DataFrame:
    """A2: ``event.{published|duplicate}.{topic}.{subject}`` counts."""
    kind = F.when(F.col("status") == C.ST_PUBLISHED, F.lit("published")).when(
        F.col("status") == C.ST_DUPLICATE, F.lit("duplicate")
    )
    named = status.where(kind.isNotNull()).select(
        F.concat_ws(".", F.lit("event"), kind, F.col("topic"), F.col("subject")).alias("metric")
    )
    return named.groupBy("metric").agg(F.count(F.lit(1)).alias("value"))


def subscriber_counters(enqueued: DataFrame, outcomes: DataFrame) -> DataFrame:
    """A3: ``subscriber.{enqueued|published|failed|permanently-failed}.{name}``.

    Keyed by subscriber name only: the same name on two topics merges.
    ``enqueued`` has a ``subscriber`` column; ``outcomes`` has ``subscriber``
    and ``outcome``.
    """
    enq = enqueued.select(F.lit("enqueued").alias("kind"), "subscriber")
    # every outcome is one of the three, so no filter is needed (a filter
    # here would be pushed into the derivation of ``outcome`` and copy it)
    kind = (
        F.when(F.col("outcome") == C.SENT, F.lit("published"))
        .when(F.col("outcome") == C.FAILED_OUTCOME, F.lit("failed"))
        .otherwise(F.lit("permanently-failed"))
    )
    res = outcomes.select(kind.alias("kind"), "subscriber")
    both = enq.unionByName(res)
    metric = F.concat_ws(".", F.lit("subscriber"), F.col("kind"), F.col("subscriber"))
    return both.groupBy(metric.alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def retry_counters(chain: DataFrame, max_retries: int | Column) -> DataFrame:
    """A4: ``subscriber.retry.{name}.{code|exceptional}``: retries scheduled.

    A retryable attempt schedules a retry only while attempt_no <= max_retries;
    the last allowed attempt does not.
    """
    mr = F.lit(max_retries) if isinstance(max_retries, int) else max_retries
    retried = chain.where(
        is_retryable("status_code", "error_class", "error_message") & (F.col("attempt_no") <= mr)
    )
    metric = F.concat_ws(".", F.lit("subscriber.retry"), F.col("subscriber"), failed_status("status_code"))
    return retried.groupBy(metric.alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def latency_stats(df: DataFrame, group: list[str], value: str, approx: bool = False,
                  threshold: int | None = None) -> DataFrame:
    """Count, min, max, mean and p50/p95/p99 per group.

    Exact percentiles are picked by rank from counted values
    (``quantiles.exact_quantiles``): no group is gathered, whatever its number of
    distinct latencies. ``approx=True`` uses a fixed-size sketch in one pass. A group
    whose latencies are all NULL has a row with n = 0 in the approximate form only.
    """
    shares = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    if approx:
        v = F.col(value)
        q = F.percentile_approx(v, F.array(*map(F.lit, shares.values())), 10_000).cast("array<double>")
        found = df.groupBy(*group).agg(
            F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.sum(v).alias("total"), q.alias("_q")
        ).withColumns({name: F.col("_q")[i] for i, name in enumerate(shares)})
    else:
        found = exact_quantiles(df, group, value, shares, threshold)
    return found.select(
        *group, "n", F.col("least").alias("min_ms"), F.col("most").alias("max_ms"),
        F.round(F.col("total") / F.col("n"), 6).alias("mean_ms"),
        *[F.round(name, 6).alias(name) for name in shares],
    )


def request_latency(attempts: DataFrame) -> DataFrame:
    """A5: per subscriber, over responses only (a failed request records nothing)."""
    return latency_stats(attempts.where(F.col("status_code").isNotNull()), ["subscriber"], "latency_ms")


def e2e_latency(enqueued: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """Enqueue time joined with the first handled response per item, in ms.

    ``enqueued``: keys + ``enqueued_at``; ``responses``: keys + ``handled_at``.
    The first response per item is reduced by an aggregate (partial step)
    before the join, so the join is one-to-one on the item keys.
    """
    first = responses.groupBy(*keys).agg(F.min("handled_at").alias("handled_at"))
    j = enqueued.join(first, keys)
    return j.select(*keys, diff_ms("enqueued_at", "handled_at").alias("e2e_ms"))


def last_seen(heartbeats: DataFrame) -> DataFrame:
    """Newest ``seen_at`` per instance (the upsert, as an aggregate)."""
    return heartbeats.groupBy("instance_id").agg(F.max("seen_at").alias("last_seen_at"))


def _cutoff(as_of: Column, timeout_ms: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(timeout_ms / 1000.0))


def active_members(heartbeats: DataFrame, as_of: Column, timeout_ms: int = C.INSTANCE_TIMEOUT_MS) -> DataFrame:
    """Instances seen within the timeout, and the total known."""
    seen = last_seen(heartbeats)
    active = F.col("last_seen_at") >= _cutoff(as_of, timeout_ms)
    return seen.agg(
        F.count_if(active).cast("bigint").alias("active"), F.count(F.lit(1)).cast("bigint").alias("total")
    )


def expired_members(heartbeats: DataFrame, as_of: Column, timeout_ms: int = C.INSTANCE_TIMEOUT_MS) -> DataFrame:
    """Instances whose last heartbeat is older than the timeout."""
    return last_seen(heartbeats).where(F.col("last_seen_at") < _cutoff(as_of, timeout_ms))
