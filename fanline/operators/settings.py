"""Per-subscriber settings (throttle, back-off, retries) joined to queue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.operators import delivery
from fanline.operators.matching import queue_name
from fanline.sources.catalog import valid_subscriptions

#: setting -> value for a queue without a usable subscription
DEFAULTS = {
    "elements": C.DEFAULT_ELEMENTS,
    "per_ms": C.DEFAULT_PER_MS,
    "max_connections": C.DEFAULT_MAX_CONNECTIONS,
    "min_backoff_ms": C.DEFAULT_MIN_BACKOFF_MS,
    "max_backoff_ms": C.DEFAULT_MAX_BACKOFF_MS,
    "max_retries": C.DEFAULT_MAX_RETRIES,
}


def with_settings(rows: DataFrame, catalog: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with the settings ``names`` of their ``queue``'s subscriber.

    ``catalog``: what ``load_subscriptions`` gives, with at most one row per (topic,
    subscriber); rows with errors count as missing, and a queue without a subscription
    (a NULL queue too) has the defaults. Whether the catalog is broadcast is left to
    Spark, which knows its size. Columns of ``rows`` with a setting's name are replaced.
    """
    own = valid_subscriptions(catalog).select(
        queue_name(F.col("topic"), F.col("subscriber")).alias("queue"), *names
    )
    kept = rows.drop(*names)
    joined = kept.join(own, "queue", "left")
    return joined.withColumns({n: F.coalesce(n, F.lit(DEFAULTS[n])) for n in names}).select(*kept.columns, *names)


def throttle_by_subscriber(rows: DataFrame, catalog: DataFrame, order: list[str], instances: int = 1) -> DataFrame:
    """W5 at every subscriber's own rate: ``elements`` per ``per_ms`` over the fleet,
    of which each of ``instances`` takes its share (a row costs that many units)."""
    paced = with_settings(rows, catalog, ["elements", "per_ms"])
    return delivery.throttle_schedule(
        paced, "queue", order, F.col("elements"), F.col("per_ms"), cost=max(instances, 1)
    )


def retries_by_subscriber(attempts: DataFrame, catalog: DataFrame, keys: list[str], jitter: float = 0.0) -> DataFrame:
    """W6 + W4 by every subscriber's own ``max_retries`` and back-off span, over
    numbered attempts: the attempts sent, the delay before each, and their sum."""
    told = with_settings(attempts, catalog, ["max_retries", "min_backoff_ms", "max_backoff_ms"])
    sent = delivery.retry_chain(told, keys, F.col("max_retries"))
    return delivery.backoff_schedule(sent, keys, F.col("min_backoff_ms"), F.col("max_backoff_ms"), jitter=jitter)
