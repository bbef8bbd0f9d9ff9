"""Registered queries: throttling, retries and back-off by each subscriber's settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fanline.operators import settings
from fanline.plans import fixture as fx
from fanline.plans.oracle_sql import ATT, EV, QUEUE
from fanline.plans.queries_delivery import attempts
from fanline.plans.registry import query
from fanline.sources.catalog import catalog_from_nested, load_subscriptions

# --- fixed values: own settings of three queues; the others have the defaults, one of
# them because its subscription is refused (a rate that is no number)
OWN_SETTINGS = {
    "click": {"main": {"uri": "http://localhost:9001/c", "elements": "7", "per": "2 seconds", "max-retries": "1",
                       "min-back-off": "250 ms", "max-back-off": "1 minute"}},
    "purchase": {"main": {"uri": "http://localhost:9001/p", "elements": "100", "max-retries": "0"}},
    "view": {"main": {"uri": "http://localhost:9001/v", "per": "500 ms", "max-retries": "4",
                      "min-back-off": "1 second", "max-back-off": "3 seconds"}},
    "error": {"main": {"uri": "http://localhost:9001/e", "elements": "many", "max-retries": "2"}},
}

CONF = """own(queue, elements, per_ms, max_retries, min_ms, max_ms) AS (VALUES
  ('click_main_queue', 7, 2000, 1, 250.0, 60000.0), ('purchase_main_queue', 100, 3000, 0, 100.0, 600000.0),
  ('view_main_queue', 60, 500, 4, 1000.0, 3000.0)),
  conf AS (SELECT n.queue, coalesce(elements, 60) AS elements, coalesce(per_ms, 3000) AS per_ms,
             coalesce(max_retries, 150) AS max_retries, coalesce(min_ms, 100.0) AS min_ms, coalesce(max_ms, 600000.0) AS max_ms
           FROM (SELECT DISTINCT event_type || '_main_queue' AS queue FROM events) n LEFT JOIN own USING (queue))"""

INSTANCES = 3


def _catalog(spark: SparkSession) -> DataFrame:
    return load_subscriptions(catalog_from_nested(spark, OWN_SETTINGS))


@query(
    "throttle_by_subscriber",
    f"""WITH {EV}, {QUEUE}, {CONF},
  r AS (SELECT q.queue, id, elements, per_ms, {INSTANCES} * (row_number() OVER w - 1) AS before, first_value(received_at) OVER w AS t0
        FROM q JOIN conf ON conf.queue = q.queue WINDOW w AS (PARTITION BY q.queue ORDER BY received_at, id))
SELECT queue, id, CAST(before // elements AS BIGINT) AS slot,
       t0 + CAST(before // elements AS BIGINT) * per_ms * INTERVAL 1 MILLISECOND AS send_at FROM r""",
)
def q_throttle_by_subscriber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every queue at its subscriber's rate, three instances."""
    rows = fx.fixture_queue(spark, sf_dir).select("queue", "id", "received_at")
    out = settings.throttle_by_subscriber(rows, _catalog(spark), ["received_at", "id"], INSTANCES)
    return out.select("queue", "id", "slot", "send_at")


@query(
    "retries_by_subscriber",
    f"""WITH {EV}, {ATT}, {CONF},
  sent AS (SELECT att.queue, item_id, attempt_id, attempt_no, min_ms, max_ms,
             coalesce(bool_and(retryable) OVER (PARTITION BY att.queue, item_id ORDER BY attempt_no
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS open
           FROM att JOIN conf ON conf.queue = att.queue WHERE attempt_no <= max_retries + 1),
  d AS (SELECT *, CASE WHEN attempt_no = 1 THEN 0.0 ELSE least(max_ms, min_ms * pow(2.0, attempt_no - 2)) END AS delay_ms
        FROM sent WHERE open)
SELECT queue, item_id, attempt_id, attempt_no, CAST(delay_ms AS DOUBLE) AS delay_ms,
       CAST(sum(delay_ms) OVER (PARTITION BY queue, item_id ORDER BY attempt_no) AS DOUBLE) AS cum_delay_ms FROM d""",
)
def q_retries_by_subscriber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 + W4: every queue's own retry limit and back-off span."""
    out = settings.retries_by_subscriber(attempts(spark, sf_dir), _catalog(spark), ["queue", "item_id"])
    return out.select("queue", "item_id", "attempt_id", "attempt_no", "delay_ms", "cum_delay_ms")
