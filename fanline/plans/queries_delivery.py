"""Registered queries: attempts, retries, back-off, throttling, queues, work state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.http import classify_outcome, is_retryable
from fanline.operators import delivery, queue
from fanline.plans import fixture as fx
from fanline.plans.oracle_sql import AS_OF, ATT, DUE, EV, QUEUE, chain_sql
from fanline.plans.registry import query

def as_of():
    return F.lit(fx.QUEUE_AS_OF).cast("timestamp_ntz")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ATTEMPT rows numbered per work item (queue, item_id) by (sent_at, attempt_id)."""
    raw = fx.fixture_attempts_unnumbered(spark, sf_dir).withColumn("subscriber", F.lit("main"))
    return delivery.number_attempts(raw, ["queue", "item_id"], ["sent_at", "attempt_id"])


def chain(spark: SparkSession, sf_dir: str, max_retries: int) -> DataFrame:
    return delivery.retry_chain(attempts(spark, sf_dir), ["queue", "item_id"], max_retries)


# ---------------------------------------------------------------------------
# F6 / F7 / W6 / W4


@query("retryable", f"WITH {EV}, {ATT}\nSELECT attempt_id, retryable FROM att")
def q_retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = fx.fixture_attempts_unnumbered(spark, sf_dir)
    return a.select("attempt_id", is_retryable("status_code", "error_class", "error_message").alias("retryable"))


@query("outcomes", f"WITH {EV}, {ATT}\nSELECT attempt_id, outcome FROM att")
def q_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = fx.fixture_attempts_unnumbered(spark, sf_dir)
    return a.select("attempt_id", classify_outcome("status_code").alias("outcome"))


@query(
    "retry_chain",
    f"WITH {EV}, {ATT}, {chain_sql(2)}\nSELECT queue, item_id, attempt_no, attempt_id FROM chain",
)
def q_retry_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 with 2 retries: the attempts actually sent per dispatch."""
    return chain(spark, sf_dir, 2).select("queue", "item_id", "attempt_no", "attempt_id")


@query(
    "backoff_schedule",
    f"""WITH {EV}, {ATT}, {chain_sql(C.DEFAULT_MAX_RETRIES)},
  b AS (SELECT queue, item_id, attempt_no,
          CASE WHEN attempt_no > 1 THEN least(600000.0, 100.0 * pow(2.0, attempt_no - 2)) ELSE 0.0 END AS delay_ms
        FROM chain)
SELECT queue, item_id, attempt_no, delay_ms,
       sum(delay_ms) OVER (PARTITION BY queue, item_id ORDER BY attempt_no) AS cum_delay_ms
FROM b""",
)
def q_backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jitter-free delays and cumulative delay along each retry chain."""
    ch = chain(spark, sf_dir, C.DEFAULT_MAX_RETRIES)
    out = delivery.backoff_schedule(ch, ["queue", "item_id"], C.DEFAULT_MIN_BACKOFF_MS, C.DEFAULT_MAX_BACKOFF_MS)
    return out.select("queue", "item_id", "attempt_no", "delay_ms", "cum_delay_ms")


@query(
    "backoff_jittered",
    f"""WITH {EV}, {ATT}, {chain_sql(C.DEFAULT_MAX_RETRIES)},
  b AS (SELECT queue, item_id, attempt_no,
          CASE WHEN attempt_no > 1 THEN least(600000.0, 100.0 * pow(2.0, attempt_no - 2)) * (1.0 + 0.2 *
            (CAST('0x' || substr(md5('7|' || queue || '|' || item_id || '|' || attempt_no), 1, 13) AS BIGINT) / 4503599627370496.0))
          ELSE 0.0 END AS delay_ms
        FROM chain)
SELECT queue, item_id, attempt_no, round(delay_ms, 4) AS delay_ms,
       round(sum(delay_ms) OVER (PARTITION BY queue, item_id ORDER BY attempt_no), 4) AS cum_delay_ms
FROM b""",
)
def q_backoff_jittered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 with its jitter of up to a fifth: the same delays on any partitioning."""
    ch = chain(spark, sf_dir, C.DEFAULT_MAX_RETRIES)
    out = delivery.backoff_schedule(
        ch, ["queue", "item_id"], C.DEFAULT_MIN_BACKOFF_MS, C.DEFAULT_MAX_BACKOFF_MS, jitter=C.BACKOFF_JITTER
    )
    return out.select(
        "queue", "item_id", "attempt_no", F.round("delay_ms", 4).alias("delay_ms"), F.round("cum_delay_ms", 4).alias("cum_delay_ms")
    )


_RAW = """'{"eventId":"' || event_id || '","subject":"s","event":' || CASE event_id % 9
    WHEN 0 THEN '{"amount":1.10,"n":' || event_id || '}' WHEN 1 THEN '1.50' WHEN 2 THEN '12345678901234567890.123456789'
    WHEN 3 THEN '1e400' WHEN 4 THEN '"1.10"' WHEN 5 THEN 'null' WHEN 6 THEN '[1.0,{"a":"b, c"}]' WHEN 7 THEN 'true'
    ELSE '"say \\"hi\\""' END || ',"groupId":"g"}'"""


@query(
    "payload_text",
    """SELECT event_id, CASE event_id % 9
    WHEN 0 THEN '{"amount":1.10,"n":' || event_id || '}' WHEN 1 THEN '1.50' WHEN 2 THEN '12345678901234567890.123456789'
    WHEN 3 THEN '1e400' WHEN 4 THEN '"1.10"' WHEN 5 THEN 'null' WHEN 6 THEN '[1.0,{"a":"b, c"}]' WHEN 7 THEN 'true'
    ELSE '"say \\"hi\\""' END AS payload FROM events""",
)
def q_payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4/K5: the payload of whole envelopes reaches subscribers and audit as it was sent."""
    from fanline.functions.json_text import payload_json
    from fanline.sources.tables import read_table

    envelopes = read_table(spark, sf_dir, "events").select("event_id", F.expr(_RAW.replace("\\", "\\\\")).alias("envelope"))
    return envelopes.select("event_id", payload_json(F.col("envelope")).alias("payload"))


# ---------------------------------------------------------------------------
# S5 / L1 / S6 / K9 / K10 / D3


@query("due_work", f"WITH {EV}, {QUEUE}\nSELECT queue, id, status FROM q WHERE {DUE}")
def q_due_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.due_work(fx.fixture_queue(spark, sf_dir), as_of()).select("queue", "id", "status")


@query(
    "next_due_per_queue",
    f"""WITH {EV}, {QUEUE}
SELECT queue, id, rank FROM (
  SELECT queue, id, CAST(row_number() OVER (PARTITION BY queue ORDER BY available_at, id) AS INTEGER) AS rank
  FROM q WHERE {DUE}) WHERE rank <= 4""",
)
def q_next_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: up to max-connections (4) items per queue, next in line."""
    out = queue.next_due(fx.fixture_queue(spark, sf_dir), as_of(), C.DEFAULT_MAX_CONNECTIONS)
    return out.select("queue", "id", F.col("rank").cast("int").alias("rank"))


def _damaged_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows whose stored item was truncated (k >= 98), by rule."""
    q = fx.fixture_queue(spark, sf_dir)
    k = F.get_json_object("item", "$.event.props.k").cast("int")
    return q.withColumn("item", F.when(k >= 98, F.expr("substring(item, 1, length(item) - 2)")).otherwise(F.col("item")))


@query(
    "quarantine_unreadable",
    f"""WITH {EV}, {QUEUE}, d AS (
  SELECT queue, id, status, CASE WHEN k >= 98 THEN substring(item, 1, length(item) - 2) ELSE item END AS item FROM q)
SELECT queue, id, NOT json_valid(item) AS unreadable,
       CASE WHEN NOT json_valid(item) THEN 'permanently-failed' ELSE status END AS status
FROM d""",
)
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = queue.quarantine_unreadable(_damaged_queue(spark, sf_dir))
    return out.select("queue", "id", "unreadable", "status")


@query(
    "expire_dead_work",
    f"""WITH {EV}, {QUEUE}
SELECT queue, id, status FROM q
WHERE NOT (status = 'permanently-failed' AND updated_at <= {AS_OF} - INTERVAL 86400 SECOND)""",
)
def q_expire_dead_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.expire_dead_work(fx.fixture_queue(spark, sf_dir), as_of()).select("queue", "id", "status")


@query(
    "apply_outcomes",
    f"""WITH {EV}, {ATT}, {QUEUE}
SELECT q.queue, q.id,
  CASE WHEN a.outcome IS NULL THEN q.status WHEN a.outcome = 'Removed' THEN 'permanently-failed'
       WHEN q.failure_count > 3 THEN 'permanently-failed' ELSE 'failed' END AS status,
  CASE WHEN a.outcome = 'Failed' AND q.failure_count <= 3 THEN q.failure_count + 1 ELSE q.failure_count END
    AS failure_count
FROM q LEFT JOIN att a ON a.queue = q.queue AND a.attempt_id = q.id
WHERE a.outcome IS NULL OR a.outcome <> 'Sent'""",
)
def q_apply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each queue row meets the outcome of its delivery attempt."""
    a = fx.fixture_attempts_unnumbered(spark, sf_dir)
    outcomes = a.select("queue", F.col("attempt_id").alias("id"), classify_outcome("status_code").alias("outcome"))
    out = queue.apply_outcomes(fx.fixture_queue(spark, sf_dir), outcomes, as_of())
    return out.select("queue", "id", "status", "failure_count")


WORK_STATE_SQL = f"""WITH {EV}, {ATT},
  s AS (
    SELECT att.*,
      CAST(outcome = 'Failed' AS INTEGER) AS f, CAST(outcome IN ('Sent', 'Removed') AS INTEGER) AS e,
      coalesce(sum(CAST(outcome = 'Failed' AS INTEGER)) OVER w, 0) AS fb,
      coalesce(sum(CAST(outcome IN ('Sent', 'Removed') AS INTEGER)) OVER w, 0) AS eb
    FROM att WINDOW w AS (PARTITION BY queue, item_id ORDER BY sent_at, attempt_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  live AS (
    SELECT *, (e = 1 OR (outcome = 'Failed' AND fb > 3)) AS term FROM s WHERE eb = 0 AND fb <= 4),
  g AS (
    SELECT queue, item_id,
      arg_min(CASE WHEN outcome = 'Sent' THEN 'succeeded' ELSE 'permanently-failed' END, (sent_at, attempt_id))
        FILTER (WHERE term) AS final,
      sum(f) AS fails, sum(CASE WHEN term THEN 0 ELSE f END) AS counted, count(*) AS dispatches
    FROM live GROUP BY queue, item_id)
SELECT queue, item_id,
  coalesce(final, CASE WHEN fails > 0 THEN 'failed' ELSE 'todo' END) AS state,
  CAST(counted AS INTEGER) AS failure_count, CAST(dispatches AS INTEGER) AS dispatches
FROM g"""


@query("work_state", WORK_STATE_SQL)
def q_work_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 batch fold: every dispatch result applied in order to its work item."""
    a = fx.fixture_attempts_unnumbered(spark, sf_dir)
    outcomes = queue.outcomes_from_attempts(a)
    return queue.work_state(outcomes, ["queue", "item_id"], ["sent_at", "attempt_id"])
