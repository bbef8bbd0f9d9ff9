"""Shared DuckDB SQL fragments for the oracle queries.

These are written independently of the Spark code: the subscription filters
are hand-translated SQL predicates, the dedup is a recursive CTE.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, event_type, user_id, event_type AS topic, event_type AS subject, user_id AS group_id,
         ts, ts AS received_at, value, props,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         '{"event":{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR)
           || ',"props":' || props || '}}' AS event
  FROM events)"""

SUBS = """subs(topic, subscriber, uri, http_method, filter_path) AS (VALUES
  ('click', 'audit-all', 'http://localhost:9001/audit-all', 'POST', NULL),
  ('click', 'high-k', 'http://localhost:9001/high-k', 'POST', '$.event[?(@.props.k >= 50)]'),
  ('purchase', 'billing', 'http://localhost:9001/billing', 'POST', NULL),
  ('purchase', 'vip', 'http://localhost:9001/vip', 'PUT', '$.event[?(@.user_id < 20)]'),
  ('error', 'alerts', 'http://localhost:9001/alerts', 'POST', '$.event[?(@.event_type =~ /ERR.*/i)]'),
  ('error', 'pager', 'http://localhost:9001/pager', 'POST', '$.event[?(@.props.k >= 90 && @.event_type == ''error'')]'),
  ('view', 'sampler', 'http://localhost:9001/sampler', 'POST', '$.event[?(@.props.k < 10)]'))"""

TOPICS = """topics(topic) AS (VALUES ('click'), ('purchase'), ('error'), ('view'), ('empty'))"""

# The subscription filters, hand-written as SQL over ev / subs.
PRED = """CASE s.subscriber
    WHEN 'high-k' THEN ev.k >= 50
    WHEN 'vip' THEN ev.group_id < 20
    WHEN 'alerts' THEN regexp_full_match(ev.topic, 'ERR.*', 'i')
    WHEN 'pager' THEN ev.k >= 90 AND ev.topic = 'error'
    WHEN 'sampler' THEN ev.k < 10
    ELSE TRUE END"""

FANNED = f"""fanned AS (
  SELECT ev.*, s.subscriber, s.uri, s.http_method, s.topic || '_' || s.subscriber || '_queue' AS queue
  FROM ev JOIN subs s ON ev.topic = s.topic WHERE {PRED})"""

MATCHED = """matched AS (
  SELECT ev.*, t.topic IS NOT NULL AS topic_known,
         coalesce((SELECT count(*) FROM fanned f WHERE f.event_id = ev.event_id), 0) AS n_subs,
         coalesce((SELECT string_agg(f.subscriber, ',' ORDER BY f.subscriber) FROM fanned f
                   WHERE f.event_id = ev.event_id), '') AS subscribers
  FROM ev LEFT JOIN topics t ON ev.topic = t.topic)"""

# Anchored TTL dedup over publishable rows: next pointers + recursive chain.
def dedup_chain(source: str, key: str, ttl: str = "INTERVAL 24 HOUR") -> str:
    return f"""pub AS (SELECT event_id, {key} AS dkey, ts FROM {source}),
  nxt AS (
    SELECT p.event_id, (SELECT q.event_id FROM pub q WHERE q.dkey = p.dkey AND q.ts >= p.ts + {ttl}
                        ORDER BY q.ts, q.event_id LIMIT 1) AS next_id
    FROM pub p),
  heads AS (SELECT arg_min(event_id, (ts, event_id)) AS event_id FROM pub GROUP BY dkey),
  chain AS (
    SELECT event_id FROM heads
    UNION ALL
    SELECT n.next_id FROM chain c JOIN nxt n ON n.event_id = c.event_id WHERE n.next_id IS NOT NULL),
  anchors AS (SELECT p.* FROM pub p WHERE p.event_id IN (SELECT event_id FROM chain))"""

ATT = """att0 AS (
  SELECT event_type || '_main_queue' AS queue, 'main' AS subscriber, user_id AS item_id, event_id AS attempt_id,
    ts AS sent_at, CAST(floor(value * 10) AS BIGINT) AS latency_ms,
    CASE WHEN k BETWEEN 0 AND 59 THEN 200 WHEN k BETWEEN 60 AND 69 THEN 503 WHEN k BETWEEN 70 AND 77 THEN 429
         WHEN k BETWEEN 78 AND 85 THEN 400 WHEN k BETWEEN 86 AND 91 THEN 301 END AS status_code,
    CASE WHEN k BETWEEN 92 AND 94 THEN 'RequestTimeoutException' WHEN k BETWEEN 95 AND 96 THEN 'RuntimeException'
         WHEN k BETWEEN 97 AND 99 THEN 'IllegalStateException' END AS error_class,
    CASE WHEN k BETWEEN 95 AND 96 THEN 'The http server closed the connection unexpectedly'
         WHEN k BETWEEN 97 AND 99 THEN 'boom' END AS error_message
  FROM ev),
  att AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY queue, item_id ORDER BY sent_at, attempt_id) AS INTEGER) AS attempt_no,
      CASE WHEN status_code IS NOT NULL THEN (status_code BETWEEN 500 AND 599 OR status_code = 429)
           ELSE coalesce(error_class = 'RequestTimeoutException'
                         OR contains(error_message, 'The http server closed the connection unexpectedly'), FALSE)
      END AS retryable,
      CASE WHEN status_code IS NULL THEN 'Failed' WHEN status_code BETWEEN 200 AND 299 THEN 'Sent'
           WHEN status_code = 429 THEN 'Failed' WHEN status_code BETWEEN 500 AND 599 THEN 'Failed'
           ELSE 'Removed' END AS outcome
    FROM att0)"""


def chain_sql(max_retries: int) -> str:
    return f"""chain AS (
    SELECT * FROM (
      SELECT att.*, coalesce(min(CAST(retryable AS INTEGER)) OVER (PARTITION BY queue, item_id ORDER BY attempt_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS prior_ok
      FROM att WHERE attempt_no <= {max_retries} + 1) WHERE prior_ok = 1)"""


QUEUE = """q AS (
  SELECT event_type || '_main_queue' AS queue, event_id AS id, ts AS received_at, ts AS updated_at,
    ts + k * INTERVAL 1 MINUTE AS available_at,
    CASE k % 4 WHEN 0 THEN 'todo' WHEN 1 THEN 'failed' WHEN 2 THEN 'in-progress' ELSE 'permanently-failed' END AS status,
    CAST(k % 6 AS INTEGER) AS failure_count, event AS item, k
  FROM ev)"""

AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"

DUE = f"""((status = 'todo' AND available_at < {AS_OF})
   OR (status = 'failed' AND updated_at < {AS_OF} - INTERVAL 1 HOUR AND available_at < {AS_OF})
   OR (status = 'in-progress' AND updated_at < {AS_OF} - INTERVAL 24 HOUR))"""
