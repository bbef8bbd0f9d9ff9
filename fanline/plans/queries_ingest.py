"""Registered queries: JSON ingest and validation, catalog, names, durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline.functions.durations import duration_sql, parse_duration_ms
from fanline.plans import fixture as fx
from fanline import constants as C
from fanline.operators import dedup, matching, publish
from fanline.plans.oracle_sql import EV
from fanline.plans.queries import status_sql
from fanline.plans.registry import query
from fanline.sources import ingest
from fanline.sources.catalog import valid_name

UUID_SQL = "'00000000-0000-4000-8000-' || lpad(lower(hex(event_id)), 12, '0')"
PAYLOAD_SQL = """'{"event_type":"' || event_type || '","user_id":' || CAST(user_id AS VARCHAR)
  || ',"props":' || replace(props, ': ', ':') || '}'"""
ERRORS_SQL = """CASE WHEN k = 89 THEN 'obj.groupId: error.expected.jsstring'
  WHEN k BETWEEN 90 AND 93 THEN 'obj.eventId: error.path.missing'
  WHEN k BETWEEN 94 AND 95 THEN 'obj.eventId: error.expected.uuid'
  WHEN k BETWEEN 96 AND 97 THEN 'obj.timestamp: error.expected.date.isoformat'
  WHEN k = 98 THEN 'obj.subject: error.path.missing'
  WHEN k = 99 THEN 'obj.event: error.path.missing' ELSE '' END"""


def parsed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_bodies(fx.fixture_bodies(spark, sf_dir))


@query(
    "ingest_events",
    f"""WITH {EV}
SELECT {UUID_SQL} AS event_id, event_type AS subject, CAST(user_id AS VARCHAR) AS group_id, ts AS timestamp,
       {PAYLOAD_SQL} AS event
FROM ev WHERE k < 89""",
)
def q_ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON bodies -> typed events (valid ones)."""
    return ingest.valid_events(parsed_bodies(spark, sf_dir)).select(
        "event_id", "subject", "group_id", "timestamp", "event"
    )


@query(
    "validate_events",
    f"""WITH {EV}
SELECT event_id AS source_id, k < 89 AS is_valid, {ERRORS_SQL} AS errors FROM ev""",
)
def q_validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every body with all of its field errors."""
    p = parsed_bodies(spark, sf_dir)
    return p.select("source_id", (F.size("errors") == 0).alias("is_valid"), F.array_join("errors", ";").alias("errors"))


CATALOG_SQL = """cat(topic, subscriber, uri, http_method, elements, per_ms, max_connections, min_backoff_ms,
                    max_backoff_ms, max_retries, filter_path) AS (VALUES
  ('click', 'audit-all', 'http://localhost:9001/audit-all', 'POST', 60, 3000, 4, 100, 600000, 150, NULL),
  ('click', 'high-k', 'http://localhost:9001/high-k', 'POST', 60, 3000, 4, 100, 600000, 150, '$.event[?(@.props.k >= 50)]'),
  ('purchase', 'billing', 'http://localhost:9001/billing', 'POST', 60, 3000, 4, 100, 600000, 150, NULL),
  ('purchase', 'vip', 'http://localhost:9001/vip', 'PUT', 60, 3000, 4, 100, 600000, 150, '$.event[?(@.user_id < 20)]'),
  ('error', 'alerts', 'http://localhost:9001/alerts', 'POST', 60, 3000, 4, 100, 600000, 150, '$.event[?(@.event_type =~ /ERR.*/i)]'),
  ('error', 'pager', 'http://localhost:9001/pager', 'POST', 60, 3000, 4, 100, 600000, 150, '$.event[?(@.props.k >= 90 && @.event_type == ''error'')]'),
  ('view', 'sampler', 'http://localhost:9001/sampler', 'POST', 60, 3000, 4, 100, 600000, 150, '$.event[?(@.props.k < 10)]'),
  ('empty', NULL, NULL, 'POST', 60, 3000, 4, 100, 600000, 150, NULL))"""


@query(
    "subscription_catalog",
    f"""WITH {CATALOG_SQL}, n AS (SELECT event_type AS topic, count(*) AS n_events FROM events GROUP BY 1)
SELECT cat.topic, cat.subscriber, cat.uri, cat.http_method, cat.elements, CAST(cat.per_ms AS BIGINT) AS per_ms,
       cat.max_connections, CAST(cat.min_backoff_ms AS BIGINT) AS min_backoff_ms,
       CAST(cat.max_backoff_ms AS BIGINT) AS max_backoff_ms, cat.max_retries, cat.filter_path,
       '' AS errors, coalesce(n.n_events, 0) AS n_events
FROM cat LEFT JOIN n ON n.topic = cat.topic""",
)
def q_subscription_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + F5 + J5 + U1 + U2: the resolved catalog with the traffic on each topic."""
    cat = fx.fixture_catalog(spark)
    # only catalog topics are counted, so the counts are bounded by the catalog
    topics = fx.fixture_index(spark).topics
    ev = fx.fixture_events(spark, sf_dir).where(F.col("topic").isin(*topics))
    counts = ev.groupBy("topic").agg(F.count(F.lit(1)).alias("n_events"))
    out = cat.join(F.broadcast(counts), "topic", "left").withColumns(
        {"n_events": F.coalesce("n_events", F.lit(0)).cast("bigint"), "errors": F.array_join("errors", ";")}
    )
    return out.select(
        "topic", "subscriber", "uri", "http_method", "elements", "per_ms", "max_connections",
        "min_backoff_ms", "max_backoff_ms", "max_retries", "filter_path", "errors", "n_events",
    )


@query(
    "name_validation",
    """WITH names AS (
  SELECT DISTINCT event_type AS name, 'topic' AS kind FROM events
  UNION ALL SELECT DISTINCT 'q-' || event_type || '-' || CAST(user_id % 3 AS VARCHAR), 'subscriber' FROM events
  UNION ALL SELECT DISTINCT upper(event_type), 'subscriber' FROM events)
SELECT name, kind, regexp_full_match(name, '[0-9a-z-]+') AS valid FROM names""",
)
def q_name_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic names seen in the data and candidate subscriber names derived from it."""
    ev = fx.fixture_events(spark, sf_dir)
    names = (
        ev.select(F.col("topic").alias("name"), F.lit("topic").alias("kind")).distinct()
        .unionByName(
            ev.select(
                F.concat(F.lit("q-"), "topic", F.lit("-"), (F.col("group_id") % 3).cast("string")).alias("name"),
                F.lit("subscriber").alias("kind"),
            ).distinct()
        )
        .unionByName(ev.select(F.upper("topic").alias("name"), F.lit("subscriber").alias("kind")).distinct())
    )
    return names.withColumn("valid", valid_name(F.col("name")))


# --- fixed values: duration spellings cycled over the data -------------------
DURATION_SPELLINGS = ["ms", ".seconds", " minutes", "h", ".days", "us", " millis"]


@query(
    "parse_duration",
    f"""WITH {EV}, d AS (
  SELECT event_id, CAST(k AS VARCHAR) || CASE k % 7 {" ".join(f"WHEN {i} THEN '{u}'" for i, u in enumerate(DURATION_SPELLINGS))} END AS text
  FROM ev)
SELECT event_id, text, {duration_sql("text")} AS ms FROM d""",
)
def q_parse_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duration text -> milliseconds, over a text column derived from every event."""
    ev = fx.fixture_events(spark, sf_dir)
    k = fx.k_of(F.get_json_object("event", "$.event.props"))
    unit = F.element_at(F.array(*map(F.lit, DURATION_SPELLINGS)), (k % 7) + 1)
    d = ev.select("event_id", F.concat(k.cast("string"), unit).alias("text"))
    return d.withColumn("ms", parse_duration_ms(F.col("text")))


RESPONSE_SQL = f"""CASE status WHEN 'published' THEN '{{"publishedSubscribers":["' || replace(subscribers, ',', '","') || '"]}}'
    WHEN 'duplicate' THEN '{C.MSG_DUPLICATE}' WHEN 'no-subscribers' THEN '{C.MSG_NO_SUBSCRIBERS}'
    WHEN 'no-topic' THEN '{C.MSG_NO_TOPIC}' END"""

EV_VALID = EV.replace("ev AS (", "ev_all AS (", 1) + ",\n  ev AS (SELECT * FROM ev_all WHERE k < 89)"


@query(
    "publish_endpoint",
    f"""WITH RECURSIVE {status_sql(EV_VALID)},
  bad AS (SELECT event_id, {ERRORS_SQL} AS err FROM ev_all WHERE k >= 89)
SELECT event_id AS source_id, CASE WHEN status = 'no-topic' THEN 404 ELSE 201 END AS http_code,
       {RESPONSE_SQL} AS body
FROM status
UNION ALL
SELECT event_id, 400, '{{"Invalid Event payload: ":{{"' || split_part(err, ': ', 1) || '":[{{"msg":["'
       || split_part(err, ': ', 2) || '"],"args":[]}}]}}}}'
FROM bad""",
)
def q_publish_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publish endpoint end to end: body -> 400 with every error, or
    match on the whole envelope -> anchored dedup -> 201 / 404 response."""
    parsed = parsed_bodies(spark, sf_dir)
    bad = publish.invalid_response(ingest.invalid_events(parsed))
    good = ingest.valid_events(parsed).select(
        "source_id",
        F.col("subject").alias("topic"),  # the endpoint's topic: the subject here
        "event_id", "subject", "group_id", "timestamp",
        F.col("body").alias("event"),  # filters read the whole envelope
        F.col("timestamp").alias("received_at"),
    )
    m = matching.publishable(good, fx.fixture_index(spark))
    st = dedup.ttl_status(m, "group_id", fx.DEDUP_TTL_SECONDS, eligible=F.col("publishable"))
    status = (
        F.when(F.col("duplicate"), F.lit(C.ST_DUPLICATE))
        .when(~F.col("topic_known"), F.lit(C.ST_NO_TOPIC))
        .when(F.size("subscribers") == 0, F.lit(C.ST_NO_SUBSCRIBERS))
        .otherwise(F.lit(C.ST_PUBLISHED))
    )
    ok = publish.publish_response(st.withColumn("status", status))
    cols = ["source_id", "http_code", "body"]
    return ok.select(*cols).unionByName(bad.select(*cols))
