"""Registered queries over the driver tables, each with its DuckDB oracle.

Every builder reads the whole ``events`` table (or data Spark derives from
it) so its work grows with the table. Output columns are aliased to the
same names as in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.operators import dedup, matching
from fanline.plans import fixture as fx
from fanline.plans.oracle_sql import EV, FANNED, MATCHED, PRED, SUBS, TOPICS, dedup_chain
from fanline.plans.registry import query
from fanline.sources.catalog import valid_subscriptions


def _index(spark: SparkSession) -> matching.SubscriptionIndex:
    return fx.fixture_index(spark)


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.publishable(fx.fixture_events(spark, sf_dir), _index(spark))


STATUS_KEYS = ["event_id", "group_id", "received_at", "topic_known", "subscribers", "publishable"]


def publish_status_df(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Status of every event: duplicate > no-topic > no-subscribers > published.

    ``keep`` names the event columns needed downstream; the TTL fold runs in
    Python (``mapInPandas``), where Catalyst cannot prune columns, so only
    these travel through it (default: all).
    """
    m = _matched(spark, sf_dir)
    if keep is not None:
        m = m.select(*dict.fromkeys(STATUS_KEYS + keep))
    st = dedup.ttl_status(m, "group_id", fx.DEDUP_TTL_SECONDS, eligible=F.col("publishable"))
    status = (
        F.when(F.col("duplicate"), F.lit(C.ST_DUPLICATE))
        .when(~F.col("topic_known"), F.lit(C.ST_NO_TOPIC))
        .when(F.size("subscribers") == 0, F.lit(C.ST_NO_SUBSCRIBERS))
        .otherwise(F.lit(C.ST_PUBLISHED))
    )
    return st.withColumn("status", status)


# ---------------------------------------------------------------------------
# Matching and fan-out


@query(
    "fan_out",
    f"""WITH {EV}, {SUBS}
SELECT ev.event_id, s.topic, s.subscriber, s.topic || '_' || s.subscriber || '_queue' AS queue
FROM ev JOIN subs s ON ev.topic = s.topic WHERE {PRED}""",
)
def q_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = matching.fan_out(fx.fixture_events(spark, sf_dir), _index(spark))
    return out.select("event_id", "topic", "subscriber", "queue")


@query(
    "path_filter",
    f"""WITH {EV}, {SUBS}
SELECT ev.event_id, s.subscriber, ({PRED}) AS matched
FROM ev JOIN subs s ON ev.topic = s.topic WHERE s.filter_path IS NOT NULL""",
)
def q_path_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every (event, filtered subscription of its topic) with the path verdict."""
    from fanline.functions.jsonpath import path_predicate

    subs = valid_subscriptions(fx.fixture_catalog(spark)).where(F.col("filter_path").isNotNull())
    ev = fx.fixture_events(spark, sf_dir)
    paths = [r.filter_path for r in subs.select("filter_path").distinct().collect()]
    verdict = F.lit(False)
    for p in paths:
        verdict = F.when(F.col("filter_path") == p, path_predicate(p, F.col("event"))).otherwise(verdict)
    return ev.join(F.broadcast(subs.select("topic", "subscriber", "filter_path")), "topic").select(
        "event_id", "subscriber", verdict.alias("matched")
    )


@query(
    "path_regex",
    f"""WITH {EV}
SELECT event_id, regexp_full_match(topic, 'ERR.*', 'i') AS matched FROM ev""",
)
def q_path_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the case-insensitive whole-string regex filter on every event."""
    from fanline.functions.jsonpath import path_predicate

    ev = fx.fixture_events(spark, sf_dir)
    pred = path_predicate("$.event[?(@.event_type =~ /ERR.*/i)]", F.col("event"))
    return ev.select("event_id", pred.alias("matched"))


@query(
    "published_subscribers",
    f"""WITH {EV}, {SUBS}, {TOPICS}, {FANNED}, {MATCHED}
SELECT event_id, subscribers FROM matched""",
)
def q_published_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the sorted subscriber set of every event, as comma-joined text."""
    m = _matched(spark, sf_dir)
    return m.select("event_id", F.array_join("subscribers", ",").alias("subscribers"))


# ---------------------------------------------------------------------------
# Dedup and publish status


@query(
    "dedup_ttl",
    f"""WITH RECURSIVE {EV}, {dedup_chain('ev', 'group_id')}
SELECT a.event_id, a.dkey AS group_id, a.ts AS received_at FROM anchors a""",
)
def q_dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 alone: anchored 24 h dedup on group_id over every event."""
    ev = fx.fixture_events(spark, sf_dir)
    return dedup.dedup_ttl(ev, "group_id", fx.DEDUP_TTL_SECONDS).select("event_id", "group_id", "received_at")


@query(
    "first_per_key",
    f"""WITH {EV}
SELECT group_id, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS received_at
FROM ev GROUP BY group_id""",
)
def q_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event per key."""
    ev = fx.fixture_events(spark, sf_dir)
    return dedup.first_per_key(ev, "group_id").select("group_id", "event_id", "received_at")


def status_sql(ev_cte: str = EV) -> str:
    """Publish status over the events of ``ev_cte`` (a CTE named ``ev``)."""
    return f"""{ev_cte}, {SUBS}, {TOPICS}, {FANNED}, {MATCHED},
  {dedup_chain("(SELECT * FROM matched WHERE topic_known AND n_subs > 0)", "group_id")},
  st AS (
    SELECT m.*, a.event_id IS NOT NULL AS accepted,
      (SELECT max(x.ts) FROM anchors x WHERE x.dkey = m.group_id
         AND (x.ts < m.ts OR (x.ts = m.ts AND x.event_id < m.event_id))) AS last_anchor
    FROM matched m LEFT JOIN anchors a ON a.event_id = m.event_id),
  status AS (
    SELECT st.*, CASE
      WHEN NOT accepted AND last_anchor IS NOT NULL AND ts < last_anchor + INTERVAL 24 HOUR THEN 'duplicate'
      WHEN NOT topic_known THEN 'no-topic'
      WHEN n_subs = 0 THEN 'no-subscribers'
      ELSE 'published' END AS status
    FROM st)"""


PUBLISH_STATUS_SQL = f"""{EV}, {SUBS}, {TOPICS}, {FANNED}, {MATCHED},
  {dedup_chain("(SELECT * FROM matched WHERE topic_known AND n_subs > 0)", "group_id")},
  st AS (
    SELECT m.*, a.event_id IS NOT NULL AS accepted,
      (SELECT max(x.ts) FROM anchors x WHERE x.dkey = m.group_id
         AND (x.ts < m.ts OR (x.ts = m.ts AND x.event_id < m.event_id))) AS last_anchor
    FROM matched m LEFT JOIN anchors a ON a.event_id = m.event_id),
  status AS (
    SELECT st.*, CASE
      WHEN NOT accepted AND last_anchor IS NOT NULL AND ts < last_anchor + INTERVAL 24 HOUR THEN 'duplicate'
      WHEN NOT topic_known THEN 'no-topic'
      WHEN n_subs = 0 THEN 'no-subscribers'
      ELSE 'published' END AS status
    FROM st)"""


@query("publish_status", f"WITH RECURSIVE {PUBLISH_STATUS_SQL}\nSELECT event_id, status FROM status")
def q_publish_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_status_df(spark, sf_dir, keep=[]).select("event_id", "status")
