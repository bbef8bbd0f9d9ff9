"""Queries on input that the plain fixture lacks: repeated, NULL and large ids,
a topic without subscribers, and the joined form of the matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline.operators import dedup, matching
from fanline.plans import fixture as fx
from fanline.plans.oracle_sql import EV, FANNED, MATCHED, SUBS, TOPICS, dedup_chain
from fanline.plans.registry import query

#: every eleventh id is NULL, the others repeat and lie above 2**53
REPEATED_SQL = "CASE WHEN event_id % 11 <> 0 THEN 9007199254740992 + event_id % 97 END"


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's events with ids that repeat, and a tenth of them in the topic
    that has no subscriber."""
    ev = fx.fixture_events(spark, sf_dir)
    topic = F.when(F.col("group_id") % 10 == 0, F.lit("empty")).otherwise(F.col("topic"))
    return ev.withColumns({"event_id": F.expr(REPEATED_SQL), "topic": topic})


EV_EMPTY = EV.replace("ev AS", "ev0 AS", 1) + """,
  ev AS (SELECT * REPLACE (CASE WHEN user_id % 10 = 0 THEN 'empty' ELSE topic END AS topic) FROM ev0)"""

_MATCH_SQL = f"""WITH {EV_EMPTY}, {SUBS}, {TOPICS}, {FANNED}, {MATCHED}
SELECT {REPEATED_SQL} AS event_id, received_at, topic, topic_known, subscribers FROM matched"""


def _matched(spark: SparkSession, sf_dir: str, inline: bool) -> DataFrame:
    index = matching.SubscriptionIndex.build(fx.fixture_catalog(spark), inline=inline)
    m = matching.match_subscribers(repeated_ids(spark, sf_dir), index)
    return m.select(
        "event_id", "received_at", "topic", "topic_known", F.array_join("subscribers", ",").alias("subscribers")
    )


@query("match_repeated_ids", _MATCH_SQL)
def q_match_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's own subscribers, the catalog compiled into the plan."""
    return _matched(spark, sf_dir, inline=True)


@query("match_repeated_ids_joined", _MATCH_SQL)
def q_match_repeated_ids_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the form for large catalogs, which joins them."""
    return _matched(spark, sf_dir, inline=False)


_DEDUP_SQL = f"""WITH RECURSIVE {EV},
  {dedup_chain("ev", f"coalesce({REPEATED_SQL}, -1)")},
  st AS (
    SELECT ev.event_id AS id, ts, coalesce({REPEATED_SQL}, -1) AS dkey, a.anchor IS NOT NULL AS accepted
    FROM ev LEFT JOIN (SELECT event_id AS anchor FROM anchors) a ON a.anchor = ev.event_id),
  seen AS (
    SELECT st.*, (SELECT max(x.ts) FROM anchors x WHERE x.dkey = st.dkey
       AND (x.ts < st.ts OR (x.ts = st.ts AND x.event_id < st.id))) AS last_anchor FROM st)
SELECT nullif(dkey, -1) AS event_id, ts AS received_at, accepted,
  NOT accepted AND last_anchor IS NOT NULL AND ts < last_anchor + INTERVAL 24 HOUR AS duplicate
FROM seen"""


def _dedup(spark: SparkSession, sf_dir: str, threshold: int) -> DataFrame:
    ev = repeated_ids(spark, sf_dir).select("event_id", "received_at")
    st = dedup.ttl_status(ev, "event_id", fx.DEDUP_TTL_SECONDS, hot_threshold=threshold)
    return st.select("event_id", "received_at", "accepted", "duplicate")


@query("dedup_repeated_ids", _DEDUP_SQL)
def q_dedup_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on ids that repeat and serve as their own tiebreak: one fold per key."""
    return _dedup(spark, sf_dir, 2_000_000)


@query("dedup_repeated_ids_hot", _DEDUP_SQL)
def q_dedup_repeated_ids_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every key taken as hot: range slices and their transfer functions."""
    return _dedup(spark, sf_dir, 3)
