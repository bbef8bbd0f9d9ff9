"""Typed content matching: a truth table of JSON types against filters, by both forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline.operators.matching import SubscriptionIndex, match_subscribers
from fanline.plans.registry import query
from fanline.sources.catalog import catalog_from_nested, load_subscriptions
from fanline.sources.tables import read_table

# --- fixed values: one payload per JSON type, by k % 12; and for each filter the
# payloads that it selects, written by hand
PAYLOADS = [
    '{"v":60}', '{"v":"60"}', '{"v":60.0}', '{"v":"60.0"}', '{"v":true}', '{"v":"true"}', '{"v":null}',
    '{"v":[60]}', '{"v":{"x":60}}', '{}', '{"v":1.5e2}', '{"v":"north..7"}',
]
TRUTH = {
    "at-least": ("$.event[?(@.v >= 50)]", [0, 2, 10]),
    "at-least-text": ("$.event[?(@.v >= '50')]", [1, 3, 5, 11]),
    "below-flipped": ("$.event[?(100 > @.v)]", [0, 2]),
    "equal": ("$.event[?(@.v == 60)]", [0, 1, 2]),
    "equal-text": ("$.event[?(@.v == '60.0')]", [0, 2, 3]),
    "is-true": ("$.event[?(@.v == true)]", [4]),
    "is-null": ("$.event[?(@.v == null)]", [6]),
    "not-null": ("$.event[?(@.v != null)]", [0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11]),
    "present": ("$.event[?(@.v)]", [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11]),
    "absent": ("$.event[?(!(@.v))]", [9]),
    "one-of": ("$.event[?(@.v in [null, true, 150])]", [4, 6, 10]),
    "none-of": ("$.event[?(@.v nin [60, true])]", [3, 5, 6, 7, 8, 9, 10, 11]),
    "digits": ("$.event[?(@.v =~ /[0-9.]+/)]", [0, 1, 2, 3, 7, 10]),
    "dots": ("$.event[?(@.v =~ /NORTH..7/i)]", [11]),
    "any-text": ("$.event[?(@.v =~ /.*/)]", [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]),
    "one-inside": ("$.event[?(@.v size 1)]", [7, 8]),
    "holds": ("$.event[?(@.v contains 60)]", [7]),
    "between": ("$.event[?(@.v >= 50 && @.v < 100)]", [0, 2]),
    "mixed": ("$.event[?((@.v == true || @.v == 'north..7') && !(@.v == null))]", [4, 11]),
    "element": ("$.event.v[?(@ == 60)]", [7]),
    "child": ("$.event.v[*]", [7, 8]),
    "all": (None, [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]),
}
TOPICS = ("click", "view")

_SQL = """WITH truth(subscriber, c) AS (VALUES {rows}),
  ev AS (SELECT event_id, event_type AS topic, CAST(json_extract_string(props, '$.k') AS INTEGER) % 12 AS c FROM events)
SELECT event_id, topic IN ('click', 'view') AS topic_known,
  CASE WHEN topic IN ('click', 'view')
    THEN (SELECT string_agg(subscriber, ',' ORDER BY subscriber) FROM truth t WHERE t.c = ev.c) ELSE '' END AS subscribers
FROM ev""".format(rows=", ".join(f"('{s}', {c})" for s, (_, cases) in TRUTH.items() for c in cases))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with a payload of the JSON type that k % 12 names."""
    k = F.get_json_object("props", "$.k").cast("int")
    payload = F.element_at(F.array(*map(F.lit, PAYLOADS)), k % len(PAYLOADS) + 1)
    return read_table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("topic"), F.concat(F.lit('{"event":'), payload, F.lit("}")).alias("event")
    )


def _matched(spark: SparkSession, sf_dir: str, inline: bool) -> DataFrame:
    subs = {s: {"uri": f"http://localhost:9001/{s}", **({"filter-path": p} if p else {})} for s, (p, _) in TRUTH.items()}
    catalog = load_subscriptions(catalog_from_nested(spark, {t: subs for t in TOPICS}))
    m = match_subscribers(typed_events(spark, sf_dir), SubscriptionIndex.build(catalog, inline=None if inline else False))
    return m.select("event_id", "topic_known", F.array_join("subscribers", ",").alias("subscribers"))


@query("match_typed", _SQL)
def q_match_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which JSON type meets which filter, compiled into the plan."""
    return _matched(spark, sf_dir, inline=True)


@query("match_typed_joined", _SQL)
def q_match_typed_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with subscriptions as data: predicates joined and counted."""
    return _matched(spark, sf_dir, inline=False)
