"""Match events to the subscriptions of their topic.

Plan shape. The catalog is configuration with a checked size. Up to
``MAX_INLINE_SUBSCRIPTIONS`` rows it is compiled into one ``CASE topic``
expression that yields, per event, the sorted array of matching subscriber
names; fan-out is then an ``explode``. Matching is a narrow projection: no
join, no shuffle, and each distinct filter path is evaluated at most once
per event, only for events of a topic that uses it. A hot topic costs
nothing extra because nothing is keyed on it.

Above that size subscriptions are data: their filters become predicate rows that
event values are joined with and counted (``fanline.operators.content_match``).
That form serves a catalog of any size, and no filter path comes to the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.jsonpath import CompiledPath, doc_schema, parse_path, parsed_predicate, path_predicate
from fanline.operators.content_match import ROW, PredicateIndex, matched_subscribers
from fanline.sources.catalog import MAX_INLINE_SUBSCRIPTIONS, topics_of, valid_subscriptions
from fanline.session import checkpoint_dir, stored


def queue_name(topic: Column, subscriber: Column) -> Column:
    """``{topic}_{subscriber}_queue``."""
    return F.concat(topic, F.lit("_"), subscriber, F.lit(C.QUEUE_SUFFIX))


@dataclass
class SubscriptionIndex:
    """The valid subscriptions of a catalog: held on the driver while they are few,
    else as predicate tables."""

    subs: list[tuple[str, str, str | None]]  # (topic, subscriber, filter_path), inline form only
    topics: list[str]
    paths: dict[str, CompiledPath]
    inline: bool
    known: DataFrame | None = None  # every known topic, those without subscribers too
    index: PredicateIndex | None = None

    @classmethod
    def build(cls, catalog: DataFrame, inline: bool | None = None) -> "SubscriptionIndex":
        """A catalog of at most ``MAX_INLINE_SUBSCRIPTIONS`` rows is collected and
        compiled into the plan; a larger one becomes predicate tables. Both forms
        give the same results; ``inline=False`` forces the second."""
        cap = MAX_INLINE_SUBSCRIPTIONS + 1
        rows = [] if inline is False else catalog.select("topic", "subscriber", "filter_path", "errors").limit(cap).collect()
        if inline is False or len(rows) == cap:
            known = stored(topics_of(catalog), "topics")
            return cls([], [], {}, False, known, PredicateIndex(valid_subscriptions(catalog)))
        usable = [r for r in rows if not r.errors]
        subs = sorted({(r.topic, r.subscriber, r.filter_path) for r in usable if r.subscriber is not None})
        topics = sorted({r.topic for r in rows if r.topic and re.fullmatch(C.NAME_PATTERN, r.topic)})
        return cls(subs, topics, {p: parse_path(p) for _, _, p in subs if p is not None}, True)

    # -- inline form ----------------------------------------------------------
    def parse_schema(self):
        """Schema for parsing each document once (None: no path can use it)."""
        return doc_schema(list(self.paths.values()))

    def predicate(self, p: str, doc: Column, parsed: Column | None) -> Column:
        cp = self.paths[p]
        schema, slow = self.parse_schema()
        if parsed is None or schema is None or p in slow:
            return path_predicate(cp, doc)
        return parsed_predicate(cp, parsed, doc)

    def subscribers_col(self, topic: Column, doc: Column, parsed: Column | None = None) -> Column:
        """Sorted array of matching subscriber names (empty when none)."""
        by_topic: dict[str, list[tuple[str, str | None]]] = {}
        for t, s, p in self.subs:
            by_topic.setdefault(t, []).append((s, p))
        expr = None
        for t, members in sorted(by_topic.items()):
            flags = {p: self.predicate(p, doc, parsed) for p in {p for _, p in members if p}}
            elems = [F.lit(s) if p is None else F.when(flags[p], F.lit(s)) for s, p in members]
            arr = F.array_compact(F.array(*elems)) if any(p for _, p in members) else F.array(*elems)
            expr = F.when(topic == t, arr) if expr is None else expr.when(topic == t, arr)
        empty = F.array().cast("array<string>")
        return F.array_sort(expr.otherwise(empty)) if expr is not None else empty

    def topic_known_col(self, topic: Column) -> Column:
        return F.coalesce(topic.isin(*self.topics), F.lit(False)) if self.topics else F.lit(False)


PARSED = "_doc"


def _with_parsed(events: DataFrame, index: SubscriptionIndex, doc_col: str) -> tuple[DataFrame, Column | None]:
    """Parse each document once into the struct the filters read (kept as its
    own projection, so the parse is not repeated per filter)."""
    schema, _ = index.parse_schema()
    if schema is None:
        return events, None
    # only events of topics with a filtered subscription are parsed at all
    filtered = sorted({t for t, _, p in index.subs if p is not None})
    parsed = F.when(F.col("topic").isin(*filtered), F.from_json(F.col(doc_col), schema))
    return events.withColumn(PARSED, parsed), F.col(PARSED)


def match_subscribers(events: DataFrame, index: SubscriptionIndex, doc_col: str = "event") -> DataFrame:
    """Adds ``topic_known`` and ``subscribers`` (sorted array) to every event."""
    if index.inline:
        ev, parsed = _with_parsed(events, index, doc_col)
        out = ev.withColumns(
            {
                "topic_known": index.topic_known_col(F.col("topic")),
                "subscribers": index.subscribers_col(F.col("topic"), F.col(doc_col), parsed),
            }
        )
        return out.drop(PARSED)
    rows = _numbered(events)
    fanned = matched_subscribers(rows.select(ROW, "topic", doc_col), index.index, doc_col)
    per_row = fanned.groupBy(ROW).agg(F.array_sort(F.collect_set("subscriber")).alias("subscribers"))
    topics = index.known.withColumn("topic_known", F.lit(True))
    return (
        rows.join(topics, "topic", "left")
        .join(per_row, ROW, "left")
        .withColumns(
            {
                "topic_known": F.coalesce("topic_known", F.lit(False)),
                "subscribers": F.coalesce("subscribers", F.array().cast("array<string>")),
            }
        )
        .select(*events.columns, "topic_known", "subscribers")
    )


def _numbered(events: DataFrame) -> DataFrame:
    """``events`` with a number of each row's own, not its id: ids repeat. It depends
    on the partition and the place in it, and both sides of a join read the same
    rows, written once."""
    return stored(events.withColumn(ROW, F.monotonically_increasing_id()), "events")


def fan_out(events: DataFrame, index: SubscriptionIndex, doc_col: str = "event") -> DataFrame:
    """One row per (event, matching subscriber), with its queue name."""
    if index.inline:
        ev, parsed = _with_parsed(events, index, doc_col)
        subs = index.subscribers_col(F.col("topic"), F.col(doc_col), parsed)
        out = ev.withColumn("subscriber", F.explode(subs)).drop(PARSED)
    else:
        rows = _numbered(events)
        out = rows.join(matched_subscribers(rows.select(ROW, "topic", doc_col), index.index, doc_col), ROW).drop(ROW)
    return out.withColumn("queue", queue_name(F.col("topic"), F.col("subscriber")))


def publishable(events: DataFrame, index: SubscriptionIndex, doc_col: str = "event") -> DataFrame:
    """Adds ``publishable`` = known topic with at least one matching subscriber."""
    m = match_subscribers(events, index, doc_col)
    return m.withColumn("publishable", F.col("topic_known") & (F.size("subscribers") > 0))
