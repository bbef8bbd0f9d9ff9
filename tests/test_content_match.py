"""Counting satisfied predicates equals evaluating every filter on every event."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fanline.functions.jsonpath import JsonPathError, path_predicate
from fanline.operators.content_match import clauses_of, path_errors
from fanline.operators.matching import SubscriptionIndex, fan_out, match_subscribers
from fanline.sources.catalog import catalog_from_nested, load_subscriptions
from test_jsonpath_random import rand_doc, rand_pred

ODD = [
    None, "", "not json", "[]", "[1]", "3", '{"event":null}', '{"event":[]}', '{"event":[1,{"a":1},[{"a":1}]]}',
    '{"event":{"list":[{"tags":["a","b"]},{"tags":[]}],"Kind":1,"kind":2}}', '{"event":{"list":{"x":{"tags":["b"]}}}}',
    '{"event":{"a b":"z","big":12345678901234567890,"neg":-0.0}}',
]
EXTRA = [
    "$.event.list[*][?(@.tags anyof ['b'])]", "$.event.list[*].tags[*]", "$.event.list[?(@.tags empty true)]", "$[?(@.event)]",
    "$.event[?(@['a b'] == 'z')]", "$.event[?(@.Kind == 1 && @.kind == 2)]", "$.event[?(@.neg == 0)]", "$.event[?(@.big > 5)]",
    "$.event[?(!(@.a == 1) && !(@.b == 2))]", "$.event[?(@.a)]", "$.event[*]", "$.event[?(@.list size 2 || @.a subsetof [1, 2])]",
    "$.event[?(@.a noneof [1])]", "$.event[?(!(@.a =~ /.*/))]", "$.event[?(@ == 1)]",
]


def catalog(spark, filters, topic="t"):
    subs = {f"s{k}": {"uri": "http://localhost/x", **({"filter-path": p} if p else {})} for k, p in enumerate(filters)}
    return load_subscriptions(catalog_from_nested(spark, {topic: subs, "none": ""}))


def test_counting_equals_evaluating(spark):
    rnd = random.Random(77)
    docs = [rand_doc(rnd) for _ in range(150)] + ODD
    filters = [None, *EXTRA, *(f"$.event[?({rand_pred(rnd)})]" for _ in range(45))]
    events = spark.createDataFrame([("t", d, 7) for d in docs] + [("none", docs[0], 7), ("other", docs[0], 7), (None, docs[0], 7)], "topic string, event string, event_id long")
    got = match_subscribers(events, SubscriptionIndex.build(catalog(spark, filters), inline=False))
    assert got.columns == ["topic", "event", "event_id", "topic_known", "subscribers"]
    want = events.select(
        "topic", "event",
        *[(F.lit(True) if p is None else path_predicate(p, F.col("event"))).alias(f"s{k}") for k, p in enumerate(filters)],
    ).collect()
    expect = sorted(
        (str(r.topic), str(r.event), sorted(f"s{k}" for k in range(len(filters)) if r[f"s{k}"] and r.topic == "t")) for r in want
    )
    rows = got.collect()
    assert sorted((str(r.topic), str(r.event), list(r.subscribers)) for r in rows) == expect
    assert {r.topic: r.topic_known for r in rows} == {"t": True, "none": True, "other": False, None: False}
    assert sum(len(x[2]) for x in expect) > 1000


def test_fan_out_gives_one_row_per_match(spark):
    index = SubscriptionIndex.build(catalog(spark, [None, "$.event[?(@.a == 1 || @.a < 5)]"]), inline=False)
    events = spark.createDataFrame([("t", '{"event":[{"a":1},{"a":1}]}', 1), ("t", '{"event":{"a":9}}', 1)], "topic string, event string, event_id long")
    rows = fan_out(events, index).collect()
    assert sorted((r.event, r.subscriber, r.queue) for r in rows) == [
        ('{"event":[{"a":1},{"a":1}]}', "s0", "t_s0_queue"), ('{"event":[{"a":1},{"a":1}]}', "s1", "t_s1_queue"),
        ('{"event":{"a":9}}', "s0", "t_s0_queue"),
    ]


def test_a_large_catalog_takes_the_same_form(spark):
    """Twenty thousand subscriptions: values meet only the predicates they touch."""
    n = 20_000
    raw = spark.range(n).select(
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("topic"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("subscriber"),
        F.lit("ok").alias("uri"), *[F.lit(None).cast("string").alias(x) for x in ("http_method", "elements", "per", "max_connections", "min_back_off", "max_back_off", "max_retries")],
        F.concat(F.lit("$.event[?(@.user == "), (F.col("id") % 500).cast("string"), F.lit(" && @.k >= "), (F.col("id") % 7).cast("string"), F.lit(")]")).alias("filter_path"),
    )
    index = SubscriptionIndex.build(load_subscriptions(raw))
    assert not index.inline and not index.paths
    docs = [(f"t{u % 4}", json.dumps({"event": {"user": u, "k": u % 9}})) for u in range(0, 600, 7)]
    got = match_subscribers(spark.createDataFrame(docs, "topic string, event string"), index).collect()
    for r in got:
        e, t = json.loads(r.event)["event"], int(r.topic[1:])
        want = sorted(f"s{i}" for i in range(n) if i % 3 == t and i % 500 == e["user"] and e["k"] >= i % 7) if t < 3 else []
        assert list(r.subscribers) == want
    assert sum(len(r.subscribers) for r in got) > 300


def test_brackets_multiply_out_and_are_bounded(spark):
    assert len(clauses_of("$.e[?((@.a == 1 || @.b == 2) && (@.c == 3 || !(@.d == 4 && @.e == 5)))]")) == 6
    wide = " && ".join(f"(@.a{k} == 1 || @.b{k} == 1)" for k in range(11))
    with pytest.raises(JsonPathError):
        clauses_of(f"$.e[?({wide})]")
    df = spark.createDataFrame([("$.e[?(@.a)]",), ("$.e",), (None,), (f"$.e[?({wide})]",)], "p string")
    errors = [r[0] for r in df.select(path_errors(F.col("p"))).collect()]
    assert [e is None for e in errors] == [True, False, True, False]


def test_an_empty_catalog_matches_nothing(spark):
    index = SubscriptionIndex.build(catalog(spark, []), inline=False)
    events = spark.createDataFrame([("t", '{"event":{}}')], "topic string, event string")
    assert [tuple(r) for r in match_subscribers(events, index).select("topic_known", "subscribers").collect()] == [(False, [])]
