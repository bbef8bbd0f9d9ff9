from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.durations import parse_duration_ms
from fanline.sources.catalog import catalog_from_nested, load_subscriptions, valid_name, valid_subscriptions


def rows(df):
    return {r.subscriber: r for r in df.collect()}


def test_only_uri_given_defaults_everything(spark):
    cat = load_subscriptions(catalog_from_nested(spark, {"tides": {"gauge-9": {"uri": "http://x"}}}))
    r = rows(cat)["gauge-9"]
    assert (r.http_method, r.elements, r.per_ms, r.max_connections) == ("POST", 60, 3000, 4)
    assert (r.min_backoff_ms, r.max_backoff_ms, r.max_retries, r.filter_path) == (100, 600000, 150, None)
    assert r.errors == []


def test_put_method_and_case_insensitive(spark):
    cat = load_subscriptions(
        catalog_from_nested(spark, {"tides": {"a": {"uri": "u", "http-method": "put"}, "b": {"uri": "u", "http-method": "GET"}}})
    )
    got = rows(cat)
    assert got["a"].http_method == "PUT" and got["a"].errors == []
    assert got["b"].errors == ["at 'tides.b.http-method': expected one of [POST, PUT], but got: GET."]


def test_every_bad_field_of_a_row_is_reported(spark):
    raw = catalog_from_nested(spark, {"tides": {"gauge-9": {"max-retries": "many", "elements": "1.5", "min-back-off": "soon"}}})
    errs = sorted(rows(load_subscriptions(raw))["gauge-9"].errors)
    assert errs == [
        "at 'tides.gauge-9.elements': Expected type NUMBER. Found STRING instead.",
        "at 'tides.gauge-9.max-retries': Expected type NUMBER. Found STRING instead.",
        "at 'tides.gauge-9.min-back-off': Cannot convert 'soon' to Duration",
        "at 'tides.gauge-9.uri': Unknown key.",
    ]


def test_bad_names_and_empty_topic(spark):
    raw = catalog_from_nested(
        spark, {"EMAIL": {"a": {"uri": "u"}}, "0-1-2-3": {"FOO": {"uri": "u"}, "ok": {"uri": "u"}}, "empty": ""}
    )
    cat = load_subscriptions(raw)
    errs = {(r.topic, r.subscriber): r.errors for r in cat.collect()}
    assert errs[("EMAIL", "a")] == ["Invalid topic name: EMAIL"]
    assert errs[("0-1-2-3", "FOO")] == ["Invalid subscriber name: FOO"]
    assert errs[("0-1-2-3", "ok")] == [] and errs[("empty", None)] == []
    assert {r.subscriber for r in valid_subscriptions(cat).collect()} == {"ok"}


def test_bad_filter_path_is_an_error(spark):
    cat = load_subscriptions(catalog_from_nested(spark, {"t": {"s": {"uri": "u", "filter-path": "$.event.a"}}}))
    (err,) = rows(cat)["s"].errors
    assert err.startswith("at 't.s.filter-path': a definite path never yields an array")


def test_name_pattern(spark):
    names = ["abc", "a-1", "0-1-2-3", "Abc", "~~~", "+*&", "", "a_b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(valid_name(F.col("n"))).collect()]
    assert got == [True, True, True, False, False, False, False, False]


def test_parse_duration(spark):
    texts = ["3.seconds", "100.millis", "10 minutes", "24 hours", "1d", "250", "5us", "2.5s", "bar", "3 fortnights"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_duration_ms(F.col("t"))).collect()]
    assert got == [3000, 100, 600000, 86400000, 86400000, 250, 0, 2500, None, None]
    assert C.DEFAULT_PER_MS == 3000


def test_body_validation_reports_every_error(spark):
    from fanline.sources.ingest import parse_bodies

    uid = "2b7e1516-28ae-4d2a-9f1b-6a3c8e5d4f00"
    bodies = [
        f'{{"eventId":"{uid}","subject":"s","groupId":"","timestamp":"2021-02-11T23:00:00.000Z","event":{{"a":1}}}}',
        f'{{"eventId":"{uid}","subject":"s","groupId":"g","timestamp":"2021-02-11T23:00:00","event":null}}',
        '{"subject":5,"groupId":null,"timestamp":1613084400000,"event":{}}',
        f'{{"eventId":"{uid}","subject":"s","groupId":"g","timestamp":"2021"}}',
        "[1,2]",
        "not json",
    ]
    got = [(r.errors, r.timestamp is not None) for r in
           parse_bodies(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()]
    assert got[0] == ([], True)  # empty groupId is a valid string
    assert got[1] == ([], True)  # a null payload is still a payload
    assert sorted(got[2][0]) == sorted([
        "obj.eventId: error.path.missing", "obj.subject: error.expected.jsstring",
        "obj.groupId: error.expected.jsstring", "obj.timestamp: error.expected.date",
    ])
    assert sorted(got[3][0]) == ["obj.event: error.path.missing", "obj.timestamp: error.expected.date.isoformat"]
    assert got[4][0] == ["obj: error.expected.jsobject"] and got[5][0] == ["obj: error.expected.jsobject"]
