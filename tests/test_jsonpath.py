import pytest
from pyspark.sql import functions as F

from fanline.functions.jsonpath import JsonPathError, parse_path, path_predicate

# A harbour's crane alert, and the same without the berth.
FULL = (
    '{"eventId":"c0ffee00-0000-4000-8000-000000000042","subject":"cranes","groupId":"quay-7",'
    '"timestamp":"2023-08-04T05:06:07.080Z","event":{"berth":"NORTH_07 outer wall","load":{"tonnes":18,"lashed":true},'
    '"alerts":["wind","swing"],"operator":null}}'
)
NOPATH = FULL.replace('"berth":"NORTH_07 outer wall",', "")
FOREIGN = '{"eventId":"x","event":{"foo":"bar"}}'
ARRAY = '{"event":{"items":[{"x":1},{"x":5}]}}'
REGEX = "$.event[?(@.berth =~ /north_\\d+ .*/i)]"


def evaluate(spark, path, docs):
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    return [r[0] for r in df.select(path_predicate(path, F.col("doc"))).collect()]


def test_regex_filter_full_and_missing_field(spark):
    assert evaluate(spark, REGEX, [FULL, NOPATH, FOREIGN]) == [True, False, False]


def test_regex_is_whole_string_and_case_insensitive(spark):
    docs = ['{"event":{"t":"error"}}', '{"event":{"t":"ERROR"}}', '{"event":{"t":"an error"}}']
    assert evaluate(spark, "$.event[?(@.t =~ /ERR.*/i)]", docs) == [True, True, False]
    assert evaluate(spark, "$.event[?(@.t =~ /ERR.*/)]", docs) == [False, True, False]


def test_comparisons_and_boolean_ops(spark):
    docs = ['{"event":{"k":50,"t":"error"}}', '{"event":{"k":49,"t":"error"}}', '{"event":{"k":95,"t":"view"}}']
    assert evaluate(spark, "$.event[?(@.k >= 50)]", docs) == [True, False, True]
    assert evaluate(spark, "$.event[?(@.k >= 50 && @.t == 'error')]", docs) == [True, False, False]
    assert evaluate(spark, "$.event[?(@.k < 50 || @.t != 'error')]", docs) == [False, True, True]
    assert evaluate(spark, "$.event[?(!(@.k > 60))]", docs) == [True, True, False]
    assert evaluate(spark, "$.event[?(50 <= @.k)]", docs) == [True, False, True]
    assert evaluate(spark, "$.event[?(@.k in [49, 95])]", docs) == [False, True, True]
    assert evaluate(spark, "$.event[?(@.t nin ['view'])]", docs) == [True, True, False]


def test_existence_and_wildcard(spark):
    assert evaluate(spark, "$.event[?(@.foo)]", [FOREIGN, FULL]) == [True, False]
    assert evaluate(spark, "$.event[*]", [FOREIGN, '{"event":{}}', '{"x":1}']) == [True, False, False]


def test_filter_over_array_matches_any_element(spark):
    assert evaluate(spark, "$.event.items[?(@.x > 3)]", [ARRAY]) == [True]
    assert evaluate(spark, "$.event.items[?(@.x > 9)]", [ARRAY]) == [False]


def test_nested_field_and_bracket_names(spark):
    doc = '{"event":{"props":{"k":7},"a-b":"z"}}'
    assert evaluate(spark, "$.event[?(@.props.k == 7)]", [doc]) == [True]
    assert evaluate(spark, "$['event'][?(@['a-b'] == 'z')]", [doc]) == [True]


@pytest.mark.parametrize("bad", ["$.event.berth", "event[?(@.a)]", "$.e[?(@.a < null)]", "$.e[?(@.a size '2')]", "$.e[?(@.a in 3)]", "$..a[?(@.b)]", "$.a[?(@.b ==)]", "$.a[?(@.b =~ 'x')]"])
def test_rejected_paths(bad):
    with pytest.raises(JsonPathError):
        p = parse_path(bad)
        if p.ast and p.ast[0] == "cmp" and p.ast[1] == "=~":
            path_predicate(p, F.col("doc"))


def test_parse_once_equals_per_path(spark):
    """The one-parse fast path must agree with the per-path form on every shape."""
    from fanline.functions.jsonpath import doc_schema, parsed_predicate

    paths = [
        parse_path(p)
        for p in [
            REGEX,
            "$.event[?(@.props.k >= 50)]",
            "$.event[?(@.props.k >= 90 && @.event_type == 'error')]",
            "$.event[?(@.user_id < 20)]",
            "$.event[?(@.foo)]",
            "$.event.items[?(@.x > 3)]",
            "$.event[?(@.props == 'x')]",  # clashes with props.k: stays per-path
        ]
    ]
    docs = [
        FULL, NOPATH, FOREIGN, ARRAY,
        '{"event":[{"props":{"k":70}},{"props":{"k":1}}]}',
        '{"event":{"props":"x","user_id":3}}',
        '{"event":{"props":{"k":"95"},"event_type":"error","user_id":"7"}}',
        '{"event":{"props":{"k":[1,2]},"user_id":null}}',
        '{"event":"text"}',
        '{"other":1}',
    ]
    schema, slow = doc_schema(paths)
    assert "$.event[?(@.props == 'x')]" in slow
    df = spark.createDataFrame([(d,) for d in docs], "doc string").withColumn("p", F.from_json("doc", schema))
    for cp in paths:
        if cp.text in slow:
            continue
        a = [r[0] for r in df.select(parsed_predicate(cp, F.col("p"), F.col("doc"))).collect()]
        b = [r[0] for r in df.select(path_predicate(cp, F.col("doc"))).collect()]
        assert a == b, cp.text


def test_wildcards_inside_the_container(spark):
    docs = [
        '{"event":{"groups":[{"members":[{"role":"user"},{"role":"admin"}]},{"members":[]}]}}',
        '{"event":{"groups":[{"members":[{"role":"user"}]}]}}',
        '{"event":{"groups":{"g1":{"members":{"role":"admin"}}}}}',
        '{"event":{"items":[{"x":1},{"x":5}]}}',
        '{"event":{"groups":[1,2]}}',
    ]
    assert evaluate(spark, "$.event.groups[*].members[?(@.role == 'admin')]", docs) == [True, False, True, False, False]
    assert evaluate(spark, "$.event.items[*][?(@.x > 3)]", docs) == [False, False, False, True, False]
    assert evaluate(spark, "$.event.items[?(@.x > 3)]", docs) == [False, False, False, True, False]
    assert evaluate(spark, "$.event.groups[*].members[*]", docs) == [True, True, True, False, False]


def test_collection_operators(spark):
    docs = [
        '{"event":{"tags":["a","b"],"name":"alpha","codes":[1,2,3]}}',
        '{"event":{"tags":[],"name":"","codes":[4]}}',
        '{"event":{"tags":"a","codes":5}}',
    ]
    assert evaluate(spark, "$.event[?(@.tags size 2)]", docs) == [True, False, False]
    assert evaluate(spark, "$.event[?(@.name size 5)]", docs) == [True, False, False]
    assert evaluate(spark, "$.event[?(@.tags empty true)]", docs) == [False, True, False]
    assert evaluate(spark, "$.event[?(@.name empty false)]", docs) == [True, False, False]
    assert evaluate(spark, "$.event[?(@.tags contains 'b')]", docs) == [True, False, False]
    assert evaluate(spark, "$.event[?(@.name contains 'lph')]", docs) == [True, False, False]
    assert evaluate(spark, "$.event[?(@.codes anyof [3, 4])]", docs) == [True, True, False]
    assert evaluate(spark, "$.event[?(@.codes noneof [3, 4])]", docs) == [False, False, False]
    assert evaluate(spark, "$.event[?(@.codes subsetof [1, 2, 3, 4])]", docs) == [True, True, False]
    assert evaluate(spark, "$.event[?(@.tags anyof ['x'])]", docs) == [False, False, False]


def test_missing_fields_equal_nothing(spark):
    docs = ['{"event":{"t":"x"}}', '{"event":{"t":"y"}}', '{"event":{}}', '{"event":{"t":null}}']
    assert evaluate(spark, "$.event[?(@.t == 'x')]", docs) == [True, False, False, False]
    assert evaluate(spark, "$.event[?(@.t != 'x')]", docs) == [False, True, True, True]
    assert evaluate(spark, "$.event[?(@.t in ['x', 'z'])]", docs) == [True, False, False, False]
    assert evaluate(spark, "$.event[?(@.t nin ['x', 'z'])]", docs) == [False, True, True, True]


def test_fields_that_differ_in_case_only(spark):
    from fanline.functions.jsonpath import doc_schema, parsed_predicate

    paths = [parse_path(p) for p in ("$.event[?(@.Kind == 1)]", "$.event[?(@.kind == 2)]", "$.Event[?(@.kind == 3)]")]
    docs = ['{"event":{"Kind":1,"kind":2}}', '{"event":{"kind":1}}', '{"Event":{"kind":3}}']
    schema, slow = doc_schema(paths)
    df = spark.createDataFrame([(d,) for d in docs], "doc string").withColumn("p", F.from_json("doc", schema))
    cols = [
        path_predicate(p, F.col("doc")) if p.text in slow else parsed_predicate(p, F.col("p"), F.col("doc")) for p in paths
    ]
    assert [tuple(r) for r in df.select(*cols).collect()] == [
        (True, True, False), (False, False, False), (False, False, True)
    ]


def test_types_decide(spark):
    """One leaf of each JSON type and a missing one, against literals of each type."""
    docs = ['{"event":{"v":%s}}' % v for v in ("60", '"60"', "60.0", '"60.0"', "true", '"true"', "null", "[60]", '{"x":60}')] + ['{"event":{}}']

    def hits(expr):
        got = evaluate(spark, f"$.event[?({expr})]", docs)
        return [k for k, x in enumerate(got) if x]

    assert hits("@.v >= 50") == [0, 2]  # numbers only
    assert hits("@.v >= '50'") == [1, 3, 5]  # strings only
    assert hits("@.v == 60") == [0, 1, 2]  # and strings that read the same
    assert hits("@.v == '60'") == [0, 1, 2]
    assert hits("@.v == true") == [4]
    assert hits("@.v == 'true'") == [5]
    assert hits("@.v == null") == [6]
    assert hits("@.v != null") == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert hits("@.v") == [0, 1, 2, 3, 4, 5, 6, 7, 8]  # present, null included
    assert hits("!(@.v)") == [9]
    assert hits("@.v in [null, true, 61]") == [4, 6]
    assert hits("@.v =~ /[0-9.]+/") == [0, 1, 2, 3, 7]  # scalars as text, any array element
    assert hits("@.v =~ /.*/") == list(range(10))  # null, object and missing read as empty
    assert hits("@.v size 1") == [7, 8]
    assert hits("@.v contains 60") == [7]


def test_dots_inside_literals_are_no_deep_scan(spark):
    docs = ['{"event":{"a":"ab..c"}}', '{"event":{"a":"abxyc"}}', '{"event":{"a":"x..y"}}']
    assert evaluate(spark, "$.event[?(@.a =~ /ab..c/)]", docs) == [True, True, False]
    assert evaluate(spark, "$.event[?(@.a == 'x..y')]", docs) == [False, False, True]
    for bad in ("$..event[?(@.a == 'x..y')]", "$.event[?(@..a == 'x')]"):
        with pytest.raises(JsonPathError):
            parse_path(bad)
