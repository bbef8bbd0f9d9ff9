"""J1 as data: content-based matching by counting satisfied predicates.

Subscriptions become rows. Each filter path is parsed in a task into clauses
(any of which may hold) of predicates (all of which must): leaf, operator, typed
literal, and whether it must hold or must not. The leaves that some predicate of
the topic reads form a trie, and every event walks down it, one join per
level, carrying typed values. Values then meet predicates: equalities by a hash
join on (topic, leaf, value), the others by a join on (topic, leaf) with their test.
A clause matches where as many predicates met as it has, and none of those that
must not hold: only what was met is counted, so an event is never compared with
the subscriptions that none of its values touch.

One form serves ten subscriptions and a million; neither paths nor predicates
come to the driver, and what is small enough is broadcast by its stored size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline.functions import jsonpath as jp
from fanline.session import stored

#: alternatives of one filter after its brackets are multiplied out
MAX_CLAUSES = 1024

#: hops of the trie: a field by name, any child, the tested element, no move
FIELD, ANY, ELEMENT, STAY = "k:", "*", ".", "="

PREDICATE_SCHEMA = (
    "pid long, clause long, part int, negated boolean, hops array<string>, op string, "
    "`values` array<struct<kind:string,number:double,text:string>>, needed long"
)
ROW, EVENT, NODE = "_match_row", "_match_event", "_match_node"

# (must hold, operator, leaf, literal values)
Predicate = tuple[bool, str, tuple[str, ...], tuple]


def _predicate(holds: bool, node) -> Predicate:
    """One comparison; those that an absent leaf satisfies are turned around, so
    that only what is present has to be counted."""
    if node[0] == "exists":
        return holds, "exists", node[1][1], ()
    _, op, left, right = node
    if op in ("!=", "nin"):
        holds, op = not holds, {"!=": "==", "nin": "in"}[op]
    if op == "=~":
        pattern = jp.regex_pattern(right)
        if re.fullmatch(right[1], "", re.I if right[2] else 0):  # reads a missing leaf as empty, and accepts it
            return not holds, "no regex", left[1], ((jp.STRING, None, pattern),)
        return holds, "regex", left[1], ((jp.STRING, None, pattern),)
    if op in ("==", "in"):
        items = right[1] if op == "in" else (right,)
        return holds, "equals", left[1], tuple(x for i in items for x in jp.literal_values(i))
    if op in ("anyof", "noneof", "subsetof"):
        return holds, op, left[1], tuple(x for i in right[1] for x in jp.literal_values(i))
    if op == "contains":
        return holds, op, left[1], tuple(jp.literal_values(right))
    return holds, op, left[1], (jp.literal_values(right)[0],)


def _clauses(node, holds: bool = True) -> list[list[Predicate]]:
    """Disjunctive form of a filter or of its negation."""
    if node[0] == "not":
        return _clauses(node[1], not holds)
    if node[0] in ("and", "or"):
        a, b = _clauses(node[1], holds), _clauses(node[2], holds)
        if (node[0] == "or") == holds:
            out = a + b
        else:
            if len(a) * len(b) > MAX_CLAUSES:
                raise jp.JsonPathError(f"a filter may have at most {MAX_CLAUSES} alternatives")
            out = [x + y for x in a for y in b]
        return out
    return [[_predicate(holds, node)]]


def clauses_of(path: str) -> list[tuple[list[str], list[Predicate]]]:
    """(hops to the tested element, predicates) of each clause of a filter path."""
    cp = jp.parse_path(path)
    hops = [ANY if s == jp.WILDCARD else FIELD + s for s in cp.container]
    if cp.kind == "wildcard":
        return [([*hops, ANY], [(True, "exists", (), ())])]
    out = []
    for clause in _clauses(cp.ast):
        clause = list(dict.fromkeys(clause))
        if not any(p[0] for p in clause):  # nothing has to hold: the element itself is met
            clause.append((True, "exists", (), ()))
        out.append(([*hops, ELEMENT], clause))
    return out


def path_errors(path: Column) -> Column:
    """Why a filter path cannot be used; NULL if it can (or is NULL)."""

    @F.pandas_udf("string")
    def error(paths: pd.Series) -> pd.Series:
        def of(p):
            try:
                if p is not None:
                    clauses_of(p)
                return None
            except jp.JsonPathError as e:
                return str(e)

        known = {p: of(p) for p in paths.unique()}
        return pd.Series([known[p] for p in paths], dtype=object)

    return error(path)


def predicate_rows(paths: DataFrame) -> DataFrame:
    """Rows of ``PREDICATE_SCHEMA`` for ``paths`` (pid, filter_path), parsed in tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["pid", "clause", "part", "negated", "hops", "op", "values", "needed"]
        for b in batches:
            rows = []
            for pid, path in zip(b["pid"], b["filter_path"]):
                for k, (hops, clause) in enumerate(clauses_of(path)):
                    needed = sum(p[0] for p in clause)
                    for part, (holds, op, leaf, values) in enumerate(clause):
                        items = [{"kind": v[0], "number": v[1], "text": v[2]} for v in values]
                        # the last hop parts a value that is read from the same value passed through
                        to = [*hops, *(FIELD + s for s in leaf), STAY]
                        rows.append((int(pid), int(pid) * MAX_CLAUSES + k, part, not holds, to, op, items, needed))
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return paths.mapInPandas(run, PREDICATE_SCHEMA)


def _node(hops: Column) -> Column:
    return F.to_json(hops)


class PredicateIndex:
    """The catalog's predicates as stored tables (``catalog``: topic, subscriber,
    filter_path of valid subscriptions)."""

    def __init__(self, catalog: DataFrame):
        spark = catalog.sparkSession
        subs = catalog.select("topic", "subscriber", "filter_path")
        self.open = stored(subs.where("filter_path IS NULL").select("topic", "subscriber"), "subs-open")
        texts = stored(subs.where("filter_path IS NOT NULL").select("filter_path").distinct(), "paths")
        paths = stored(texts.select(F.monotonically_increasing_id().alias("pid"), "filter_path"), "paths-numbered")
        filtered = subs.join(paths, "filter_path").select("topic", "subscriber", "pid")
        self.filtered = stored(filtered, "subs-filtered")
        rows = stored(predicate_rows(paths), "predicates")
        used = self.filtered.select("topic", "pid").distinct()
        rows = rows.join(used, "pid").withColumn("node", _node(F.col("hops")))
        key = F.transform("values", lambda v: jp.equality_key(v["kind"], v["number"], v["text"]))
        rows = rows.withColumn("keys", key)
        self.equal = stored(
            rows.where("op = 'equals'").select("topic", "node", "clause", "part", "negated", F.explode("keys").alias("key")).distinct(), "equal"
        )
        self.tested = stored(
            rows.where("op <> 'equals'").select("topic", "node", "clause", "part", "negated", "op", "values", "keys"), "tested"
        )
        self.clauses = stored(rows.select("topic", "clause", "pid", "needed").distinct(), "clauses")
        # the trie: each prefix of a leaf's hops leads to the next one
        at = F.explode(F.sequence(F.lit(0), F.size("hops") - 1)).alias("i")
        steps = rows.select("topic", "hops", at).select(
            "topic",
            _node(F.slice("hops", F.lit(1), F.col("i"))).alias("parent"),
            F.element_at("hops", F.col("i") + 1).alias("hop"),
            _node(F.slice("hops", F.lit(1), F.col("i") + 1)).alias("child"),
        )
        stay = rows.select("topic", F.col("node").alias("parent"), F.lit(STAY).alias("hop"), F.col("node").alias("child"))
        self.steps = stored(steps.unionByName(stay).distinct(), "trie")
        first = rows.agg(F.max(F.size("hops")).alias("depth"), F.max(F.array_contains("hops", ANY)).alias("star")).first()
        self.depth, self.star = first["depth"] or 0, bool(first["star"])
        self.root = json.dumps([])
        self.spark = spark


def _children(v: Column, star: bool) -> Column:
    """Every move from a value: array of (hop, place, value)."""

    def move(hop: Column, place: Column, value: Column) -> Column:
        return F.struct(hop.alias("hop"), place.cast("string").alias("place"), value.alias("value"))

    none = F.lit(None).cast("string")
    fields, elements = jp.fields_of(v), jp.elements_of(v)
    entries = F.map_entries(fields)
    moves = [
        F.array(move(F.lit(STAY), none, v)),
        F.when(fields.isNotNull(), F.array(move(F.lit(ELEMENT), none, v))),
        F.transform(entries, lambda e: move(F.concat(F.lit(FIELD), e["key"]), none, e["value"])),
        F.transform(elements, lambda e, i: move(F.lit(ELEMENT), i, e)),
    ]
    if star:
        moves += [
            F.transform(entries, lambda e: move(F.lit(ANY), e["key"], e["value"])),
            F.transform(elements, lambda e, i: move(F.lit(ANY), i, e)),
        ]
    empty = F.array().cast("array<struct<hop:string,place:string,value:variant>>")
    return F.concat(*[F.coalesce(m, empty) for m in moves])


def leaves(events: DataFrame, index: PredicateIndex, doc_col: str) -> DataFrame:
    """(ROW, topic, node, element, value): the leaves of ``events`` (ROW, topic,
    doc_col) that predicates of the topic read; ``element`` is the place of the tested
    element among arrays and wildcards."""
    at = events.select(
        ROW, "topic", F.lit(index.root).alias(NODE), F.lit("").alias("element"), F.try_parse_json(doc_col).alias("value")
    ).where(F.col("value").isNotNull())
    steps = index.steps.select(F.col("topic").alias("_of"), "parent", F.col("hop").alias("_by"), "child")
    for _ in range(index.depth):
        moved = at.withColumn("_to", F.explode(_children(F.col("value"), index.star))).select(
            ROW, "topic", NODE, "element", "_to.hop", "_to.place", F.col("_to.value").alias("value")
        )
        met = moved.join(steps, (F.col("topic") == F.col("_of")) & (F.col(NODE) == F.col("parent")) & (F.col("hop") == F.col("_by")))
        place = F.when(F.col("place").isNull(), F.col("element")).otherwise(F.concat_ws("/", "element", "place"))
        at = met.select(ROW, "topic", F.col("child").alias(NODE), place.alias("element"), "value")
    return at


def _holds(v: Column) -> Column:
    """Does the predicate of the row (op, values, keys) hold for value ``v``?"""
    op, first = F.col("op"), F.get("values", F.lit(0))
    number, text = first["number"], first["text"]
    kind, mine, said = jp.kind_of(v), jp.number_of(v), jp.text_of(v)
    elements, size = jp.elements_of(v), jp.length_of(v)

    def among(e: Column) -> Column:
        return F.coalesce(F.array_contains("keys", jp.value_key(e)), F.lit(False))

    def ordered(compare) -> Column:
        return (kind == first["kind"]) & F.when(kind == jp.NUMBER, compare(mine, number)).otherwise(compare(said, text))

    some = F.exists(elements, among)
    test = (
        F.when(op == "exists", F.lit(True))
        .when(op == "<", ordered(lambda a, b: a < b))
        .when(op == "<=", ordered(lambda a, b: a <= b))
        .when(op == ">", ordered(lambda a, b: a > b))
        .when(op == ">=", ordered(lambda a, b: a >= b))
        .when(op == "regex", jp.regex_matches(v, text))
        .when(op == "no regex", ~jp.regex_matches(v, text))
        .when(op == "size", size == number)
        .when(op == "empty", (size == 0) == (text == "true"))
        .when(op == "contains", F.when(elements.isNotNull(), some).otherwise((kind == jp.STRING) & (first["kind"] == jp.STRING) & F.contains(said, text)))
        .when(op == "anyof", some)
        .when(op == "noneof", ~some)
        .when(op == "subsetof", F.forall(elements, among))
    )
    return F.coalesce(test, F.lit(False))


def matched_subscribers(events: DataFrame, index: PredicateIndex, doc_col: str = "event") -> DataFrame:
    """(ROW, subscriber) of every match of ``events`` (ROW, topic, doc_col), once each.

    Events with a NULL topic or an unreadable document match no filter; the latter
    still reach the subscribers of their topic that have none."""
    everyone = events.select(ROW, "topic").join(index.open, "topic").select(ROW, "subscriber")
    if not index.depth:
        return everyone
    read = leaves(events, index, doc_col)
    marks = [ROW, "element", "clause", "part", "negated"]
    key = jp.value_key(F.col("value"))
    on = lambda t: (F.col("topic") == F.col("_of")) & (F.col(NODE) == F.col("node"))
    equal = index.equal.withColumnsRenamed({"topic": "_of", "key": "_key"})
    tested = index.tested.withColumnRenamed("topic", "_of")
    met = read.withColumn("_is", key).join(equal, on(equal) & (F.col("_is") == F.col("_key"))).select(*marks)
    met = met.unionByName(read.join(tested, on(tested) & _holds(F.col("value"))).select(*marks))
    # a leaf has one value in an element, so each predicate is met once at most
    counted = met.groupBy(ROW, "element", "clause").agg(
        F.count_if(~F.col("negated")).alias("held"), F.count_if("negated").alias("broken")
    )
    clauses = index.clauses.select("clause", "pid", "needed").distinct()
    full = counted.where("broken = 0").join(clauses, "clause").where("held = needed").select(ROW, "pid").distinct()
    some = full.join(events.select(ROW, "topic"), ROW).join(index.filtered, ["topic", "pid"]).select(ROW, "subscriber")
    return everyone.unionByName(some)
