"""Differential test: compiled filters vs a plain-Python evaluator of the subset."""

import json
import random
import re

from pyspark.sql import functions as F

from fanline.functions.jsonpath import doc_schema, parse_path, parsed_predicate, path_predicate

MISSING = object()
KEYS = ["a", "b", "c"]
STRS = ["x", "y", "ERR1", "err", "5"]


def rand_value(rnd, depth=0):
    r = rnd.random()
    if r < 0.35:
        return rnd.randint(0, 9)
    if r < 0.6:
        return rnd.choice(STRS)
    if r < 0.68:
        return rnd.choice([True, False])
    if r < 0.74:
        return None
    if depth < 1:
        return {k: rand_value(rnd, depth + 1) for k in rnd.sample(KEYS, rnd.randint(0, 3))}
    return rnd.randint(0, 9)


def rand_doc(rnd):
    r = rnd.random()
    if r < 0.7:
        ev = {k: rand_value(rnd) for k in rnd.sample(KEYS, rnd.randint(0, 3))}
    elif r < 0.85:
        ev = [{k: rand_value(rnd) for k in rnd.sample(KEYS, rnd.randint(0, 3))} for _ in range(rnd.randint(0, 3))]
    elif r < 0.93:
        ev = rnd.choice([3, "text", None])
    else:
        return json.dumps({"other": 1})
    return json.dumps({"event": ev})


def rand_leaf(rnd):
    return ["@." + rnd.choice(KEYS)] + (["." + rnd.choice(KEYS)] if rnd.random() < 0.3 else [])


def rand_pred(rnd, depth=0):
    r = rnd.random()
    if depth < 2 and r < 0.2:
        op = rnd.choice(["&&", "||"])
        return f"({rand_pred(rnd, depth + 1)} {op} {rand_pred(rnd, depth + 1)})"
    if depth < 2 and r < 0.27:
        return f"!({rand_pred(rnd, depth + 1)})"
    leaf = "".join(rand_leaf(rnd))
    r = rnd.random()
    if r < 0.15:
        return leaf
    if r < 0.5:
        return f"{leaf} {rnd.choice(['==', '!=', '<', '<=', '>', '>='])} {rnd.randint(0, 9)}"
    if r < 0.72:
        return f"{leaf} {rnd.choice(['==', '!=', '<', '>'])} '{rnd.choice(STRS)}'"
    if r < 0.78:
        return f"{leaf} {rnd.choice(['==', '!='])} {rnd.choice(['null', 'true', 'false'])}"
    if r < 0.88:
        return f"{leaf} =~ /{rnd.choice(['ERR.*', 'x|y', '[0-9]+', '.*', 'true'])}/{rnd.choice(['', 'i'])}"
    items = ", ".join(rnd.choice([str(rnd.randint(0, 9)), f"'{rnd.choice(STRS)}'", "null", "true"]) for _ in range(2))
    return f"{leaf} {rnd.choice(['in', 'nin'])} [{items}]"


def get(ctx, segs):
    for s in segs:
        if not isinstance(ctx, dict) or s not in ctx:
            return MISSING
        ctx = ctx[s]
    return ctx


def kind(v):
    if v is MISSING:
        return "missing"
    if v is None:
        return "null"
    return {bool: "bool", str: "str", int: "num", float: "num"}.get(type(v), "other")


def equal(v, lit):
    if lit[0] == "num":
        return (kind(v) == "num" and v == lit[1]) or (kind(v) == "str" and v == lit[2])
    if lit[0] == "str":
        return (kind(v) == "str" and v == lit[1]) or (kind(v) == "num" and re.fullmatch("[0-9]+", lit[1]) is not None and v == int(lit[1]))
    return kind(v) == lit[0] and (lit[0] == "null" or v == lit[1])


def ev_node(n, ctx):
    op = n[0]
    if op == "and":
        return ev_node(n[1], ctx) and ev_node(n[2], ctx)
    if op == "or":
        return ev_node(n[1], ctx) or ev_node(n[2], ctx)
    if op == "not":
        return not ev_node(n[1], ctx)
    if op == "exists":
        return get(ctx, n[1][1]) is not MISSING
    _, cmp, left, right = n
    v = get(ctx, left[1])
    if cmp == "=~":
        each = v if isinstance(v, list) else [v]
        texts = [json.dumps(x) if kind(x) in ("num", "bool") else x if kind(x) == "str" else "" for x in each]
        return any(re.fullmatch(right[1], t, re.I if right[2] else 0) for t in texts)
    if cmp in ("in", "nin"):
        return any(equal(v, i) for i in right[1]) == (cmp == "in")
    if cmp in ("==", "!="):
        return equal(v, right) == (cmp == "==")
    if kind(v) != right[0]:
        return False
    a, b = v, right[1]
    return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[cmp]


def evaluate(cp, doc_text):
    doc = json.loads(doc_text)
    cont = get(doc, cp.container)
    if isinstance(cont, list):
        return any(bool(ev_node(cp.ast, e)) for e in cont)
    if isinstance(cont, dict):
        return bool(ev_node(cp.ast, cont))
    return False


def test_random_paths_against_python(spark):
    rnd = random.Random(2024)
    docs = [rand_doc(rnd) for _ in range(300)]
    paths = [parse_path(f"$.event[?({rand_pred(rnd)})]") for _ in range(60)]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    schema, slow = doc_schema(paths)
    df = df.withColumn("p", F.from_json("doc", schema))
    cols = [path_predicate(cp, F.col("doc")).alias(f"s{i}") for i, cp in enumerate(paths)]
    cols += [parsed_predicate(cp, F.col("p"), F.col("doc")).alias(f"f{i}") for i, cp in enumerate(paths) if cp.text not in slow]
    rows = df.select("doc", *cols).collect()
    for r in rows:
        for i, cp in enumerate(paths):
            want = evaluate(cp, r["doc"])
            assert r[f"s{i}"] == want, (cp.text, r["doc"])
            if cp.text not in slow:
                assert r[f"f{i}"] == want, ("parsed", cp.text, r["doc"])
