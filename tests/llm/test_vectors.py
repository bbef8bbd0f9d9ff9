"""op3 and op6: exact search equals brute force; recall and ties of the index."""

import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from fanline.llm.posting_lists import ListRule, centroid_graph, fit_centroids, nearest_lists, nearest_neighbours, unit
from fanline.llm.threshold_topk import exact_top_k, threshold_search

SCHEMA = "vec_id long, embedding array<float>, id int, vec string, list int, rb int, score string"
ODD = [
    (7000, None),
    (7001, []),
    (7002, [0.0] * 8),
    (7003, [float("nan")] + [1.0] * 7),
    (7004, [float("inf")] + [1.0] * 7),
    (7005, [None] + [1.0] * 7),
    (7006, [1.0, 2.0]),
    (None, [1.0] * 8),
]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    x = (centres[rng.integers(0, 12, 700)] + rng.normal(scale=0.4, size=(700, 8))).astype(np.float32)
    x[100:320] = x[100]  # a vector that a third of the table shares
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    random.Random(1).shuffle(rows)
    full = [(i, v, 1, "x", 2, 3, "y") for i, v in rows + rows[:5] + ODD]
    return dict(rows), spark.createDataFrame(full, SCHEMA)


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_exact_top_k_equals_brute_force(table):
    vecs, df = table
    ints = {i: [math.floor(64 * x) for x in v] for i, v in vecs.items()} | {7002: [0] * 8}
    got = ranked(exact_top_k(df, F.col("id") % 20 == 0, k=20))
    assert set(got) == {i for i in ints if i % 20 == 0}
    for q, hits in got.items():
        all_ = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)
        assert hits == [(n + 1, i, -s) for n, (s, i) in enumerate(all_[:20])]


def test_threshold_stops_early_and_is_exact():
    rng = np.random.default_rng(2)
    rows = rng.integers(-30, 30, (3000, 4))
    queries = np.array([[9, 0, 0, 0], [1, -2, 3, -4], [0, 0, 0, 0]])
    q, r, s = threshold_search(np.arange(3000), rows, np.array([5, -1, -1]), queries, 7)
    for k in range(3):
        scores = rows @ queries[k]
        want = sorted((-int(v), i) for i, v in enumerate(scores) if not (k == 0 and i == 5))[:7]
        assert sorted((-int(v), int(i)) for i, v in zip(r[q == k], s[q == k], strict=True)) == want


def calls_of(search):
    """Calls of functions, built-in ones too, that a search makes."""
    made = []
    sys.setprofile(lambda frame, event, arg: made.append(event) if event in ("call", "c_call") else None)
    try:
        search()
    finally:
        sys.setprofile(None)
    return len(made)


def test_threshold_rounds_serve_many_queries_at_once():
    # vectors that no threshold stops early: each query meets the whole block
    rng = np.random.default_rng(4)
    rows, queries = rng.integers(-30, 30, (2000, 32)), rng.integers(-30, 30, (200, 32))
    few, many = (
        calls_of(lambda m=m: threshold_search(np.arange(2000), rows, np.full(m, -1), queries[:m], 5)) for m in (20, 200)
    )
    assert many < 1.5 * few


@pytest.mark.parametrize("high", [3, 2**12, 2**28])
def test_threshold_search_equals_brute_force(high):
    rng = np.random.default_rng(high)
    for n, d, m, k in [(1, 3, 4, 2), (40, 2, 600, 3), (300, 5, 30, 7), (900, 3, 40, 20)]:
        rows = rng.integers(-high, high + 1, (n, d)) * (rng.random((n, d)) < 0.7)
        queries = rng.integers(-high, high + 1, (m, d)) * (rng.random((m, d)) < 0.6)
        ids, qids = rng.permutation(2 * n)[:n], rng.integers(0, 2 * n, m)
        q, r, s = threshold_search(ids, rows, qids, queries, k)
        scores = rows @ queries.T
        for j in range(m):
            want = sorted((-int(scores[i, j]), int(ids[i])) for i in range(n) if ids[i] != qids[j])[:k]
            assert sorted((-int(v), int(ids[i])) for i, v in zip(r[q == j], s[q == j], strict=True)) == want


def test_large_components_stay_exact():
    rows = np.array([[2**30, 1], [2**30, 2], [-(2**30), 3]])
    _, r, s = threshold_search(np.arange(3), rows, np.array([9]), np.array([[2**30, 1]]), 2)
    assert r.tolist() == [1, 0] and s.tolist() == [2**60 + 2, 2**60 + 1]


def test_posting_lists_recall_and_ties(table):
    vecs, df = table
    unit_of = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in vecs.items()}
    got = ranked(nearest_neighbours(df, F.col("id") % 10 == 0, k=5, rule=ListRule(list_rows=16, least_lists=6)))
    assert set(got) == {i for i in vecs if i % 10 == 0}
    met = total = 0
    for q, hits in got.items():
        all_ = sorted((-round(float(unit_of[q] @ v), 9), i) for i, v in unit_of.items() if i != q)[:5]
        assert [h[0] for h in hits] == [1, 2, 3, 4, 5]
        for _, i, s in hits:
            assert abs(s - float(unit_of[q] @ unit_of[i])) < 1e-12
        met += len({h[1] for h in hits} & {i for _, i in all_})
        total += 5
    assert met >= 0.95 * total
    # of equal vectors the smallest ids come first
    assert [h[1] for h in got[200]] == [100, 101, 102, 103, 104]


def test_few_rows_and_empty_table(spark, table):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [h[1] for h in ranked(nearest_neighbours(few, F.col("id") == 0, k=5))[0]] == [2, 1]
    assert [h[1] for h in ranked(exact_top_k(few, F.col("id") == 0, k=5))[0]] == [2, 1]
    for search in (nearest_neighbours, exact_top_k):
        assert search(few.where("vec_id > 9"), F.lit(True)).count() == 0
        assert search(few, F.col("id") == 77).count() == 0


def test_graph_walk_finds_the_nearest_lists():
    rng = np.random.default_rng(3)
    cents = fit_centroids(rng.normal(size=(3000, 16)), 300, ListRule())
    graph = centroid_graph(cents, 16)
    met = 0
    for q in unit(rng.normal(size=(50, 16))):
        found = [v for _, v in nearest_lists(q, cents, graph, 20)][:20]
        met += len(set(found) & set(np.argsort(-(cents @ q))[:20].tolist()))
    assert met >= 0.95 * 50 * 20
