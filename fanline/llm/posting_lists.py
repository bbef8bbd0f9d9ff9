"""Approximate nearest neighbours by cosine over balanced posting lists.

Index. Centroids are fitted on a bounded sample of distinct unit vectors by
k-means whose assignment is charged for a list's size, which keeps the lists
balanced. Every vector lies in the list of its nearest centroid; a boundary
vector also in further lists whose centroid is at most ``1 + spread`` times as
far, unless that centroid is nearer to one already taken (then both would be
searched together anyway). ``BUNDLE`` lists at a time are searched together, and bundles beyond
``LIST_BLOCK`` rows are cut into blocks for separate tasks, so a crowded list is
no single task.

Search. A best-first walk over an in-memory graph of the centroids finds a
query's nearest lists; those at most ``1 + reach`` times as far as the nearest
are probed (at least ``least_lists``, and on until they hold k + 1 vectors).
The vectors of the probed lists are scored by exact cosine in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm.vectors import best_per_query, fold_equal, matrix, valid_vectors

LIST_BLOCK = 8192
QUERY_BLOCK = 512
#: lists searched together: a query sends its vector, and gets an answer, once a bundle
BUNDLE = 16


@dataclass(frozen=True)
class ListRule:
    """list_rows: rows aimed at per list; most_lists: bound on centroids (lists
    grow beyond it); sample_rows: bound on the sample the centroids are fitted on."""

    list_rows: int = 128
    most_lists: int = 4096
    sample_rows: int = 20_000
    copies: int = 6
    spread: float = 0.15
    reach: float = 0.30
    least_lists: int = 24
    degree: int = 16
    rounds: int = 8


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(sample: np.ndarray, lists: int, rule: ListRule) -> np.ndarray:
    """Balanced spherical k-means on distinct unit vectors."""
    x = np.unique(unit(sample), axis=0)
    lists = min(lists, len(x))
    rng = np.random.default_rng(7)
    cents = x[np.sort(rng.choice(len(x), lists, replace=False))].copy()
    fair = len(x) / lists
    size = np.full(lists, fair)
    for _ in range(rule.rounds):
        near = np.empty(len(x), int)
        for a in range(0, len(x), 4096):
            # crowded lists look farther away
            near[a : a + 4096] = (x[a : a + 4096] @ cents.T - 0.02 * np.log(np.maximum(size, 1) / fair)).argmax(axis=1)
        size = np.bincount(near, minlength=lists).astype(float)
        sums = np.zeros_like(cents)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(axis=1))
        good = norm > 1e-12
        cents[good] = sums[good] / norm[good, None]
    return np.unique(cents, axis=0)


def centroid_graph(cents: np.ndarray, degree: int) -> np.ndarray:
    """(lists x degree) nearest other centroids; a ring over the centroids keeps
    the graph in one piece."""
    n = len(cents)
    near = np.empty((n, min(degree, max(0, n - 1))), int)
    for a in range(0, n, 1024):
        sims = cents[a : a + 1024] @ cents.T
        sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -9
        if near.shape[1]:
            near[a : a + 1024] = np.argsort(-sims, axis=1, kind="stable")[:, : near.shape[1]]
    ring = np.stack([(np.arange(n) + 1) % n, (np.arange(n) - 1) % n], axis=1)
    return np.concatenate([near, ring], axis=1)


def nearest_lists(q: np.ndarray, cents: np.ndarray, graph: np.ndarray, want: int) -> list[tuple[float, int]]:
    """(distance, list) of about ``want`` nearest centroids by best-first walk."""
    starts = sorted({int(s) for s in np.linspace(0, len(cents) - 1, num=min(len(cents), 16))})
    seen = np.zeros(len(cents), bool)
    seen[starts] = True
    frontier = [(-float(cents[s] @ q), s) for s in starts]
    heapq.heapify(frontier)
    kept: list[tuple[float, int]] = [(-s, v) for s, v in frontier]  # min-heap of similarities
    heapq.heapify(kept)
    width = max(want, 32)
    while frontier:
        s, v = heapq.heappop(frontier)
        if len(kept) >= width and -s < kept[0][0]:
            break
        nxt = graph[v][~seen[graph[v]]]
        if not len(nxt):
            continue
        nxt = np.unique(nxt)
        seen[nxt] = True
        for sim, u in zip((cents[nxt] @ q).tolist(), nxt.tolist(), strict=True):
            if len(kept) < width or sim > kept[0][0]:
                heapq.heappush(frontier, (-sim, u))
                heapq.heappush(kept, (sim, u))
                if len(kept) > width:
                    heapq.heappop(kept)
    return sorted((math.sqrt(max(0.0, 2 - 2 * s)), v) for s, v in kept)


def lists_of(x: np.ndarray, cents: np.ndarray, rule: ListRule) -> list[list[int]]:
    """Lists that hold each unit vector, the nearest first."""
    out = []
    for a in range(0, len(x), 1024):
        dist = np.sqrt(np.maximum(0, 2 - 2 * (x[a : a + 1024] @ cents.T)))
        m = min(len(cents), 2 * rule.copies)
        near = np.argpartition(dist, m - 1, axis=1)[:, :m]
        for row, cand in zip(dist, near, strict=True):
            cand = cand[np.lexsort((cand, row[cand]))]
            taken = [int(cand[0])]
            for v in cand[1:]:
                if len(taken) >= rule.copies or row[v] > (1 + rule.spread) * row[cand[0]]:
                    break
                between = np.sqrt(np.maximum(0, 2 - 2 * (cents[taken] @ cents[v])))
                if (between >= row[v] * 0.5).all():
                    taken.append(int(v))
            out.append(taken)
    return out


def exact_cosine(q: np.ndarray, x: np.ndarray) -> float:
    """Cosine with exactly rounded sums: equal vectors get equal scores."""
    dot = math.fsum((q * x).tolist())
    return dot / (math.sqrt(math.fsum((q * q).tolist())) * math.sqrt(math.fsum((x * x).tolist())))


def nearest_neighbours(
    table: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    rule: ListRule = ListRule(),
) -> DataFrame:
    """(query_id long, rank int, vec_id long, score double): the k nearest found.

    is_query: condition on the column ``id``. Candidates are all rows with
    another id. Left out: NULL ids, vectors that are NULL, empty, zero, of an
    odd length (see valid_vectors) or with NULL or non-finite components.
    Repeated rows count once; with up to k candidates all are returned, since
    lists are probed until they hold k + 1 vectors; an empty table gives no
    rows; other columns are not read.
    """
    spark = table.sparkSession
    valid = valid_vectors(table, id_col, vec_col).where(F.exists("vec", lambda x: x != 0))
    whole = c.materialise(valid, "vectors")
    rows = c.materialise(fold_equal(whole, k + 1), "rows")
    n = rows.count()
    none = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], none)
    lists = max(1, min(rule.most_lists, n // rule.list_rows, rule.sample_rows // 4))
    drawn = rows.orderBy(F.xxhash64("id", F.lit(9)), "id").limit(rule.sample_rows).select("vec").collect()
    cents = fit_centroids(matrix([r["vec"] for r in drawn]), lists, rule)
    graph = centroid_graph(cents, rule.degree)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in c.by_rows(frames, 4096):
            held = lists_of(unit(matrix(f["vec"])), cents, rule)
            yield pd.DataFrame({"id": f["id"], "vec": f["vec"], "lists": held})

    placed = c.materialise(rows.mapInPandas(place, "id long, vec array<double>, lists array<int>"), "placed")
    copies = placed.select("id", "vec", F.posexplode("lists").alias("nth", "list"))
    sizes = copies.groupBy("list").agg(F.count("*").alias("n"), F.sum((F.col("nth") == 0).cast("int")).alias("own")).collect()
    held, own = np.zeros(len(cents), int), np.zeros(len(cents), int)  # one number per centroid
    for s in sizes:
        held[s["list"]], own[s["list"]] = s["n"], s["own"]
    per_bundle = np.bincount(np.arange(len(cents)) // BUNDLE, weights=held).astype(int)
    sizes_df = spark.createDataFrame(
        [(i, max(1, -(-int(n) // LIST_BLOCK))) for i, n in enumerate(per_bundle)], "bundle int, blocks long"
    )  # fewer rows than centroids

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = {"id": [], "vec": [], "bundle": [], "probed": []}
            for id_, vec, q in zip(f["id"], f["vec"], unit(matrix(f["vec"])) if len(f) else [], strict=True):
                want = rule.least_lists
                while True:
                    near = nearest_lists(q, cents, graph, 2 * want)
                    limit, found, done = (1 + rule.reach) * max(near[0][0], 1e-9), 0, False
                    taken = []
                    for rank, (dist, v) in enumerate(near):
                        if rank >= rule.least_lists and dist > limit and found > k:
                            done = True
                            break
                        taken.append(v)
                        found += own[v]
                    if done or len(near) >= len(cents):
                        break
                    want *= 2
                at = np.array(sorted(taken))
                for b in np.unique(at // BUNDLE):
                    out["id"].append(id_)
                    out["vec"].append(vec)
                    out["bundle"].append(b)
                    out["probed"].append(at[at // BUNDLE == b])
            yield pd.DataFrame(out)

    queries = whole.where(is_query).dropDuplicates(["id"])
    probes = queries.mapInPandas(probe, "id long, vec array<double>, bundle int, probed array<int>")
    probes = c.materialise(probes, "probes")
    asked = probes.groupBy("bundle").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("long").alias("parts"))
    grid = c.materialise(sizes_df.join(asked, "bundle"), "grid")  # fewer rows than centroids
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    bundled = copies.withColumn("bundle", F.floor(F.col("list") / BUNDLE).cast("int"))
    # a row's copies within a bundle travel once, with the lists they stand in
    held_once = bundled.groupBy("bundle", "id").agg(F.collect_list("list").alias("lists"), F.first("vec").alias("vec"))
    r = held_once.join(F.broadcast(grid), "bundle").select(
        "bundle", F.pmod(F.xxhash64("id", F.lit(5)), "blocks").alias("rb"), each("parts").alias("qb"), "id", "vec", "lists"
    )
    q = probes.join(F.broadcast(grid), "bundle").select(
        "bundle", each("blocks").alias("rb"), F.pmod(F.xxhash64("id", F.lit(6)), "parts").alias("qb"), "id", "vec", "probed"
    )

    def run(rf: pd.DataFrame, qf: pd.DataFrame) -> pd.DataFrame:
        qs, vs, ss = [], [], []
        if len(rf) and len(qf):
            ids, x = rf["id"].to_numpy(), matrix(rf["vec"])
            stands = np.zeros((len(ids), BUNDLE), bool)  # in which of the bundle's lists
            for row, lists in enumerate(rf["lists"]):
                stands[row, np.asarray(lists) % BUNDLE] = True
            sims = unit(matrix(qf["vec"])) @ unit(x).T
            for qid, qv, probed, s in zip(qf["id"], matrix(qf["vec"]), qf["probed"], sims, strict=True):
                s[(ids == qid) | ~stands[:, np.asarray(probed) % BUNDLE].any(axis=1)] = -np.inf
                kth = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -2.0
                best = [(-exact_cosine(qv, x[j]), int(ids[j])) for j in np.nonzero(s >= max(kth, -2.0) - 1e-9)[0]]
                for score, v in sorted(best)[:k]:
                    qs.append(qid)
                    vs.append(v)
                    ss.append(-score)
        return pd.DataFrame(
            {"query_id": np.array(qs, np.int64), "vec_id": np.array(vs, np.int64), "score": np.array(ss, float)}
        )

    by = ["bundle", "rb", "qb"]
    hits = r.groupBy(*by).cogroup(q.groupBy(*by)).applyInPandas(run, "query_id long, vec_id long, score double")
    return best_per_query(hits, k)
