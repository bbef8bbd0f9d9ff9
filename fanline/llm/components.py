"""Connected components of a link table, all in Spark joins and aggregations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline.llm.common import drop, materialise

#: rows of a step's table that a task takes, once every core has one
ROWS_A_TASK = 1 << 16


def _least_neighbour(both: DataFrame) -> DataFrame:
    """u -> the smallest of u and its neighbours (partial aggregation first, so a
    node with very many links is pre-combined on every map task)."""
    return both.groupBy("u").agg(F.min("v").alias("lv")).select("u", F.least("u", "lv").alias("m"))


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _with_roots(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Alternating large-star and small-star steps until nothing changes.

    ``links``: undirected links between integer nodes. Returns (node long,
    component long) for every node with a link to another node; component is
    the smallest node reachable. Self links, repeats, NULL ends and empty
    inputs are fine (they link nothing). Each step is written to the shared
    checkpoint folder, so lineage stays short; the joins read two freshly
    exchanged sides, which adaptive execution splits at hub nodes. A step's
    tables are written by as many tasks as their rows need, however many
    partitions the session shuffles to, and go once the next step is written.
    """
    edges = materialise(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .distinct(),
        "cc",
    )
    before = _fingerprint(edges)
    if not before[0]:
        return _with_roots(edges)
    cores = links.sparkSession.sparkContext.defaultParallelism
    while True:
        # no table of a step has more than two rows for each link
        tasks = max(cores, math.ceil(2 * before[0] / ROWS_A_TASK))
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(_least_neighbour(both).coalesce(tasks), "cc-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        old, edges = (edges, least), materialise(large.where("u != v").coalesce(tasks), "cc-large")
        drop(*old)
        # small star: every larger end links to the smallest neighbour at or below itself
        least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "cc-least")
        small = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        old, edges = (edges, least), materialise(small.where("u != v").distinct().coalesce(tasks), "cc-small")
        drop(*old)
        after = _fingerprint(edges)
        if after == before:
            return _with_roots(edges)
        before = after
