"""Exact top-k inner products by Fagin's threshold algorithm.

The rows are dealt into blocks by id hash. In a block every dimension has its
list of rows sorted by value. All lists are read in parallel from the ends that
the signs of the queries' components favour; each row met is scored in full
(random access), once, and for all queries still going in one product: what one
query meets serves the others. Beyond the depth read, no row can score more than
the threshold, the inner product of the query with the values at that depth. A
query stops in a block when the threshold is below its k-th score so far (ties
are read on, so smaller ids win), at the latest when it has met every row of the
block. Depths double from round to round. The blocks' best are merged by one
window. The k-th score starts from nothing in each block, so blocks are
independent tasks: queries come in blocks as well, rows x queries in a grid.
"""

from __future__ import annotations

from collections.abc import Iterator  # noqa: F401

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm.vectors import best_per_query, fold_equal, matrix, valid_vectors

ROW_BLOCK = 16384
QUERY_BLOCK = 4096
#: queries that read the lists together: bounds the scores held at once
QUERY_PART = 256
FIRST_DEPTH = 8


def threshold_search(ids: np.ndarray, rows: np.ndarray, qids: np.ndarray, queries: np.ndarray, k: int):
    """(query index, row index, score) of each query's k best rows of a block.

    ids: row ids; rows: integer matrix; ``ids == qid`` is no answer to a query.
    """
    n, d = rows.shape
    span = max(abs(int(rows.min())), abs(int(rows.max()))) * max(1, int(np.abs(queries).max())) * d
    # BLAS floats hold such sums exactly
    exact = np.float32 if span < 1 << 24 else np.float64 if span < 1 << 53 else np.int64
    least = np.iinfo(exact).min if exact is np.int64 else -np.inf
    rows, queries = rows.astype(exact), queries.astype(exact)
    lists = np.argsort(rows.T, axis=1, kind="stable")  # a dimension's rows by ascending value
    values = np.take_along_axis(rows.T, lists, axis=1)
    # the depth at which a row is met first, in any list from any end that a query reads
    place, first = np.arange(n), np.full(n, n - 1)
    for k_list, up, down in zip(lists, (queries > 0).any(axis=0), (queries < 0).any(axis=0), strict=True):
        depth = np.minimum(n - 1 - place if up else n - 1, place if down else n - 1)
        first[k_list] = np.minimum(first[k_list], depth)
    met = np.argsort(first, kind="stable")
    first, met_ids, met_rows = first[met], ids[met], rows[met]
    out = []

    def best(q: np.ndarray, r: np.ndarray, s: np.ndarray):
        """Of (query, row met, score) triples the k best of each query, in order; their ranks."""
        by = np.lexsort((met_ids[r], -s, q))
        q, r, s = q[by], r[by], s[by]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        return q[rank < k], r[rank < k], s[rank < k], rank[rank < k]

    for start in range(0, len(queries), QUERY_PART):
        active = np.arange(start, min(start + QUERY_PART, len(queries)))
        kth = np.full(start + len(active), least, exact)
        found = (active[:0], active[:0], np.zeros(0, exact))
        at, depth = 0, FIRST_DEPTH
        while len(active):
            to = int(np.searchsorted(first, depth, side="right"))
            scores = queries[active] @ met_rows[at:to].T
            floor = kth[active]
            if at == 0 and to > k:  # nothing to beat yet: the k-th of the rows just met
                others = np.where(met_ids[at:to] == qids[active, None], scores.dtype.type(least), scores)
                floor = np.partition(others, to - k, axis=1)[:, to - k]
            q, r = np.nonzero(scores >= floor[:, None])
            s, q, r = scores[q, r], active[q], r + at
            other = met_ids[r] != qids[q]
            *found, rank = best(*(np.concatenate(x) for x in zip(found, (q[other], r[other], s[other]), strict=True)))
            kth[found[0][rank == k - 1]] = found[2][rank == k - 1]
            if to == n:
                stops = np.ones(len(active), bool)
            else:
                part = queries[active]
                bound = np.maximum(part, 0) @ values[:, n - 1 - depth] + np.minimum(part, 0) @ values[:, depth]
                stops = kth[active] > bound
            done = np.isin(found[0], active[stops])
            out.append([x[done] for x in found])
            found, active = [x[~done] for x in found], active[~stops]
            at, depth = to, depth * 2
    q, r, s = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (first[:0],) * 3
    return q, met[r], s


def exact_top_k(
    table: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """(query_id long, rank int, vec_id long, score long): each query's k largest
    inner products of ``floor(scale * x)`` vectors, ties to smaller ids.

    is_query: condition on the column ``id``. Candidates are all rows with
    another id than the query's. Left out: NULL ids, vectors that are NULL,
    empty, of an odd length (see valid_vectors) or with NULL or non-finite
    components. Zero vectors take part. Repeated rows count once. Scores are
    exact while they fit a long. Fewer than k candidates are all returned; an
    empty table gives no rows; other columns are not read.
    """
    valid = valid_vectors(table, id_col, vec_col)
    ints = c.materialise(
        valid.select("id", F.transform("vec", lambda x: F.floor(x * scale).cast("long")).alias("vec")), "ints"
    )
    rows = c.materialise(fold_equal(ints, k + 1), "rows")
    queries = ints.where(is_query).dropDuplicates(["id"])
    row_blocks = max(1, -(-rows.count() // ROW_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def cell(side: DataFrame, own: str, blocks: int, other: str, copies: int) -> DataFrame:
        dealt = side.withColumn(own, F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).cast("long"))
        return dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))

    r = cell(rows, "rb", row_blocks, "qb", query_blocks)
    q = cell(queries, "qb", query_blocks, "rb", row_blocks)

    def run(rf: pd.DataFrame, qf: pd.DataFrame) -> pd.DataFrame:
        none = np.array([], np.int64)
        if not len(rf) or not len(qf):
            return pd.DataFrame({"query_id": none, "vec_id": none, "score": none})
        ids, qids = rf["id"].to_numpy(), qf["id"].to_numpy()
        at_q, at_r, scores = threshold_search(
            ids, matrix(rf["vec"], np.int64), qids, matrix(qf["vec"], np.int64), k
        )
        return pd.DataFrame({"query_id": qids[at_q], "vec_id": ids[at_r], "score": scores.astype(np.int64)})

    hits = (
        r.groupBy("rb", "qb").cogroup(q.groupBy("rb", "qb")).applyInPandas(run, "query_id long, vec_id long, score long")
    )
    return best_per_query(hits, k)
