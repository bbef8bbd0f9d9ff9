"""Vector tables: valid rows, rows with equal vectors folded to their smallest ids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, vec array<double>) of rows that can take part: the id is given,
    the vector is not NULL or empty and has finite components only. Vectors of
    another length than the table's commonest (the shorter on a tie) are left
    out; an id with several vectors keeps each of them."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        F.col("id").isNotNull()
        & F.coalesce(F.size("vec") > 0, F.lit(False))
        & F.coalesce(
            F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)
        )
    )
    dims = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    first = dims.orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("vec") == (first["d"] if first else 0))


def fold_equal(rows: DataFrame, keep: int) -> DataFrame:
    """Of rows with the same ``vec``, the ``keep`` smallest ids. A search for k
    others per query needs no more than k + 1 of them: ties go to smaller ids.
    The row limit is applied on the map side first, so a vector that a third of
    the table shares is cut down before the shuffle."""
    same = Window.partitionBy("vec").orderBy("id")
    return rows.distinct().withColumn("rank", F.row_number().over(same)).where(F.col("rank") <= keep).drop("rank")


def matrix(vecs, dtype=np.float64) -> np.ndarray:
    return np.array(list(vecs), dtype=dtype) if len(vecs) else np.zeros((0, 0), dtype)


def best_per_query(hits: DataFrame, k: int) -> DataFrame:
    """(query_id, rank int, vec_id, score): the k largest scores of each query,
    ties to the smaller vec_id; a pair met more than once counts once."""
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
