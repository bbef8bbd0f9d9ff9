"""Bounded labelled samples for classifiers, and fold rules over document ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fanline.llm import common as c


def fold_is(id_col: str, folds: int, rest: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, equals ``rest``; a NULL id counts
    as belonging to it."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == rest, F.lit(True))


def drawn_rows(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    may_learn: Column,
    per_class: dict[int, int],
    max_chars: int = 50_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, dict[int, int]]:
    """(rows (id, nth, text, label), {label: rows that may be learned from}).

    At most ``per_class[label]`` ids of each class, those of the smallest id
    hashes, of texts up to ``max_chars`` characters: the sample is bounded
    whatever the size of the tables. It is a written table, so that texts stay
    out of the driver; nth numbers an id's rows by their texts. Class sizes count
    all labelled rows. Rows with a NULL id, text or label are never drawn; an id
    with several labels counts as its largest.
    """
    # column names of one's own: further columns of either table are not read
    known = (
        labels.select(F.col(id_col).alias(id_col), F.col(label_col).cast("int").alias("label"))
        .where(F.col(id_col).isNotNull() & F.col("label").isin(*per_class) & may_learn)
        .groupBy(id_col)
        .agg(F.max("label").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for label, n in per_class.items():
        part = known.where(F.col("label") == label).orderBy(F.xxhash64(id_col), id_col).limit(n)
        drawn = part if drawn is None else drawn.union(part)
    drawn = drawn.select(F.col(id_col).alias("id"), "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(
        F.length("text") <= max_chars
    )
    # the drawn ids are bounded by per_class, so they may be broadcast
    rows = texts.join(F.broadcast(drawn), "id").repartition(docs.sparkSession.sparkContext.defaultParallelism, "id")
    nth = F.row_number().over(Window.partitionBy("id").orderBy("text"))
    rows = c.materialise(rows.select("id", nth.alias("nth"), "text", "label"), "sample")
    return rows, {k: sizes.get(k, 0) for k in per_class}


def labelled_sample(*args, **kwargs) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """([(text, label)], {label: rows that may be learned from}): the rows of
    ``drawn_rows``, texts and all, in the order of their ids."""
    rows, sizes = drawn_rows(*args, **kwargs)
    drawn = rows.collect()
    drawn.sort(key=lambda r: (r["id"], r["nth"]))
    return [(r["text"], r["label"]) for r in drawn], sizes


def class_weights(sample: list[tuple[str, int]], sizes: dict[int, int]) -> dict[int, float]:
    """Weights that give the drawn classes the shares they have among all labels."""
    drawn = {k: sum(y == k for _, y in sample) for k in sizes}
    total, n = sum(sizes.values()) or 1, len(sample) or 1
    return {k: (sizes[k] / total) / (drawn[k] / n) if drawn[k] else 0.0 for k in sizes}
