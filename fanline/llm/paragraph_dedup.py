"""Repeated passages: paragraph MinHash banding, exact Jaccard, removal by components.

A document's paragraphs are its lines. Paragraphs of at least ``min_words``
words are sketched: min-hashes of their word shingles in ``bands`` bands of
``rows`` hashes, with as many bands as the wanted recall at the threshold
takes. Paragraphs with the same shingle set form a class. Classes that collide
in a band are tied and compared on their full sets (the exact cell comparison
shared with the document operator), and the confirmed links' components are
the groups of repeats. The first paragraph of a group, by (id, position),
stays; the others leave their documents.

Passages that are no line of their own (inside longer lines, in texts of one
line, over several short lines) are then taken out of what is left: every word
of a window of ``running`` words in a row that an earlier place holds too
(:mod:`fanline.llm.running_passages`), whatever the lines.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm.components import connected_components
from fanline.llm.minhash_dedup import Similarity, confirmed_links, open_buckets, signatures, ties
from fanline.llm.running_passages import repeated_windows, without_windows


@dataclass(frozen=True)
class PassageRule:
    """Paragraphs of ``min_words`` or more repeat when the Jaccard similarity of
    their ``width``-word shingles is ``percent`` or more; bands are tuned so
    that a pair at the threshold collides with probability ``recall``. After
    that, ``running`` words in a row repeat wherever lines break (at most 64; 0:
    paragraphs only)."""

    min_words: int = 20
    width: int = 5
    percent: int = 80
    rows: int = 3
    recall: float = 0.9998
    running: int = 0

    @property
    def bands(self) -> int:
        meet = (self.percent / 100) ** self.rows
        return math.ceil(math.log(1 - self.recall) / math.log(1 - meet))

    @property
    def similarity(self) -> Similarity:
        """The same threshold for the shared steps; its hash count is a multiple
        of the bands' (fingerprints hold one byte per hash)."""
        return Similarity(self.width, self.percent, self.rows, -(-self.bands // 2))


def _band_keys(sig: np.ndarray, rule: PassageRule) -> np.ndarray:
    n = rule.bands * rule.rows
    parts = sig[:, :n].reshape(len(sig), rule.bands, rule.rows)
    acc = (parts * (c.seeds(rule.rows, 31) | np.uint64(1))).sum(axis=2, dtype=np.uint64)
    return c.mix64(acc + c.seeds(rule.bands, 37))


def sketch_paragraphs(docs: DataFrame, rule: PassageRule, id_col: str, text_col: str) -> DataFrame:
    """(doc, pos, h, n_shingles, digest, keys, agree) of every paragraph of
    ``min_words`` words or more; h is Spark's xxhash64 of the line."""
    sim = rule.similarity

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in c.by_rows(frames, 512):
            doc, pos, h, sets = [], [], [], []
            for id_, text in zip(f["id"], f["text"], strict=True):
                for k, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                    words = line.lower().split()
                    if len(words) >= rule.min_words:
                        doc.append(id_)
                        pos.append(k)
                        h.append(xxhash.xxh64_intdigest(line, seed=42))
                        x = np.sort(c.shingle_hashes(c.word_hashes(words), rule.width))
                        sets.append(x[np.append(True, x[1:] != x[:-1])])
            if not doc:
                continue
            sig = signatures(sets, sim)
            yield pd.DataFrame(
                {
                    "doc": doc,
                    "pos": pos,
                    "h": c.as_long(np.array(h, np.uint64)),
                    "n_shingles": [len(s) for s in sets],
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "keys": list(c.as_long(_band_keys(sig, rule))),
                    "agree": [x.tobytes() for x in (c.mix64(sig) & np.uint64(255)).astype(np.uint8)],
                }
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc long, pos int, h long, n_shingles long, digest binary, keys array<long>, agree binary"
    return rows.where("id IS NOT NULL AND text IS NOT NULL").mapInPandas(run, schema)


def _lines_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) of wanted paragraphs (id, doc, pos, h)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("whole"))
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("id", "pos", "h")).alias("lines"))
    met = c.join_by_keys(texts, c.materialise(per_doc, "wanted"), "doc").withColumn("parts", F.split("whole", "\n"))
    each = met.select("parts", F.explode("lines").alias("l")).select(
        "l.id", "l.h", F.try_element_at("parts", F.col("l.pos") + 1).alias("text")
    )
    return each.where(F.xxhash64("text") == F.col("h")).select("id", "text")


def repeated_paragraphs(
    docs: DataFrame, rule: PassageRule = PassageRule(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc long, pos int, h long, first_doc long, first_pos int): paragraphs to
    remove, with the place of the one that stays."""
    rows = c.materialise(sketch_paragraphs(docs, rule, id_col, text_col), "paragraphs")
    first = F.min(F.struct("doc", "pos", "h")).alias("first")
    own = [F.first(x).alias(x) for x in ("n_shingles", "keys", "agree")]  # the same for a set
    classes = rows.groupBy("digest").agg(first, F.count("*").alias("n"), *own)
    # ids are fixed by writing the table
    classes = c.materialise(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    buckets = open_buckets(classes.select(F.explode("keys").alias("key"), "id", F.col("id").alias("part")))
    met = c.materialise(buckets.select("id").distinct(), "met")
    info = c.join_by_keys(classes.select("id", "n_shingles", "agree", "first"), met, "id")
    info = c.materialise(info, "info")
    clusters = connected_components(ties(buckets, info, rule.similarity)).toDF("id", "cluster")
    clusters = c.materialise(clusters.join(info.drop("agree"), "id"), "clusters")
    lines = _lines_of(docs, clusters.select("id", "first.doc", "first.pos", "first.h"), id_col, text_col)
    links = confirmed_links(clusters.drop("first"), lines, rule.similarity)
    grouped = c.materialise(connected_components(links).toDF("id", "component"), "grouped")
    # the first paragraph of every group; single classes matter only if copied
    near, single = c.split_by_keys(classes.select("id", "digest", "first", "n"), F.col("id"), grouped, "id")
    named = near.join(grouped, "id", "left").withColumn("grp", F.coalesce("component", "id")).drop("component")
    named = c.materialise(named.union(single.where("n > 1").withColumn("grp", F.col("id"))), "named")
    firsts = named.groupBy("grp").agg(F.min("first").alias("stays"), F.sum("n").alias("n")).where("n > 1").drop("n")
    groups = c.materialise(named.join(c.materialise(firsts, "firsts"), "grp").select("digest", "stays"), "groups")
    found = c.join_by_keys(rows.select("doc", "pos", "h", "digest"), groups, "digest")
    gone = found.where("NOT (doc = stays.doc AND pos = stays.pos AND h = stays.h)")
    return gone.select("doc", "pos", "h", F.col("stays.doc").alias("first_doc"), F.col("stays.pos").alias("first_pos"))


def remove_repeats(
    docs: DataFrame, rule: PassageRule = PassageRule(running=50), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with repeated paragraphs and running words taken out of the text
    column, and a column ``n_removed`` (long, paragraphs and runs; it replaces a
    column of that name).

    Every row stays, other columns unchanged, whatever their names. Defined
    results: NULL ids and NULL or empty texts stay as they are, with n_removed 0;
    paragraphs of fewer than ``min_words`` words stay, but for words of a
    repeated run; a text all of whose paragraphs go becomes empty; rows that
    repeat an id count as one document, so their equal paragraphs and runs at the
    same place stay in each; a run that comes about only because words between
    its parts went stays; an empty table gives no rows.
    """
    of, places, runs = c.fresh_names(docs, "__doc", "__gone", "__runs")

    def per_doc(found: DataFrame, name: str) -> DataFrame:
        return found.groupBy(F.col("doc").alias(of)).agg(F.collect_set(F.struct("pos", "h")).alias(name))

    cuts = c.materialise_alone(lambda: per_doc(repeated_paragraphs(docs, rule, id_col, text_col), places), "gone")

    def changed(cuts: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Only documents that may have cuts are joined with them."""
        key = F.col(id_col).cast("long")
        near, rest = c.split_by_keys(docs, key, cuts, of)
        out = change(near.join(cuts, key == F.col(of), "left"))
        names = [x for x in docs.columns if x != "n_removed"]
        rest = rest.select(*names, F.lit(0).cast("long").alias("n_removed"))
        return out.select(*names, "n_removed").union(rest)

    out = changed(cuts, lambda near: _without_paragraphs(near, places, text_col))
    if not rule.running:
        return out
    texts = out.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("doc IS NOT NULL AND text IS NOT NULL")
    found = c.materialise_alone(
        lambda: per_doc(repeated_windows(c.materialise(texts, "left"), rule.running), runs), "runs"
    )
    cuts = c.materialise(cuts.join(found, of, "full"), "cuts")
    return changed(
        cuts, lambda near: _without_runs(_without_paragraphs(near, places, text_col), runs, rule.running, text_col)
    )


def _without_paragraphs(docs: DataFrame, places: str, text_col: str) -> DataFrame:
    """``docs`` without the lines at the places of column ``places``; n_removed counts them."""
    stays = F.filter(
        F.split(F.col(text_col), "\n"),
        lambda x, i: ~F.array_contains(F.col(places), F.struct(i.alias("pos"), F.xxhash64(x).alias("h"))),
    )
    n = F.size(F.split(F.col(text_col), "\n")) - F.size(stays)
    cut = F.col(places).isNotNull()
    out = docs.withColumn("n_removed", F.when(cut, n).otherwise(0).cast("long"))
    return out.withColumn(text_col, F.when(cut, F.array_join(stays, "\n")).otherwise(F.col(text_col)))


def _without_runs(docs: DataFrame, runs: str, length: int, text_col: str) -> DataFrame:
    """``docs`` without the windows of ``length`` words in column ``runs``; n_removed counts them."""
    (trimmed,) = c.fresh_names(docs, "__cut")

    @F.pandas_udf("text string, n long")
    def trim(text: pd.Series, pos: pd.Series, h: pd.Series) -> pd.DataFrame:
        done = [
            (None, 0) if t is None or p is None else without_windows(t, np.asarray(p), np.asarray(x), length)
            for t, p, x in zip(text, pos, h, strict=True)
        ]
        return pd.DataFrame(done, columns=["text", "n"])

    cut = F.col(runs).isNotNull()
    docs = docs.withColumn(trimmed, trim(F.when(cut, F.col(text_col)), F.col(runs)["pos"], F.col(runs)["h"]))
    docs = docs.withColumn("n_removed", F.col("n_removed") + F.when(cut, F.col(trimmed)["n"]).otherwise(0))
    return docs.withColumn(text_col, F.when(cut, F.col(trimmed)["text"]).otherwise(F.col(text_col)))
