"""Source divergence audit: term statistics by chunk factorization.

Texts are cut at ASCII white space into chunks, which no term crosses. Scan
tasks count the chunks of each document; a bundle of documents (bounded text)
numbers its chunks, and its documents become packed chunk numbers and counts.
The bundles' chunks are written bucketed by chunk, so that each globally
distinct chunk is cut into terms once and its terms are joined back to all
bundles that hold it without another shuffle of chunks. Documents and
occurrences then add up per bundle in number arrays: neither texts nor
(document, chunk) pairs are ever shuffled as strings.

A term has at most as many documents as its chunks together, so the terms that
cannot reach the required number leave before they are joined back; the exact
number of distinct documents of a language is counted after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fanline.llm import common as c

#: characters of text in a bundle; a single longer document makes one of its own
BUNDLE_CHARS = 32_000_000
#: terms and sources (of either side) in one group of pairwise sums
BLOCK_TERMS, TILE_SOURCES = 1024, 128
# fixed values: the letters that are lower-cased, the runs that are terms, the scale and prior of p
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SCALE, PRIOR = 1_000_000_000, 5

#: rows of documents (codes, counts) and rows of a bundle's chunks (code, chunk, docs)
BUNDLE_SCHEMA = "bundle long, lang string, source string, codes binary, counts binary, code int, chunk string, docs long"


class Codes(dict):
    """Numbers things in the order in which they are first met."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def packed(x: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane: planes of small numbers are all zero."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Bundle:
    def __init__(self, number: int):
        self.number, self.chunks, self.docs, self.found, self.chars = number, Codes(), [], [], 0

    def add(self, text: str, lang: str, source: str) -> None:
        words = text.encode("utf-8").split()  # at x20 and x09-x0D
        at, n = np.unique(np.fromiter(map(self.chunks.__getitem__, words), np.int32, len(words)), return_counts=True)
        self.docs.append((lang, source, packed(np.diff(at, prepend=0)), packed(n)))
        self.found.append(at)
        self.chars += len(text)

    def frames(self) -> Iterator[pd.DataFrame]:
        names = BUNDLE_SCHEMA.replace(",", "").split()[::2]
        rows = [(self.number, *d, None, None, None) for d in self.docs]
        yield pd.DataFrame(rows, columns=names, dtype=object)
        held = np.bincount(np.concatenate(self.found), minlength=len(self.chunks))
        none = np.full(len(held), None, object)
        words = np.array([w.decode("utf-8") for w in self.chunks], object)
        yield c.frame(
            {"bundle": np.full(len(held), self.number), "lang": none, "source": none, "codes": none, "counts": none,
             "code": np.arange(len(held), dtype=np.int32), "chunk": words, "docs": held}
        )


def count_chunks(docs: DataFrame, bundle_chars: int = BUNDLE_CHARS) -> DataFrame:
    """Rows of ``BUNDLE_SCHEMA`` for ``docs`` (text, lang, source without NULLs)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = Bundle(TaskContext.get().partitionId() << 32)
        for b in batches:
            for text, lang, source in zip(b["text"], b["lang"], b["source"]):
                bundle.add(text, lang, source)
                if bundle.chars >= bundle_chars:
                    yield from bundle.frames()
                    bundle = Bundle(bundle.number + 1)
        if bundle.docs:
            yield from bundle.frames()

    return docs.mapInPandas(run, BUNDLE_SCHEMA)


def terms_of(chunk: Column) -> Column:
    """The terms of a chunk, in order, repeats included."""
    return F.regexp_extract_all(F.translate(chunk, UPPER, LOWER), F.lit(TERM), F.lit(0))


def _add_up(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Documents and occurrences of each (group, term) of one bundle.

    docs: g, codes, counts; known: code, id, a row for each time that
    term ``id`` stands in chunk ``code``."""
    if not len(docs) or not len(known):
        return pd.DataFrame(columns=["g", "id", "docs", "n"])
    code = known["code"].to_numpy()
    order = np.argsort(code, kind="stable")
    terms, ids = pd.factorize(known["id"].to_numpy()[order])
    each = [np.cumsum(unpacked(x)) for x in docs["codes"]]
    sizes = np.array([len(x) for x in each])
    codes, counts = np.concatenate(each), np.concatenate([unpacked(x) for x in docs["counts"]])
    starts = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=int(codes.max(initial=0)) + 1))))
    reach = starts[codes + 1] - starts[codes]
    # one cell per document, chunk and term of the chunk
    cell = np.repeat(starts[codes] - np.concatenate(([0], np.cumsum(reach)[:-1])), reach) + np.arange(reach.sum())
    doc = np.repeat(np.repeat(np.arange(len(docs)), sizes), reach)
    per_doc, back = np.unique(doc * len(ids) + terms[cell], return_inverse=True)
    n = np.bincount(back, weights=np.repeat(counts, reach), minlength=len(per_doc))
    group, groups = pd.factorize(docs["g"].to_numpy())
    key, back = np.unique(group[per_doc // len(ids)] * len(ids) + per_doc % len(ids), return_inverse=True)
    return c.frame(
        {
            "g": groups[key // len(ids)],
            "id": ids[key % len(ids)],
            "docs": np.bincount(back, minlength=len(key)),
            "n": np.bincount(back, weights=n, minlength=len(key)).astype(np.int64),
        }
    )


@contextmanager
def bucketed(df: DataFrame, column: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder in buckets of ``column``: aggregations and
    joins on it read a bucket each and need no shuffle. The table's name goes at the
    end; its files stay in the shared folder."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"fanline_buckets_{uuid.uuid4().hex}"
    # the same hash deals rows to tasks and to buckets: one file each
    spread = df.repartition(n, column)
    spread.write.option("path", c.shared_path(spark, "buckets")).option("compression", "zstd").bucketBy(n, column).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def term_counts(docs: DataFrame, least_docs: int = 30, bundle_chars: int = BUNDLE_CHARS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, groups, terms) of ``docs`` (text, lang, source).

    cells: g, lang, source, id, docs, n (occurrences) for all terms that may stand in
    ``least_docs`` documents; groups: g and every (lang, source) that occurs; terms:
    id, term. NULL text, lang and source count as empty, every row is a document, and
    other columns are not read; an empty table has neither cells nor groups.
    """
    full = docs.select(*(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("text", "lang", "source")))
    bundles = c.materialise(count_chunks(full, bundle_chars), "bundles")
    counted = bundles.where("codes IS NOT NULL").select("bundle", "lang", "source", "codes", "counts")
    groups = counted.select("lang", "source").distinct()
    groups = c.materialise(groups.select(F.monotonically_increasing_id().alias("g"), "lang", "source"), "groups")
    of = groups.select("g", F.col("lang").alias("l"), F.col("source").alias("s"))
    numbered = counted.join(of, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s"))).select("bundle", "g", "codes", "counts")
    with bucketed(bundles.where("codes IS NULL").select("bundle", "code", "chunk", "docs"), "chunk") as chunks:
        distinct = chunks.groupBy("chunk").agg(F.sum("docs").alias("docs"))
        held = c.materialise(distinct.select("chunk", F.explode(terms_of(F.col("chunk"))).alias("term"), "docs"), "chunk-terms")
        may = held.groupBy("term").agg(F.sum("docs").alias("most")).where(F.col("most") >= least_docs)
        terms = c.materialise(may.select(F.monotonically_increasing_id().alias("id"), "term"), "terms")
        known = held.join(terms, "term").select(F.col("chunk").alias("of_chunk"), "id")
        back = chunks.join(known, F.col("chunk") == F.col("of_chunk")).select(F.col("bundle").alias("of_bundle"), "code", "id")
        cells = (
            numbered.groupBy("bundle")
            .cogroup(back.groupBy("of_bundle"))
            .applyInPandas(_add_up, "g long, id long, docs long, n long")
            .groupBy("g", "id")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
        )
        cells = c.materialise(cells, "term-counts")
    return cells.join(groups, "g"), groups, terms


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exactly."""
    top = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    low = (total + F.lit(PRIOR) * terms).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, low)


def _pair_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """What a block of terms adds to the pairs of its sources, beyond the difference
    that two sources have on a term that neither holds.

    rows: source, side, p, base (p at count 0), terms (of the language, in block 0
    only, else 0), id; a row with id -1 stands for the source itself."""
    own = rows[rows["id"] < 0]
    sources, base = own["source"].to_numpy(object), own["base"].to_numpy(np.int64)
    cells = rows[rows["id"] >= 0]
    term, names = pd.factorize(cells["id"].to_numpy())
    at = pd.Index(own["source"]).get_indexer(cells["source"])
    p = np.repeat(base[:, None], len(names), 1)
    p[at, term] = cells["p"].to_numpy(np.int64)
    side = own["side"].to_numpy()
    terms = int(rows["terms"].max())
    a, b, v = [], [], []
    for i in range(len(sources)):
        # within a tile every pair once, between two tiles left with right
        other = np.flatnonzero(side == 1) if side.max() == 1 else np.arange(i + 1, len(sources))
        if side[i] == 0 and len(other):
            apart = np.abs(base[other] - base[i])
            a += [sources[i]] * len(other)
            b += list(sources[other])
            v += list(np.abs(p[other] - p[i]).sum(1) + (terms - len(names)) * apart)
    lang = np.full(len(a), rows["lang"].iloc[0], object)
    return c.frame({"lang": lang, "a": np.array(a, object), "b": np.array(b, object), "value": np.array(v, np.int64)})


def source_pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for both orders of any two sources of a language.

    cells: lang, source, id, p; groups: lang, source, base, terms, sources."""
    hashed = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS)))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("sources") / TILE_SOURCES)).cast("int")
    tiled = groups.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    of = tiled.select(F.col("lang").alias("l"), F.col("source").alias("s"), "base", "terms", "tiles", "tile")
    held = cells.join(of, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s"))).withColumn("block", hashed)
    held = held.select("lang", "source", "id", "p", "base", F.lit(0).cast("long").alias("terms"), "block", "tiles", "tile")
    blocks = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS)).cast("long") - 1)
    own = tiled.withColumn("block", F.explode(blocks)).select(
        "lang", "source", F.lit(-1).cast("long").alias("id"), F.col("base").alias("p"), "base",
        F.when(F.col("block") == 0, F.col("terms")).otherwise(F.lit(0)).cast("long").alias("terms"), "block", "tiles", "tile",
    )
    # a tile meets every tile of its language, once each
    met = held.unionByName(own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.select(
        "lang", "source", "id", "p", "base", "terms", "block",
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), (F.col("tile") > F.col("other")).cast("int").alias("side"),
    )
    sums = met.groupBy("lang", "low", "high", "block").applyInPandas(_pair_sums, "lang string, a string, b string, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return sums.select("lang", both.alias("pair"), "value").select("lang", "pair.source", "pair.item", "value")


def divergence_audit(docs: DataFrame, least_docs: int = 30, top_terms: int = 50, bundle_chars: int = BUNDLE_CHARS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair``, the summed difference
    of a source's term shares to every other source of the language; part ``term``,
    the terms by which a source exceeds its language most, to rank ``top_terms``.

    See ``term_counts`` for odd rows. A language without kept terms gives its pairs
    with value 0, a language with one source no pairs; ties go to the smaller item.
    """
    counts, groups, terms = term_counts(docs, least_docs, bundle_chars)
    kept = counts.groupBy("lang", "id").agg(F.sum("docs").alias("in_docs"), F.sum("n").alias("lang_n")).where(F.col("in_docs") >= least_docs)
    kept = c.materialise(kept.select("lang", "id", "lang_n"), "kept-terms")
    cells = counts.select("lang", "source", "id", "n").join(kept, ["lang", "id"])
    cells = c.materialise(cells, "kept-cells")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = F.lit(0).cast("long")
    full = groups.drop("g").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sources, "lang")
    full = full.select(
        "lang", "source", "sources", *(F.coalesce(x, zero).alias(x) for x in ("total", "terms", "lang_total")),
    ).withColumn("base", F.when(F.col("terms") > 0, share(zero, F.col("total"), F.col("terms"))).otherwise(zero))
    full = c.materialise(full, "group-totals")
    of = full.select(F.col("lang").alias("l"), F.col("source").alias("s"), "total", "terms", "lang_total")
    shares = cells.join(of, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s"))).select(
        "lang", "source", "id",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    pairs = source_pairs(shares.select("lang", "source", "id", "p"), full.select("lang", "source", "base", "terms", "sources"))
    names = terms.select(F.col("id").alias("of"), F.col("term").alias("item"))
    over = shares.where("p > q").join(names, F.col("id") == F.col("of"))
    over = over.select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", rank)
    over = over.withColumn("part", F.lit("term")).withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return pairs.select(*columns).unionByName(over.select(*columns))
