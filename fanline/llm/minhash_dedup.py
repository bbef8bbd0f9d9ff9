"""Near-duplicate documents by tensored MinHash banding, links confirmed on full sets.

Method. Two small collections, A and B, of ``half`` half-keys each; a half-key
combines ``rows`` min-hashes. Table (i, j) is keyed by the pair (A_i, B_j), so
``half**2`` tables of ``2 * rows`` min-hashes each come from only
``2 * half * rows`` hash functions, about the square root of what separate
tables would need. A pair of similarity s meets in some table with probability
``(1 - (1 - s**rows)**half)**2``: 0.99998 at s = 0.85 for rows = 3, half = 12.
Every table counts, however crowded its buckets.

Plan.
1. One pass over the texts computes per row: set size, set digest, half-keys.
2. Rows with equal digests form a class; its smallest id stands for it.
3. Half-keys held by one class only are dropped (grouped count, combined on the
   map side). Of a half-key that many hold, all members meet one of them, drawn by
   hash. Half-keys whose members are all tied so are dropped as well, and those
   of a crowd with few others, which then meet all its members. Only the
   remaining half-keys of a class are paired into table keys, so documents without
   a partner, and crowds of near copies, cost a few rows each, not ``half**2``.
4. All pairs of a bucket whose min-hashes agree within five standard errors of
   the threshold are tied. A small bucket's pairs are compared inside its task.
   The members of a large one meet pivots of it first (about twice the square
   root of its size, drawn by hash); those that the ties so far leave outside its
   largest component then meet all members, block by block, so no pair is open
   whatever the size. Components of the ties are the candidate clusters; a
   cluster holds every pair that a bucket and that bound leave open.
5. Clusters are compared exactly: they are cut into blocks of bounded size, and
   a task counts the intersections of the full sets of two blocks with sparse
   and dense matrix steps. It returns the local components of the confirmed
   links, at most one row per document and cell, never the pairs.
6. Components of those rows are the result.
Nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm.components import connected_components

#: shingles whose min-hashes are computed at a time
CHUNK = 1 << 15
#: bounds of a block of a cluster: documents, and shingles of all of them together
BLOCK_ROWS = 1536
BLOCK_SHINGLES = 1 << 20
#: buckets beyond this size get several pivots and are compared in blocks
SMALL_BUCKET = 32
#: members of such a block
BUCKET_BLOCK = 4096


@dataclass(frozen=True)
class Similarity:
    """Link when ``100 * |intersection| >= percent * |union|`` of the sets of
    ``width``-word shingles; ``rows`` and ``half`` shape the tables."""

    width: int = 5
    percent: int = 80
    rows: int = 3
    half: int = 12

    @property
    def hashes(self) -> int:
        return 2 * self.half * self.rows

    @property
    def least_agreement(self) -> int:
        """Agreeing min-hashes below which a pair at the threshold falls with
        probability under 1e-5 (five standard errors)."""
        s, n = self.percent / 100, self.hashes
        return max(0, int(n * s - 5 * (n * s * (1 - s)) ** 0.5))


def signatures(sets: list[np.ndarray], sim: Similarity) -> np.ndarray:
    """Min-hashes (documents x hashes) of non-empty sets."""
    mult = c.seeds(sim.hashes, 11) | np.uint64(1)
    add = c.seeds(sim.hashes, 13)
    out = np.empty((len(sets), sim.hashes), np.uint64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= CHUNK):
            size += len(sets[end])
            end += 1
        part = sets[at:end]
        x = np.concatenate(part)
        if end == at + 1:
            for a in range(0, size, CHUNK):
                y = x[a : a + CHUNK]
                for k in range(sim.hashes):
                    least = (y * mult[k] + add[k]).min()
                    out[at, k] = least if a == 0 else min(out[at, k], least)
        else:
            starts = np.concatenate(([0], np.cumsum([len(s) for s in part[:-1]])))
            for k in range(sim.hashes):
                out[at:end, k] = np.minimum.reduceat(x * mult[k] + add[k], starts)
        at = end
    return out


def _half_keys(sig: np.ndarray, sim: Similarity) -> np.ndarray:
    """(documents x 2 * half) keys; key k combines ``rows`` min-hashes and k."""
    parts = sig.reshape(len(sig), 2 * sim.half, sim.rows)
    mult = c.seeds(sim.rows, 17) | np.uint64(1)
    acc = (parts * mult).sum(axis=2, dtype=np.uint64)
    return c.mix64(acc + c.seeds(2 * sim.half, 19))


def sketch(docs: DataFrame, id_col: str, text_col: str, sim: Similarity) -> DataFrame:
    """(id, n_shingles, digest binary, keys array<long>, agree binary) per row;
    keys and agree (one byte of every min-hash) are NULL for empty sets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in c.by_rows(frames, 2048):
            sets = [c.shingle_set(c.text_of(t), sim.width) for t in f["text"]]
            full = [k for k, s in enumerate(sets) if len(s)]
            digest: list = [None] * len(sets)
            keys: list = [None] * len(sets)
            agree: list = [None] * len(sets)
            if full:
                sig = signatures([sets[k] for k in full], sim)
                half = c.as_long(_half_keys(sig, sim))
                low = (c.mix64(sig) & np.uint64(255)).astype(np.uint8)
                for r, k in enumerate(full):
                    digest[k] = xxhash.xxh3_128_digest(sets[k].tobytes())
                    keys[k] = half[r]
                    agree[k] = low[r].tobytes()
            yield pd.DataFrame(
                {
                    "id": f["id"],
                    "no_id": f["no_id"],
                    "n_shingles": [len(s) for s in sets],
                    "digest": digest,
                    "keys": keys,
                    "agree": agree,
                }
            )

    # a NULL in an integer column would turn pandas' ids into doubles: a flag carries it
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = "id long, no_id boolean, n_shingles long, digest binary, keys array<long>, agree binary"
    return rows.mapInPandas(run, schema)


def _halves(classes: DataFrame) -> DataFrame:
    """(id, k, hk, n): the half-keys that n classes hold, two or more."""
    half = classes.select("id", F.posexplode("keys").alias("k", "hk"))
    shared = half.groupBy("hk").agg(F.count("*").alias("n")).where("n > 1")
    return c.materialise(c.join_by_keys(half, c.materialise(shared, "shared-halves"), "hk"), "halves")


def _crowd_ties(halves: DataFrame, info: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b): of each half-key that many classes hold, the class drawn by hash with
    those that agree with it. The draw does not depend on the half-key, so copies
    that share many half-keys meet the same few classes."""
    crowds = halves.where(F.col("n") > SMALL_BUCKET).select("hk", "id")
    drawn = crowds.groupBy("hk").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id"))["id"].alias("one"))
    pairs = crowds.join(c.materialise(drawn, "drawn"), "hk").where("id <> one").select("one", "id").distinct()
    own = info.select("id", "n_shingles", "agree")
    ones = own.toDF("one", "one_size", "one_agree")
    met = c.materialise(pairs, "crowd-pairs").join(own, "id").join(ones, "one")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            x, y = (np.frombuffer(b"".join(f[k]), np.uint8).reshape(len(f), -1) for k in ("agree", "one_agree"))
            same = (x == y).sum(axis=1) >= sim.least_agreement
            same &= _fits(f["n_shingles"].to_numpy(), f["one_size"].to_numpy(), sim)
            yield pd.DataFrame({"a": f["one"][same], "b": f["id"][same]})

    return met.mapInPandas(run, "a long, b long")


def _crowd_parts(halves: DataFrame, early: DataFrame, info: DataFrame, sim: Similarity) -> tuple[DataFrame, DataFrame]:
    """The open half-keys (id, k, hk, part), part being what ``early`` joins, and
    (a, b), further ties.

    A half-key is settled, and leaves, when no pair of two parts is open in it: all
    its members are of one part, or those of a crowd that are not (a few times the
    square root of its size at most) met all its members here.
    """
    parts = c.materialise(connected_components(early).toDF("id", "part"), "crowd-parts")
    named = halves.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
    named = c.materialise(named.select("id", "k", "hk", "part"), "part-halves")
    counts = named.groupBy("hk", "part").agg(F.count("*").alias("n"))
    outside = counts.groupBy("hk").agg(F.sum("n").alias("size"), (F.sum("n") - F.max("n")).alias("outside"))
    few = F.when(F.col("size") > SMALL_BUCKET, F.sqrt("size") * 4).otherwise(0)
    outside = c.materialise(outside.withColumn("settled", F.col("outside") <= few), "outside")
    crowds = named.join(outside.where("settled AND outside > 0").select("hk"), "hk")
    late = _stragglers(crowds.select(F.col("hk").alias("key"), "id", "part"), info, sim)
    return named.join(outside.where("NOT settled").select("hk"), "hk"), late


def _buckets(classes: DataFrame, sim: Similarity, halves: DataFrame | None = None) -> DataFrame:
    """(key, size, pivot, id): members of the tables that hold two parts or
    more, one of each set of tables with the same members; pivot is a member
    drawn by hash. ``halves``: (id, k, hk, part) of the half-keys to pair; without
    them those of two classes or more, each class a part."""
    met = _halves(classes).withColumn("part", F.col("id")) if halves is None else halves
    met = met.select("id", "part", F.struct("k", "hk").alias("h"))
    pairs = (
        met.groupBy("id", "part")
        .agg(F.collect_list("h").alias("hs"))  # at most 2 * half entries
        .select(
            "id",
            "part",
            F.filter("hs", lambda h: h["k"] < sim.half).alias("left"),
            F.filter("hs", lambda h: h["k"] >= sim.half).alias("right"),
        )
        .select("id", "part", F.explode("left").alias("l"), "right")
        .select("id", "part", "l", F.explode("right").alias("r"))
        .select(F.xxhash64("l.hk", "r.hk").alias("key"), "id", "part")
    )
    return open_buckets(c.materialise(pairs, "tables"))


def open_buckets(rows: DataFrame) -> DataFrame:
    """(key, size, pivot, id) of the rows (key, id, part): the keys that hold two
    parts or more, one of each set of keys with the same members."""
    met = rows.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("key")
    rows = c.materialise(c.join_by_keys(rows.select("key", "id"), c.materialise(met, "open-keys"), "key"), "open-rows")
    drawn = F.min(F.struct(F.xxhash64("id").alias("h"), "id"))
    kept = (
        rows.groupBy("key")
        .agg(F.count("*").alias("size"), F.min("id").alias("lo"), F.bit_xor(F.xxhash64("id")).alias("members"), drawn.alias("p"))
        .groupBy("size", "lo", "members")
        .agg(F.min(F.struct("key", F.col("p.id").alias("pivot"))).alias("one"))
        .select("one.key", "size", "one.pivot")
    )
    return c.materialise(c.join_by_keys(rows, c.materialise(kept, "keys"), "key"), "buckets")


def _bucket_ties(f: pd.DataFrame, sim: Similarity) -> pd.DataFrame:
    """(a, b): all pairs within the rows of a key are held to the size ratio and
    the agreement bound; each member of a component goes with its smallest id.

    f: (key, id, n_shingles, agree), sorted by key and id, whole buckets.
    """
    key, ids, size = f["key"].to_numpy(), f["id"].to_numpy(), f["n_shingles"].to_numpy()
    x = np.frombuffer(b"".join(f["agree"]), np.uint8).reshape(len(f), -1) if len(f) else np.zeros((0, 1), np.uint8)
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for gap in range(1, len(f)):
        i = np.flatnonzero(key[gap:] == key[:-gap])
        if not len(i):
            break
        j = i + gap
        fits = 100 * np.minimum(size[i], size[j]) >= sim.percent * np.maximum(size[i], size[j])
        i, j = i[fits], j[fits]
        same = (x[i] == x[j]).sum(axis=1) >= sim.least_agreement
        lefts.append(i[same])
        rights.append(j[same])
    left, right = np.concatenate(lefts), np.concatenate(rights)
    label = np.arange(len(f))
    while (label[left] != label[right]).any():
        least = np.minimum(label[left], label[right])
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
    moved = np.flatnonzero(label != np.arange(len(f)))
    return pd.DataFrame({"a": ids[label[moved]], "b": ids[moved]})


def local_components(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable over a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def ties(buckets: DataFrame, info: DataFrame, sim: Similarity, early: DataFrame | None = None) -> DataFrame:
    """(a, b): links that join what the agreement bound ties: all pairs of a bucket
    within the size ratio, and the ties ``early``, if any. Which way a bucket's pairs
    are found depends on its size, what they join does not."""
    least = sim.least_agreement
    small = c.materialise(buckets.where(F.col("size") <= SMALL_BUCKET).select("key", "id"), "small")
    small = small.join(info.select("id", "n_shingles", "agree"), "id").repartition("key").sortWithinPartitions("key", "id")

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # rows of the last bucket, which may go on in the next batch
        for f in frames:
            if not len(f):
                continue
            f = f if held is None else pd.concat([held, f], ignore_index=True)
            whole = int(np.searchsorted(f["key"].to_numpy(), f["key"].iloc[-1]))
            held = f.iloc[whole:]
            yield _bucket_ties(f.iloc[:whole], sim)
        if held is not None:
            yield _bucket_ties(held, sim)

    small = small.select("key", "id", "n_shingles", "agree").mapInPandas(pairs, "a long, b long")

    # large buckets: blocks of members, each with all pivots of its bucket
    large = c.materialise(buckets.where(F.col("size") > SMALL_BUCKET), "large")
    share = F.col("size").cast("double") ** -0.5 * 2
    # drawn alike in every bucket: members of many buckets keep few ties
    chosen = (F.col("id") == F.col("pivot")) | (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    blocks = F.ceil(F.col("size") / BUCKET_BLOCK).cast("long")
    each = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block")
    members = large.select("key", F.pmod(F.xxhash64("id", F.lit(3)), blocks).alias("block"), "id", F.lit(0).alias("role"))
    pivots = large.where(chosen).select("key", each, "id", F.lit(1).alias("role"))
    placed = c.materialise(members.union(pivots), "placed").join(info.select("id", "n_shingles", "agree"), "id")

    def tie(f: pd.DataFrame) -> pd.DataFrame:
        role = f["role"].to_numpy()
        ids, size = f["id"].to_numpy(), f["n_shingles"].to_numpy()
        small_size, piv_size = size[role == 0], size[role == 1]
        own, piv = ids[role == 0], ids[role == 1]
        agree = np.frombuffer(b"".join(f["agree"]), np.uint8).reshape(len(f), -1)
        x, p = np.ascontiguousarray(agree[role == 0].T), agree[role == 1]
        order = np.argsort(c.mix64(piv.view(np.uint64)), kind="stable")
        piv, piv_size, p = piv[order], piv_size[order], p[order]
        # forest over pivots and members: the first pivot tied to each member, in an
        # order that all buckets have, and the pivots tied through a member
        root = {int(v): int(v) for v in piv}

        def find(v: int) -> int:
            while root[v] != v:
                root[v] = v = root[root[v]]
            return v

        first = np.full(len(own), -1)
        a, b = [], []
        for k, v in enumerate(piv.tolist()):
            same = (x == p[k][:, None]).sum(axis=0, dtype=np.uint8 if sim.hashes < 256 else np.int32) >= least
            same &= (own != v) & _fits(small_size, piv_size[k], sim)
            new = same & (first < 0)
            first[new] = v
            a += [v] * int(new.sum())
            b += own[new].tolist()
            for u in np.unique(first[same & ~new]).tolist():
                if find(u) != find(v):
                    root[find(u)] = find(v)
                    a.append(u)
                    b.append(v)
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    big = placed.groupBy("key", "block").applyInPandas(tie, "a long, b long")
    known = small if early is None else small.union(early)
    if large.isEmpty():
        return known.distinct()
    found = c.materialise(known.union(big).distinct(), "ties")
    parts = connected_components(found).toDF("id", "part")
    named = large.select("key", "id").join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
    return found.union(_stragglers(c.materialise(named, "parts"), info, sim))


def _fits(sizes: np.ndarray, size: int, sim: Similarity) -> np.ndarray:
    """The size ratio, which every pair that is linked has."""
    return 100 * np.minimum(sizes, size) >= sim.percent * np.maximum(sizes, size)


def _stragglers(named: DataFrame, info: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b): the ties of large buckets (key, id, part) between two parts.

    Two members of one part need no further tie. Of a pair in two parts at least
    one member lies outside the bucket's largest one: those members, cut
    into chunks, meet the blocks of all members.
    """
    counts = named.groupBy("key", "part").agg(F.count("*").alias("n"))
    mains = counts.groupBy("key").agg(F.max(F.struct("n", "part")).alias("main"), F.sum("n").alias("size"))
    pieces = lambda n: F.ceil(n / BUCKET_BLOCK).cast("long")
    open_ = c.materialise(
        mains.where("main.n < size").select(
            "key", F.col("main.part").alias("main"), pieces(F.col("size")).alias("blocks"),
            pieces(F.col("size") - F.col("main.n")).alias("chunks"),
        ), "open",
    )
    rows = named.join(open_, "key")

    def deal(of: str, over: str, role: int, at: tuple[str, str]):
        own = F.pmod(F.xxhash64("id", F.lit(3)), of).alias(at[0])
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col(over) - 1)).alias(at[1])
        return ["key", own, each, "id", "part", F.lit(role).alias("role")]

    members = rows.select(*deal("blocks", "chunks", 0, ("block", "chunk")))
    outside = rows.where("part != main").select(*deal("chunks", "blocks", 1, ("chunk", "block")))
    cells = c.materialise(members.unionByName(outside), "stragglers")

    def tie(f: pd.DataFrame) -> pd.DataFrame:
        role, part, size = f["role"].to_numpy(), f["part"].to_numpy(), f["n_shingles"].to_numpy()
        agree = np.frombuffer(b"".join(f["agree"]), np.uint8).reshape(len(f), -1)
        x, own, sizes = np.ascontiguousarray(agree[role == 0].T), part[role == 0], size[role == 0]
        root: dict[int, int] = {}

        def find(v: int) -> int:
            while root.setdefault(v, v) != v:
                root[v] = v = root[root[v]]
            return v

        a, b = [], []
        for k in np.flatnonzero(role == 1):
            same = (x == agree[k][:, None]).sum(axis=0, dtype=np.int32) >= sim.least_agreement
            same &= (own != part[k]) & _fits(sizes, size[k], sim)
            for u in np.unique(own[same]).tolist():
                v = int(part[k])
                if find(u) != find(v):
                    root[find(u)] = find(v)
                    a.append(u)
                    b.append(v)
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    held = cells.join(info.select("id", "n_shingles", "agree"), "id")
    return held.groupBy("key", "block", "chunk").applyInPandas(tie, "a long, b long")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of sorted hash sets (left x right)."""
    out = np.zeros((len(left), len(right)), np.int32)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    vals = np.concatenate(left + right) if left or right else np.array([], np.uint64)
    order = np.argsort(vals, kind="stable")
    vals, rows = vals[order], rows[order]
    starts = np.flatnonzero(np.concatenate(([True], vals[1:] != vals[:-1]))) if len(vals) else np.array([], int)
    count = np.diff(np.append(starts, len(vals)))
    col = np.repeat(np.arange(len(starts)), count)
    of = count[col]
    # shingles of few sets: their pairs, by distance within the run of equal hashes
    few = np.flatnonzero((of > 1) & (of <= 8))
    r, k = rows[few], col[few]
    for gap in range(1, 8):
        same = k[gap:] == k[:-gap]
        i, j = r[:-gap][same], r[gap:][same]
        cross = (i < len(left)) & (j >= len(left))
        flat = np.bincount(i[cross] * len(right) + j[cross] - len(left), minlength=out.size) if cross.any() else 0
        out += np.asarray(flat, np.int32).reshape(out.shape) if np.ndim(flat) else 0
    # shingles of many sets: dense 0/1 columns, some thousands at a time
    many = np.flatnonzero(of > 8)
    _, dense = np.unique(col[many], return_inverse=True)
    r = rows[many]
    for a in range(0, int(dense.max(initial=-1)) + 1, 4096):
        lo, hi = np.searchsorted(dense, [a, a + 4096])
        m = np.zeros((len(left) + len(right), min(4096, int(dense[hi - 1]) - a + 1)), np.float32)
        m[r[lo:hi], dense[lo:hi] - a] = 1
        out += (m[: len(left)] @ m[len(left) :].T).astype(np.int32)
    return out


def _confirmed(ids: np.ndarray, side: np.ndarray, texts: list[str], sim: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id linked to it) within a cell of one or two blocks."""
    sets = [c.shingle_set(t, sim.width) for t in texts]
    size = np.array([len(s) for s in sets])
    left = np.flatnonzero(side == side.min())
    right = np.flatnonzero(side == side.max())
    inter = intersections([sets[k] for k in left], [sets[k] for k in right])
    union = size[left][:, None] + size[right][None, :] - inter
    linked = np.zeros((len(ids), len(ids)), bool)
    linked[np.ix_(left, right)] = 100 * inter.astype(np.int64) >= sim.percent * union
    linked |= linked.T
    label = local_components(linked)
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[moved]], ids[moved]


def confirmed_links(clusters: DataFrame, texts: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b): confirmed links that join each cluster's components.

    clusters: (id, cluster, n_shingles). The cells of a cluster are pairs of its
    blocks; a task streams over its sorted rows and holds one cell at a time.
    """
    sizes = clusters.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).cast("long").alias("blocks")
    )
    sizes = c.materialise(sizes, "sizes")
    placed = clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    cells = placed.select("id", "cluster", "block", other).select(
        "id", "cluster", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block"
    )
    work = c.materialise(cells, "cells").join(texts, "id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        cell = None

        def close() -> pd.DataFrame:
            ids = np.array([h[0] for h in held], np.int64)
            a, b = _confirmed(ids, np.array([h[1] for h in held]), [h[2] for h in held], sim)
            return pd.DataFrame({"a": a, "b": b})

        for f in frames:
            done = []
            for cl, x, y, block, id_, text in zip(
                f["cluster"], f["x"], f["y"], f["block"], f["id"], f["text"], strict=True
            ):
                if (cl, x, y) != cell:
                    if len(held) > 1:
                        done.append(close())
                    cell, held = (cl, x, y), []
                held.append((id_, block, text))
            if done:
                yield pd.concat(done)
        if len(held) > 1:
            yield close()

    ordered = work.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "id")
    return ordered.select("cluster", "x", "y", "block", "id", "text").mapInPandas(run, "a long, b long")


def link_components(classes: DataFrame, texts: DataFrame, sim: Similarity) -> DataFrame:
    """(id, component) of the classes linked to another one.

    classes: (id, n_shingles, keys, agree), ids unique; texts: (id, text).
    """
    halves = _halves(classes)
    held = c.materialise(halves.select("id").distinct(), "met")
    info = c.materialise(c.join_by_keys(classes.select("id", "n_shingles", "agree"), held, "id"), "info")
    early = c.materialise(_crowd_ties(halves, info, sim), "crowd-ties")
    if early.isEmpty():
        halves = halves.withColumn("part", F.col("id"))
    else:
        halves, late = _crowd_parts(halves, early, info, sim)
        early = early.union(c.materialise(late, "late-ties"))
    buckets = _buckets(classes, sim, halves)
    clusters = connected_components(ties(buckets, info, sim, early)).toDF("id", "cluster")
    clusters = c.materialise(clusters.join(info.select("id", "n_shingles"), "id"), "clusters")
    links = confirmed_links(clusters, c.join_by_keys(texts, clusters.select("id"), "id"), sim)
    return connected_components(links).toDF("id", "component")


def near_duplicates(
    docs: DataFrame, sim: Similarity, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Component of every document under the similarity ``sim``.

    Returns one row per input row: (id_col, n_shingles long, component_id long,
    kept boolean). component_id is the smallest id reachable over links,
    kept marks the document that stays. Defined results for odd rows:
    * NULL or empty text, or white space only: n_shingles 0, linked with nothing;
    * fewer words than the shingle width: the whole sequence is the one shingle;
    * NULL id: n_shingles is given, component_id is NULL, kept is true;
    * an id that repeats: its rows count as one document (one component, each row returned);
    * other columns are not read, whatever their names; an empty table gives no rows.
    """
    rows = c.materialise(sketch(docs, id_col, text_col, sim), "sketch")
    known = rows.where("NOT no_id AND digest IS NOT NULL")
    own = [F.first(x).alias(x) for x in ("n_shingles", "keys", "agree")]  # the same in all rows of a set
    classes = c.materialise(known.groupBy("digest").agg(F.min("id").alias("id"), *own), "classes")
    # an id with several texts stands for each of its classes; one row per id goes on
    lead = c.materialise(classes.dropDuplicates(["id"]).drop("digest"), "lead")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "id IS NOT NULL AND text IS NOT NULL"
    )
    labels = link_components(lead, texts, sim)
    rep = c.materialise(classes.select("digest", F.col("id").alias("rep")), "rep")
    out = (
        rows.select("id", "no_id", "n_shingles", "digest")
        .join(rep, "digest", "left")
        .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            F.when(~F.col("no_id"), F.col("id")).alias(id_col),
            "n_shingles",
            F.when(~F.col("no_id"), F.coalesce("component", "rep", "id")).alias("component_id"),
        )
    )
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
