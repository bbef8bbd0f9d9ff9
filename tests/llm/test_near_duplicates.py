"""op1: components equal a brute-force comparison of full shingle sets."""

import random

import numpy as np
import pytest
from llm_tools import components, shingles
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm import minhash_dedup as m
from fanline.llm.components import connected_components


def expected(rows, width, percent):
    known = {}
    for i, t in rows:
        if i is not None:
            known.setdefault(i, shingles(t, width))
    ids = sorted(known)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if known[a] and known[b] and 100 * len(known[a] & known[b]) >= percent * len(known[a] | known[b])
    ]
    return known, components(ids, links)


def families(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 30, 90, 200]))]
        for _ in range(rng.choice([1, 2, 9, 40])):
            t = list(base)
            for _ in range(rng.randrange(0, 6)):
                t[rng.randrange(len(t))] = f"v{rng.randrange(10**6)}"
            rows.append((n, " ".join(t)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(make_docs, odd_rows, width, percent):
    rows = odd_rows + [(1000 + i, t) for i, t in families(width)]
    known, want = expected(rows, width, percent)
    got = m.near_duplicates(make_docs(rows), m.Similarity(width, percent)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(known[r.doc_id]), want[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_large_buckets_and_several_blocks(make_docs, monkeypatch):
    """A crowded family, with bounds small enough that buckets and clusters are cut."""
    monkeypatch.setattr(m, "SMALL_BUCKET", 4)
    monkeypatch.setattr(m, "BLOCK_ROWS", 16)
    monkeypatch.setattr(m, "BUCKET_BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(120):
        t = list(base)
        for _ in range(i % 9):
            t[rng.randrange(len(t))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    _, want = expected(rows, 3, 85)
    got = {r.doc_id: r.component_id for r in m.near_duplicates(make_docs(rows), m.Similarity(3, 85)).collect()}
    assert got == want


def test_empty_table(make_docs):
    out = m.near_duplicates(make_docs([]), m.Similarity())
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_words_and_short_texts():
    assert c.ascii_words("A b É\x0bZ\x85q\tx") == ["a b".encode(), "É".encode(), "z\x85q".encode(), b"x"]
    assert len(c.shingle_set("a b", 3)) == 1 and len(c.shingle_set("", 3)) == 0
    assert c.shingle_set("a b", 3)[0] != c.shingle_set("b a", 3)[0]


def test_intersections_of_few_and_many():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64) * np.uint64(2**50)) for _ in range(30)]
    got = m.intersections(sets[:12], sets[12:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]).all()


def test_tables_meet_with_the_stated_probability():
    """Half-keys of random pairs at similarity 0.8 collide on both sides."""
    rng, sim, met = np.random.default_rng(2), m.Similarity(5, 80), 0
    for _ in range(150):
        both = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = np.append(both[:320], both[320:360]), np.append(both[:320], both[360:])
        k = m._half_keys(m.signatures([np.unique(a), np.unique(b)], sim), sim)
        same = k[0] == k[1]
        met += same[: sim.half].any() and same[sim.half :].any()
    assert met >= 147


def test_connected_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)]
    links += [(5, 5), (None, 3), (7, None)] + [(999, k) for k in range(500, 560)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = components({x for e in real for x in e}, real)
    assert got == want
    assert connected_components(df.where(F.lit(False))).count() == 0


def test_long_pair_among_many_shortened_copies(spark):
    """Small buckets: a pair is tied whichever member the bucket draws as pivot."""
    rng, sim = np.random.default_rng(5), m.Similarity(5, 80, half=18)
    rows, pairs = [], []
    for k in range(40):
        line = rng.integers(0, 2**63, 60).astype(np.uint64)
        near = np.append(line[:57], rng.integers(0, 2**63, 3).astype(np.uint64))
        sets = [line, near] + [line[rng.permutation(60)[:46]] for _ in range(28)]
        agree = (c.mix64(m.signatures([np.unique(x) for x in sets], sim)) & np.uint64(255)).astype(np.uint8)
        ids = [100 * k + i for i in range(30)]
        rows += [(k, 30, ids[2], i, len(x), bytearray(a.tobytes())) for i, x, a in zip(ids, sets, agree, strict=True)]
        pairs.append((ids[0], ids[1]))
    df = spark.createDataFrame(rows, "key long, size long, pivot long, id long, n_shingles long, agree binary")
    found = connected_components(m.ties(df.select("key", "size", "pivot", "id"), df.select("id", "n_shingles", "agree"), sim))
    label = {r.node: r.component for r in found.collect()}
    assert all(a in label and label[a] == label.get(b) for a, b in pairs)


def test_links_do_not_depend_on_the_size_of_a_bucket(spark, monkeypatch):
    """What the agreement bound ties, and so the components, is the same whether a
    bucket's pairs are compared in its task or by pivots and stragglers in blocks."""
    from fanline.llm import minhash_dedup as md

    sim = md.Similarity(width=3, percent=85)
    rng = np.random.default_rng(5)
    n, kinds = 90, 30  # one bucket of 30 kinds, three near copies of each
    base = rng.integers(0, 256, (kinds, sim.hashes))
    rows = []
    for i in range(n):
        agree = base[i % kinds].copy()
        agree[rng.choice(sim.hashes, 4, replace=False)] = rng.integers(0, 256, 4)
        rows.append((i, 100, bytes(agree.astype(np.uint8).tolist())))
    info = spark.createDataFrame(rows, "id long, n_shingles long, agree binary")
    buckets = spark.createDataFrame([(1, n, 0, i) for i in range(n)], "key long, size long, pivot long, id long")

    def joined():
        found = md.connected_components(md.ties(buckets, info, sim)).collect()
        return {tuple(r) for r in found}

    want = {(i, i % kinds) for i in range(n)}
    assert joined() == want  # larger than SMALL_BUCKET
    monkeypatch.setattr(md, "BUCKET_BLOCK", 20)
    assert joined() == want
    monkeypatch.setattr(md, "SMALL_BUCKET", n)
    assert joined() == want


def test_crowded_buckets_count_in_every_table(spark):
    """A crowd that shares one pair of half-keys meets, whichever pair it is."""
    from fanline.llm import minhash_dedup as md

    sim = md.Similarity(width=3, percent=85)
    crowd = md.SMALL_BUCKET + 8
    for i, j in ((0, 0), (0, 11), (3, 9), (7, 2)):
        keys = [[1000 * r + k for k in range(2 * sim.half)] for r in range(1, crowd + 1)]
        for row in keys:
            row[i], row[sim.half + j] = 1, 2
        classes = spark.createDataFrame(list(enumerate(keys)), "id long, keys array<long>")
        assert md._buckets(classes, sim).select("id").distinct().count() == crowd, (i, j)

def test_crowds_of_near_copies_cost_a_few_rows_each(make_docs, monkeypatch):
    """A crowd and some strangers that share words with it: no class is spread over all
    tables, and components equal brute force."""
    written = {}
    real = c.materialise

    def materialise(df, label):
        out = real(df, label)
        written[label] = max(written.get(label, 0), out.count())
        return out

    monkeypatch.setattr(c, "materialise", materialise)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(i % 3 if i % 20 else 25):
            t[rng.randrange(len(t))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    _, want = expected(rows, 5, 80)
    got = {r.doc_id: r.component_id for r in m.near_duplicates(make_docs(rows), m.Similarity(5, 80)).collect()}
    assert got == want
    assert written["tables"] < 40 * len(rows)  # 144 tables


def test_rows_split_by_keys(spark, monkeypatch):
    keys = spark.createDataFrame([(7 * k,) for k in range(300)], "id long")
    rows = spark.createDataFrame([(k, "x", "y") for k in range(3000)] + [(None, "x", "y")], "key long, __at string, __BITS string")
    for words, most in ((1 << 20, 700), (1, 3001)):
        monkeypatch.setattr(c, "FILTER_WORDS", words)
        near, rest = c.split_by_keys(rows, F.col("key"), keys, "id")
        assert near.columns == rest.columns == rows.columns
        a, b = ([r.key for r in x.collect()] for x in (near, rest))
        assert sorted(a + b, key=str) == sorted([*range(3000), None], key=str)
        assert {7 * k for k in range(300)} <= set(a) and len(a) <= most
    near, rest = c.split_by_keys(rows, F.col("key"), keys.limit(0), "id")
    assert near.count() == 0 and rest.count() == 3001
