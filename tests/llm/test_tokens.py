"""op7, op9, op10: ids equal the library's, round trips, packing rules, sampling weights."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from fanline.llm import common as c
from fanline.llm import piece_sampling as ps
from fanline.llm import tokens
from fanline.llm.packing import PackingRule, pack, pack_block
from fanline.llm.wavelet import WaveletMatrix, read_documents, write_shards


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_path())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TEXTS = [
    "It's THE we've 12 ½ x² naïve Ünï-cödé don't!!! a--b 'S",
    "<|endoftext|> a<|startoftext|>b <| endoftext|>",
    "tabs\tand\x0bvt\x1c\x85 nbsp x   z",
    "İstanbul ΣΑΣ ŉ ǅ é ﬁ 漢字 עברית 𝄞 ﻿",
    "",
    "  ",
]


def test_word_encoder_equals_the_library(library):
    enc = tokens.encoder(tokens.default_path())
    assert enc.plain
    for t in TEXTS:
        assert enc.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids + [tokens.END_ID]
    assert enc.encode(None).tolist() == [tokens.END_ID]


def test_wavelet_matrix_operations():
    rng = np.random.default_rng(1)
    for n, bits in itertools.product((0, 1, 63, 64, 65, 700), (1, 6)):
        x = rng.integers(0, min(50, 1 << bits), n).astype(np.uint16)
        w = WaveletMatrix.from_bytes(WaveletMatrix.build(x, bits).to_bytes())
        assert (w.to_ids() == x).all() and [w.access(k) for k in range(n)] == x.tolist()
        for v in range(min(50, 1 << bits)):
            at = np.flatnonzero(x == v)
            assert w.count(v) == len(at)
            assert [w.select(v, k) for k in range(len(at))] == at.tolist()
            assert [w.rank(v, int(p)) for p in at] == list(range(len(at)))
        assert w.count(1 << bits) == 0
        with pytest.raises(IndexError):
            w.access(n)


def test_shards_round_trip(spark, make_docs, odd_rows, library):
    rows = odd_rows + [(2000 + k, t) for k, t in enumerate(TEXTS)]
    path = c.shared_path(spark, "test-shards")
    write_shards(make_docs(rows), path, shard_ids=500)
    got = read_documents(spark, path).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for r, (i, t) in zip(got, order, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.token_ids) == (i, at, len(ids), crc(ids), ids)
        at += len(ids)
    empty = c.shared_path(spark, "test-shards")
    write_shards(make_docs([]), empty)
    assert read_documents(spark, empty).count() == 0


def test_packing_covers_every_id_once(make_docs, odd_rows, library):
    got = pack(make_docs(odd_rows), PackingRule(capacity=64, block_tokens=5000)).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert crc(r.token_ids) == r.ids_crc32 and len(r.token_ids) == r.length
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    want = collections.Counter()
    for i, t in odd_rows:
        want[i] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    assert {i: sum(r.length for r in v) for i, v in by_doc.items()} == dict(want)
    for i, t in odd_rows:
        if i in (None, 3):  # ids of several rows
            continue
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert [r.start for r in parts] == [0, *itertools.accumulate(r.length for r in parts)][:-1]
        joined = [x for r in parts for x in r.token_ids]
        assert joined == library.encode(t or "", add_special_tokens=False).ids + [1]
        assert {r.doc_tokens for r in parts} == {len(joined)}
    for v in by_seq.values():
        v.sort(key=lambda r: r.offset)
        total = sum(r.length for r in v)
        assert [r.offset for r in v] == [0, *itertools.accumulate(r.length for r in v)][:-1]
        assert total == 64 or total & (total - 1) == 0
    assert pack(make_docs([])).count() == 0


def test_blocks_fill_and_balance():
    rng = np.random.default_rng(3)
    rule = PackingRule()
    lengths = [int(x) for x in np.exp(rng.normal(5.5, 1.2, 3000)).astype(int) + 1]
    out = pack_block(lengths, rule)
    seen, fill, cost = [0] * len(lengths), collections.Counter(), collections.Counter()
    for doc, _, n, seq, _ in out:
        seen[doc] += n
        fill[seq] += n
        cost[seq] += rule.cost(n)
    assert seen == lengths
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill.values())
    assert sum(n < 2048 for n in fill.values()) <= 11
    whole = {d for d, _, n, _, _ in out if n == lengths[d]}
    short = sum(n <= 2048 for n in lengths)
    assert short - len(whole) <= len(fill)  # nothing is padded, so about one cut a sequence


@pytest.fixture(scope="module")
def pieces():
    return ps.Pieces(ps.default_path(), 0.5)


def paths(pieces, chunk):
    n, edges = pieces.lattice(chunk)
    found = {}

    def walk(node, ids, weight):
        if node == 0:
            found[tuple(ids)] = math.exp(weight)
        for end, start, p, w in edges:
            if end == node:
                walk(start, [p, *ids], weight + w)

    walk(n - 1, [], 0.0)
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


@pytest.mark.parametrize("chunk", [" thing", " x𝄞y", "  ab", "▁in", " don't"])
def test_segmentations_come_with_their_probability(pieces, chunk):
    n, sampler = 60_000, ps.Sampler(pieces)
    ids, counts = sampler.draw([chunk] * n, c.mix64(np.arange(n, dtype=np.uint64) * c.MIX_1))
    ends = np.cumsum(counts)
    got = collections.Counter(tuple(ids[e - k : e].tolist()) for e, k in zip(ends, counts, strict=True))
    want = paths(pieces, chunk)
    assert set(got) <= set(want)
    for path, p in want.items():
        assert abs(got[path] - n * p) <= 6 * math.sqrt(n * p * (1 - p)) + 6


def test_sampling_is_reproducible_and_lossless(spark, make_docs, odd_rows):
    rows = odd_rows + [(2000 + k, t) for k, t in enumerate([*TEXTS, "a" * 9000, "￿ \n\n x ", "▁ ▁x"])]
    docs = make_docs(rows)
    got = ps.sample_pieces(docs).collect()
    again = ps.sample_pieces(docs.repartition(5, "text")).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_pieces, r.ids_crc32)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert all(r.lossless for r in got) and len(got) == len(rows)
    assert all(r.ids_crc32 == crc(r.token_ids) and r.n_pieces == len(r.token_ids) for r in got)
    other = {r.doc_id: r.token_ids for r in ps.sample_pieces(docs, seed=2).collect()}
    assert other[11] != next(r.token_ids for r in got if r.doc_id == 11)
    back = ps.decode_pieces(ps.sample_pieces(docs), text_col="back")
    texts = dict(rows)
    assert all(r.back == (texts[r.doc_id] or "") for r in back.collect() if r.doc_id is not None)
    assert ps.sample_pieces(make_docs([])).count() == 0
