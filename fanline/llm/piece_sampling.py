"""Sampled segmentations over a public piece vocabulary, and lossless decoding.

Encoding. A text, with one space put before it and spaces shown as the
vocabulary's space sign, is cut at spaces and line breaks, which no piece
crosses. Each chunk spans a lattice: an edge for every vocabulary piece that
matches at a place, and the bytes of a character that has no piece. Forward
filtering sums the weights of all paths to every node; backward sampling then
draws, from the end, each edge in proportion to the paths through it, so every
segmentation comes with exactly its probability. One exception: a chunk of over
4,096 characters (``MOST_CHARS``) is cut into parts of that length first, no piece
crosses a cut, and the draw is exact within each part only. Lattices of equal chunks are
built once per worker (bounded arena); drawing runs in numpy over all chunks
of a batch.

The random numbers are a hash of (seed, row key, chunk number, step): a row's
segmentation depends on nothing else, so retries, other partitionings and
other machines give the same ids.

Weights. The pieces of a merge vocabulary carry ranks, not probabilities; their
weight is ``(rank + 2) ** -theta`` (Zipf's law). Scores of a unigram vocabulary
are used as log-probabilities, times theta. A smaller theta spreads the draws
over more segmentations; at 1 the commonest one takes nearly all.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c

SPACE = "▁"  # the vocabularies' space sign
_HIDDEN = "￿"  # stands for a space sign in the text itself; in no piece
_CHUNK = re.compile(" *[^ \n]+| +|\n")
_STEP = 0x9E3779B97F4A7C15  # multiplier of the rolling hash of pieces
#: edges a worker keeps before its lattices are dropped, some 20 bytes each
ARENA_EDGES = 6_000_000
#: chunks drawn at a time; longer chunks are not kept
BATCH_CHUNKS = 200_000
KEPT_CHARS = 40
#: a chunk longer than this is cut into such parts, so a lattice stays bounded
MOST_CHARS = 4096


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Piece vocabulary of a model file: weights, byte pieces, decoding table."""

    def __init__(self, path: str, theta: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = [sp.get_score(i) for i in plain]
        usable = sorted((s for s in scores if s > -1e8), reverse=True)
        ranked = all(s == int(s) for s in usable[:64]) and len(set(usable[:64])) == len(usable[:64])
        self.ids: dict[str, int] = {}
        self.weight: dict[int, float] = {}
        self.table: list[bytes] = [b""] * n
        top, least = (usable[0] if usable else 0.0), 0.0
        for i, s in zip(plain, scores, strict=True):
            text = sp.id_to_piece(i)
            s = max(s, usable[-1] if usable else 0.0)  # characters without a rank weigh as the last
            w = -theta * math.log(top - s + 2) if ranked else theta * s
            self.ids[text], self.weight[i] = i, w
            self.table[i] = text.replace(SPACE, " ").encode()
            least = min(least, w)
        self.longest = max(map(len, self.ids), default=1)
        # every prefix of a piece by hash -> (id or -1): matching ends at a miss
        heads = {text[:k]: -1 for text in self.ids for k in range(1, len(text))} | self.ids
        hashes = np.zeros(len(heads), np.uint64)
        for k, text in enumerate(heads):
            h = 0
            for ch in text:
                h = (h * _STEP + ord(ch) + 1) % (1 << 64)
            hashes[k] = h
        order = np.argsort(hashes)
        self.heads, self.head_ids = hashes[order], np.array(list(heads.values()), np.int32)[order]
        self.head_weights = np.array([math.exp(self.weight[i]) if i >= 0 else 0.0 for i in self.head_ids.tolist()])
        self.byte = [-1] * 256
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[1:-1], 16)
                self.byte[b], self.table[i] = i, bytes([b])
        if min(self.byte) < 0:
            raise ValueError("the vocabulary has no byte pieces: decoding would lose characters")
        self.byte_weight = least - theta * math.log(2)

    def decode(self, ids) -> str:
        """The text of a document's ids: pieces joined, the space put first taken off."""
        raw = b"".join(map(self.table.__getitem__, ids))
        return raw[1:].decode("utf-8")

    def lattice(self, chunk: str) -> tuple[int, list[tuple[int, int, int, float]]]:
        """(nodes, [(node, from node, id, log weight)]): edges by their end node.

        Nodes are the chunk's character boundaries and, within a character that
        is spelt in bytes, the places between its bytes.
        """
        shown = chunk.replace(SPACE, _HIDDEN).replace(" ", SPACE)
        ids, n = self.ids, len(shown)
        at = list(range(n + 1))  # node of each boundary
        spelt: dict[int, bytes] = {}
        extra = 0
        for i, ch in enumerate(shown):
            if ch not in ids:
                spelt[i] = (SPACE if ch == _HIDDEN and chunk[i] == SPACE else chunk[i]).encode("utf-8")
                extra += len(spelt[i]) - 1
            at[i + 1] = i + 1 + extra
        edges: list[tuple[int, int, int, float]] = []
        for j in range(1, n + 1):
            if j - 1 in spelt:
                raw, first = spelt[j - 1], at[j - 1]
                for k, b in enumerate(raw):
                    edges.append((first + k + 1, first + k, self.byte[b], self.byte_weight))
            else:
                for i in range(max(0, j - self.longest), j):
                    p = ids.get(shown[i:j])
                    if p is not None:
                        edges.append((at[j], at[i], p, self.weight[p]))
        return at[n] + 1, edges


class Sampler:
    """A worker's arena of lattices, ready for backward sampling."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}  # chunk -> its number
        self.chunks = self.nodes = self.edges = 0
        # chunk: base, last node; node: first edge, sum; edge: from node, id, running
        # sum; and what is still to be put into these arrays
        kinds = (np.int64, np.int64, np.int64, np.float64, np.int64, np.int32, np.float64)
        self.arrays = [np.zeros(1 << 12, t) for t in kinds]
        self.used = [0] * len(kinds)
        self.fresh: list[list] = [[] for _ in kinds]

    def place(self, chunk: str) -> int:
        """Number of a chunk's lattice, put into the arena by itself."""
        n = self._any(chunk)
        number = self.chunks
        self.fresh[0].append(self.nodes)
        self.fresh[1].append(self.nodes + n - 1)
        self.nodes += n
        self.edges = self.used[4] + len(self.fresh[4])
        self.chunks += 1
        return number

    def place_short(self, chunks: list[str]) -> None:
        """Lattices of many short chunks at once, put into the arena and the memo.

        Matching: all places of all chunks step through the piece lengths
        together. Forward filtering: the nodes at the same place of all chunks
        are summed together; path weights are plain products, which a short
        chunk's do not underflow. A chunk with a character that has no piece is
        placed by itself.
        """
        self._settle()
        shown = [x.replace(" ", SPACE) for x in chunks]
        size = np.array([len(x) for x in shown], np.int64)
        cp = np.frombuffer("".join(shown).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        chunk = np.repeat(np.arange(len(shown)), size)
        ends = np.cumsum(size)
        stop = ends[chunk]
        at, h = np.arange(len(cp)), np.zeros(len(cp), np.uint64)
        begin, length, entry = [], [], []
        bad = np.zeros(len(shown), bool)
        for n in range(1, self.pieces.longest + 1):
            live = at + n <= stop[at]
            at, h = at[live], h[live]
            if not len(at):
                break
            h = h * np.uint64(_STEP) + cp[at + n - 1]
            k = np.minimum(np.searchsorted(self.pieces.heads, h), len(self.pieces.heads) - 1)
            known = self.pieces.heads[k] == h
            if n == 1:
                lost = ~known
                lost[known] = self.pieces.head_ids[k[known]] < 0
                bad[chunk[at[lost]]] = True
            at, h, k = at[known], h[known], k[known]
            whole = self.pieces.head_ids[k] >= 0
            begin.append(at[whole])
            length.append(np.full(int(whole.sum()), n))
            entry.append(k[whole])
        begin, length, entry = (np.concatenate(x) for x in (begin, length, entry))
        good = ~bad[chunk[begin]]
        begin, length, entry = begin[good], length[good], entry[good]
        # node of a place: its position, and one more for every chunk before it
        src = begin + chunk[begin]
        dst = src + length
        rank = dst - (ends - size + np.arange(len(shown)))[chunk[begin]]  # place within the chunk
        order = np.lexsort((src, dst, rank))
        src, dst, entry, rank = src[order], dst[order], entry[order], rank[order]
        weight = self.pieces.head_weights[entry]
        nodes = len(cp) + len(shown)
        alpha = np.ones(nodes)
        upto = np.empty(len(src))
        cuts = np.searchsorted(rank, np.arange(1, int(rank.max(initial=0)) + 2))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            v = alpha[src[lo:hi]] * weight[lo:hi]
            d = dst[lo:hi]
            heads = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
            sums = np.add.reduceat(v, heads)
            alpha[d[heads]] = sums
            count = np.diff(np.append(heads, hi - lo))
            # shares of a node add up to one, so running sums are cut off by node number
            run = np.cumsum(v / np.repeat(sums, count))
            upto[lo:hi] = run - np.repeat(np.arange(len(heads)), count)
            upto[lo + np.append(heads[1:], hi - lo) - 1] = 2.0  # rounding goes to the last edge
        order = np.lexsort((src, dst))
        first = np.searchsorted(dst[order], np.arange(nodes))
        base = ends - size + np.arange(len(shown))
        self._put(0, self.nodes + base)
        self._put(1, self.nodes + base + size)
        self._put(2, self.edges + first)
        self._put(3, np.ones(nodes))
        self._put(4, self.nodes + src[order])
        self._put(5, self.pieces.head_ids[entry[order]])
        self._put(6, upto[order])
        for k, text in enumerate(chunks):
            if not bad[k]:
                self.memo[text] = self.chunks + k
        self.nodes, self.edges, self.chunks = self.nodes + nodes, self.edges + len(src), self.chunks + len(shown)
        for k in np.flatnonzero(bad).tolist():
            self.memo[chunks[k]] = self.place(chunks[k])
        self._settle()

    def _any(self, chunk: str) -> int:
        """Forward filtering of any chunk, in logarithms: its nodes."""
        n, edges = self.pieces.lattice(chunk)
        _, _, first, total, source, piece, upto = self.fresh
        first.append(self.used[4] + len(source))
        total.append(1.0)
        log = [0.0] + [-math.inf] * (n - 1)
        k, m = 0, len(edges)
        for node in range(1, n):
            begin = k
            while k < m and edges[k][0] == node:
                k += 1
            top = max(log[e[1]] + e[3] for e in edges[begin:k])
            first.append(self.used[4] + len(source))
            run = 0.0
            for _, src, p, w in edges[begin:k]:
                run += math.exp(log[src] + w - top)
                source.append(self.nodes + src)
                piece.append(p)
                upto.append(run)
            upto[-1] = 2 * run
            log[node] = top + math.log(run)
            total.append(run)
        return n

    def _put(self, k: int, values) -> None:
        end = self.used[k] + len(values)
        if end > len(self.arrays[k]):
            self.arrays[k] = np.concatenate((self.arrays[k], np.zeros(end, self.arrays[k].dtype)))
        self.arrays[k][self.used[k] : end] = values
        self.used[k] = end

    def _settle(self) -> None:
        """Move entries placed one by one into the arrays."""
        for k, values in enumerate(self.fresh):
            if values:
                self._put(k, values)
                self.fresh[k] = []

    def draw(self, chunks: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in order, number of ids of each chunk).

        keys: one 64-bit key per chunk, from which its random numbers follow.
        """
        if self.edges > ARENA_EDGES:
            self.clear()
        memo, place = self.memo, self.place
        new = [x for x in dict.fromkeys(chunks) if x not in memo and len(x) <= KEPT_CHARS and SPACE not in x]
        if new:
            self.place_short(new)
        numbers = [memo[x] if x in memo else place(x) for x in chunks]
        self._settle()
        base_of, last_of, first, total, source, piece, upto = self.arrays
        numbers = np.array(numbers, np.int64)
        base, node = base_of[numbers], last_of[numbers]
        live = np.flatnonzero(node > base)
        took_at: list[np.ndarray] = []
        took: list[np.ndarray] = []
        step = 0
        while len(live):
            mixed = c.mix64(keys[live] + np.uint64((step + 1) * int(c.GOLDEN) % (1 << 64)))
            u = (mixed >> np.uint64(11)).astype(np.float64) * 2.0**-53
            u *= total[node[live]]
            e = first[node[live]]
            late = np.flatnonzero(upto[e] <= u)
            while len(late):
                e[late] += 1
                late = late[upto[e[late]] <= u[late]]
            took_at.append(live)
            took.append(piece[e])
            at = source[e]
            node[live] = at
            live = live[at > base[live]]
            step += 1
        counts = np.zeros(len(chunks), np.int64)
        for x in took_at:
            counts[x] += 1
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for k, (x, p) in enumerate(zip(took_at, took, strict=True)):
            ids[ends[x] - 1 - k] = p
        return ids, counts


def chunks_of(text: str) -> list[str]:
    """Chunks of a text with the space put before it; an empty text has none.
    Longer ones than ``MOST_CHARS`` are cut, and no piece crosses such a cut."""
    if not text:
        return []
    found = _CHUNK.findall(" " + text)
    if max(map(len, found)) <= MOST_CHARS:
        return found
    return [x[a : a + MOST_CHARS] for x in found for a in range(0, len(x), MOST_CHARS)]


def encode_rows(sampler: Sampler, rows: list[tuple[str, str]], seed: int) -> Iterator[np.ndarray]:
    """Ids of (row key, text) rows, in order."""
    held: list[str] = []
    keys: list[np.ndarray] = []
    lengths: list[int] = []

    def flush() -> Iterator[np.ndarray]:
        ids, counts = sampler.draw(held, np.concatenate(keys) if keys else np.zeros(0, np.uint64))
        ends = np.concatenate(([0], np.cumsum(counts)))
        at = 0
        for n in lengths:
            yield ids[ends[at] : ends[at + n]]
            at += n

    for key, text in rows:
        own = chunks_of(text)
        start = np.uint64(xxhash.xxh3_64_intdigest(key.encode(), seed=seed))
        held += own
        keys.append(c.mix64(start + np.arange(len(own), dtype=np.uint64) * c.MIX_1))
        lengths.append(len(own))
        if len(held) >= BATCH_CHUNKS:
            yield from flush()
            held, keys, lengths = [], [], []
    yield from flush()


_samplers: dict[tuple[str, float], Sampler] = {}


def sampler_of(path: str, theta: float) -> Sampler:
    if (path, theta) not in _samplers:
        _samplers[path, theta] = Sampler(Pieces(path, theta))
    return _samplers[path, theta]


def sample_pieces(
    docs: DataFrame,
    model_path: str | None = None,
    seed: int = 1,
    theta: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_tokens: bool = True,
) -> DataFrame:
    """Sampled segmentation of every whole text.

    Returns (id_col, n_pieces long, ids_crc32 long, lossless boolean
    [, token_ids array<int>]); ids_crc32 is the unsigned crc32 of the ids as
    little-endian unsigned 32-bit integers, lossless says that decoding the ids
    gave the text back. The row key is the id as text. NULL or empty texts have
    no ids; a NULL id is carried as NULL, with the key "NULL"; rows that repeat
    an id and text get the same ids; other columns are not read; an empty table
    gives no rows.
    """
    path = model_path or default_path()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = sampler_of(path, theta)
        for f in c.by_rows(frames, 256):
            texts = [c.text_of(t) for t in f["text"]]
            rows = list(zip(f["key"], texts, strict=True))
            ids = list(encode_rows(sampler, rows, seed))
            out = {
                "id": f["id"],
                "no_id": f["no_id"],
                "n_pieces": [len(x) for x in ids],
                "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                "lossless": [sampler.pieces.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True)],
            }
            if with_tokens:
                out["token_ids"] = ids
            yield pd.DataFrame(out)

    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("NULL")).alias("key"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = "id long, no_id boolean, n_pieces long, ids_crc32 long, lossless boolean"
    out = rows.mapInPandas(run, schema + ", token_ids array<int>" * with_tokens)
    names = ["n_pieces", "ids_crc32", "lossless"] + ["token_ids"] * with_tokens
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), *names)


def decode_pieces(
    encoded: DataFrame, model_path: str | None = None, ids_col: str = "token_ids", text_col: str = "text"
) -> DataFrame:
    """``encoded`` with a text column decoded from its ids (NULL ids: NULL)."""
    path = model_path or default_path()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = sampler_of(path, 1.0).pieces
        for ids in batches:
            yield pd.Series([None if x is None else pieces.decode(list(x)) for x in ids])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return encoded.withColumn(text_col, F.pandas_udf(run, "string")(F.col(ids_col)))
