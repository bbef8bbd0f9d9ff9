"""Token ids stored as one wavelet matrix per shard.

A wavelet matrix keeps the ids of a shard bit by bit: plane 0 holds the highest
bit of every id in order; ids with a zero bit are then moved before those with
a one bit (order kept) and plane 1 holds the next bit, and so on. Each plane
carries the number of ones before every 64-bit word, so rank takes one lookup
and one bit count. From the planes alone one reads single ids (``access``),
counts an id up to a position (``rank``), finds its k-th place (``select``),
and recovers all ids.

Blob layout (little-endian): magic ``WMX1``, u32 number of planes, u64 number
of ids; for each plane u64 number of zeros, u64 words of bits, u32 ones before
each word. The blobs are compressed with zstandard when the shard is written.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm import tokens

MAGIC = b"WMX1"


class WaveletMatrix:
    """One shard's ids as bit planes with rank directories."""

    def __init__(self, size: int, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.size, self.planes = size, planes  # (zeros, words, ones before each word)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        x, planes = ids, []
        for k in range(bits - 1, -1, -1):
            bit = (x & x.dtype.type(1 << k)) != 0
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros((len(x) + 63) // 64, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.uint32)
            if len(words):
                before[1:] = np.cumsum(np.bitwise_count(words[:-1]), dtype=np.uint32)
            low = x.take(np.flatnonzero(~bit))  # several times as fast as a boolean index
            planes.append((len(low), words, before))
            x = np.concatenate((low, x.take(np.flatnonzero(bit))))
        return cls(len(ids), planes)

    def to_bytes(self) -> bytes:
        parts = [MAGIC, struct.pack("<IQ", len(self.planes), self.size)]
        for zeros, words, before in self.planes:
            parts += [struct.pack("<Q", zeros), words.astype("<u8").tobytes(), before.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n_planes, size = struct.unpack_from("<IQ", blob, 4)
        at, n_words, planes = 16, (size + 63) // 64, []
        for _ in range(n_planes):
            (zeros,) = struct.unpack_from("<Q", blob, at)
            words = np.frombuffer(blob, "<u8", n_words, at + 8)
            before = np.frombuffer(blob, "<u4", n_words, at + 8 + 8 * n_words)
            planes.append((zeros, words, before))
            at += 8 + 12 * n_words
        return cls(size, planes)

    def _ones(self, plane: int, pos: int) -> int:
        """Ones before ``pos`` in a plane."""
        _, words, before = self.planes[plane]
        if pos >= self.size:
            return self.size - self.planes[plane][0]
        w, r = divmod(pos, 64)
        return int(before[w]) + (int(words[w]) & ((1 << r) - 1)).bit_count()

    def access(self, pos: int) -> int:
        """The id at a position."""
        if not 0 <= pos < self.size:
            raise IndexError(pos)
        value = 0
        for k, (zeros, words, _) in enumerate(self.planes):
            bit = int(words[pos >> 6]) >> (pos & 63) & 1
            ones = self._ones(k, pos)
            value = value << 1 | bit
            pos = zeros + ones if bit else pos - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        lo, hi = 0, min(end, self.size)
        bits = len(self.planes)
        if token >> bits:
            return 0, 0
        for k, (zeros, _, _) in enumerate(self.planes):
            a, b = self._ones(k, lo), self._ones(k, hi)
            lo, hi = (zeros + a, zeros + b) if token >> (bits - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, end: int) -> int:
        """How often an id occurs before position ``end``."""
        lo, hi = self._range(token, end)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.size)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of an id (from 0)."""
        lo, hi = self._range(token, self.size)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        pos, bits = lo + k, len(self.planes)
        for p in range(bits - 1, -1, -1):
            zeros = self.planes[p][0]
            want = token >> (bits - 1 - p) & 1
            pos = self._find(p, want, pos - zeros if want else pos)
        return pos

    def _find(self, plane: int, want: int, k: int) -> int:
        """Position of the k-th ``want`` bit of a plane."""
        _, words, before = self.planes[plane]
        start = before.astype(np.int64)
        if not want:
            start = np.arange(len(words), dtype=np.int64) * 64 - start
        w = int(np.searchsorted(start, k, "right")) - 1
        left, word = k - int(start[w]), int(words[w])
        for r in range(64):
            if word >> r & 1 == want:
                if left == 0:
                    return w * 64 + r
                left -= 1
        raise IndexError(k)

    def to_ids(self) -> np.ndarray:
        """All ids in order: the planes' moves undone from the last to the first."""
        wide = np.uint16 if len(self.planes) <= 16 else np.uint32
        x = np.zeros(self.size, wide)
        for k in range(len(self.planes) - 1, -1, -1):
            zeros, words, _ = self.planes[k]
            bit = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), count=self.size, bitorder="little").view(bool)
            y = np.empty_like(x)
            y[np.flatnonzero(~bit)] = x[:zeros]
            y[np.flatnonzero(bit)] = x[zeros:] | wide(1 << (len(self.planes) - 1 - k))
            x = y
        return x


SHARD_SCHEMA = (
    "part int, before long, n_ids long, id array<long>, no_id array<boolean>, length array<long>, blob binary"
)


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer_path: str | None = None,
    shard_ids: int = 1 << 18,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode all documents in ascending id order and write shard files.

    Spark deals the rows out by id range and sorts each range; a task encodes its
    rows one by one and closes a shard after the document with which it reaches
    ``shard_ids`` ids, so memory is bounded by a shard and one document. A row of
    a file is one shard: its task's number, the ids that task wrote before it,
    its documents (id, number of ids) and its compressed wavelet matrix. The
    files lie in Spark's own table format, in any store that Spark can write to.
    NULL text is the end id alone; NULL ids come first; rows that repeat an id
    stay next to each other, in the order of their texts; other columns are not
    read; an empty table writes no shard.
    """
    source = tokenizer_path or tokens.default_path()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part = tokens.encoder(source), TaskContext.get().partitionId()
        bits = max(1, (enc.tokenizer.get_vocab_size() - 1).bit_length())
        press = zstandard.ZstdCompressor(level=1)
        held: list[tuple[int, bool, np.ndarray]] = []
        size = before = 0

        def close() -> pd.DataFrame:
            blob = WaveletMatrix.build(np.concatenate([x[2] for x in held]), bits).to_bytes()
            row = {
                "part": part,
                "before": before,
                "n_ids": size,
                "id": [x[0] for x in held],
                "no_id": [x[1] for x in held],
                "length": [len(x[2]) for x in held],
                "blob": press.compress(blob),
            }
            return pd.DataFrame({k: [v] for k, v in row.items()})

        for f in c.by_rows(frames, 1024):
            for id_, no_id, text in zip(f["id"], f["no_id"], f["text"], strict=True):
                held.append((id_, no_id, enc.encode(text)))
                size += len(held[-1][2])
                if size >= shard_ids:
                    yield close()
                    held, size, before = [], 0, before + size
        if held:
            yield close()

    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        F.col(text_col).cast("string").alias("text"),
    ).withColumn("with_id", ~F.col("no_id"))  # false sorts first
    ordered = rows.repartitionByRange("with_id", "id").sortWithinPartitions("with_id", "id", "text")
    shards = ordered.select("id", "no_id", "text").mapInPandas(run, SHARD_SCHEMA)
    shards.write.option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id", with_tokens: bool = True) -> DataFrame:
    """Documents of shard files: (id_col, start long, n_tokens long, ids_crc32 long
    [, token_ids array<int>]), decoded from the wavelet matrices alone.

    start counts the ids of all documents before. The ids before a write task
    come from one number per task (broadcast: as many rows as write tasks), so
    decoding needs no shuffle.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = per_part.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for f in frames:
            for part, first, ids, no_ids, lengths, blob in zip(
                f["part"], f["before"], f["id"], f["no_id"], f["length"], f["blob"], strict=True
            ):
                values = WaveletMatrix.from_bytes(unpack.decompress(blob)).to_ids().astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                cuts = [values[a:b] for a, b in zip(begins, ends, strict=True)]
                rows = {
                    "part": part,
                    "at": first + begins,
                    "id": ids,
                    "no_id": no_ids,
                    "n_tokens": lengths,
                    "ids_crc32": [zlib.crc32(x.tobytes()) for x in cuts],
                }
                if with_tokens:
                    rows["token_ids"] = [x.astype(np.int32) for x in cuts]
                yield pd.DataFrame(rows)

    schema = "part int, at long, id long, no_id boolean, n_tokens long, ids_crc32 long"
    names = ["n_tokens", "ids_crc32"] + ["token_ids"] * with_tokens
    decoded = shards.select("part", "before", "id", "no_id", "length", "blob").mapInPandas(
        run, schema + ", token_ids array<int>" * with_tokens
    )
    return decoded.join(F.broadcast(base), "part").select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col), (F.col("base") + F.col("at")).alias("start"), *names
    )
