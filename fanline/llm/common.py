"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline.session import checkpoint_dir

# odd 64-bit multipliers (golden-ratio and murmur finaliser constants), fixed values
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

#: entries of a worker's word memo; it is emptied when full, so memory stays bounded
MEMO_WORDS = 300_000
#: 64-bit words of a key filter at most (one for every four keys until then)
FILTER_WORDS = 1 << 20

#: tables written so far within the innermost ``materialise_alone``: session and folder
_on_the_way: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("on_the_way", default=None)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    few_rows_a_batch(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/fanline-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage with
    files that survive lost executors, and gives later joins fresh exchanges on
    both sides, which adaptive execution can split when a key is hot."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    if (held := _on_the_way.get()) is not None:
        held.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def materialise_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``materialise`` what ``make`` returns, and drop the tables that were written for
    it on the way; nothing else may read those. They go after an error as well."""
    held: list[tuple[SparkSession, str]] = []
    token = _on_the_way.set(held)
    try:
        try:
            out = make()
        finally:
            _on_the_way.reset(token)
        return materialise(out, label)
    finally:
        for spark, path in held:
            _delete(spark, path)


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that no frame still to be run reads."""
    for t in tables:
        _delete(t.sparkSession, t.written_to)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``docs`` has them in any case."""
    taken = {x.lower() for x in docs.columns}
    longest = max(map(len, taken), default=0)
    return [n + "_" * (longest + 1 - len(n)) if n.lower() in taken else n for n in names]


def split_by_keys(rows: DataFrame, key: Column, found: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose key may be in column ``by`` of ``found`` (a few
    others among them), and those whose key is not there. Only the first part, and so
    few long texts, need go through a join with ``found``.

    A Bloom filter of three bits in one word for each key is aggregated from ``found``
    and broadcast; with more keys than it has room for it lets more rows pass, no fewer.
    ``found`` is read twice and should be a written table.
    """
    words = min(FILTER_WORDS, max(1, found.count() // 4))
    one = F.lit(1).cast("long")

    def place(k: Column) -> tuple[Column, Column]:
        h = F.xxhash64(k)
        bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, n).bitwiseAND(63).cast("int")) for n in (0, 6, 12)]
        return F.pmod(F.shiftrightunsigned(h, 18), F.lit(words)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])

    at, bits = fresh_names(rows, "__at", "__bits")
    of, own = place(F.col(by))
    held = found.select(of.alias(at), own.alias(bits)).groupBy(at).agg(F.bit_or(bits).alias(bits))
    of, own = place(key)
    has = F.col(bits).bitwiseAND(own) == own
    near = rows.join(F.broadcast(held), of == F.col(at)).where(has)
    rest = rows.join(F.broadcast(held), of == F.col(at), "left").where(~F.coalesce(has, F.lit(False)))
    return near.select(*rows.columns), rest.select(*rows.columns)


def join_by_keys(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key``, for a ``found`` (a written table) with few of the keys."""
    return split_by_keys(rows, F.col(key), found, key)[0].join(found, key)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt) * np.uint64(1 << 20)) * GOLDEN)


#: memos of this worker process by the operator that fills them
_memos: dict[str, list[dict]] = {}
_owner = [""]


def hold(owner: str, memo: dict) -> dict:
    """Register a worker's memo of an operator."""
    _memos.setdefault(owner, []).append(memo)
    return memo


def claim(owner: str) -> None:
    """Say whose memos are in use from now on; those of other operators are emptied,
    as one worker process serves stage after stage."""
    if _owner[0] != owner:
        _owner[0] = owner
        for name, memos in _memos.items():
            if name != owner:
                for memo in memos:
                    memo.clear()


def few_rows_a_batch(spark: SparkSession, rows: int = 1_000) -> None:
    """Whole texts go to Python in batches of so many rows, unless the session asks for
    fewer: a batch is held several times over on its way."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


class WordMemo(dict):
    """Memo word -> 64-bit hash for one worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_memo = hold("words", WordMemo())


def text_of(value) -> str:
    """A text column's value; NULL counts as the empty text."""
    return value if isinstance(value, str) else ""


def ascii_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8.
    (bytes.lower and bytes.split touch exactly these ASCII ranges.)"""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    claim("words")
    return np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words (with repeats); fewer words form one
    shingle as a whole; no words, none."""
    n = len(hashes)
    if n == 0:
        return hashes
    span = min(width, n)
    mult = _shingle_mult[:span]
    acc = hashes[: n - span + 1] * mult[0]
    for j in range(1, span):
        acc = acc + hashes[j : n - span + 1 + j] * mult[j]
    return mix64(acc + np.uint64(span))


_shingle_mult = seeds(64, 7) | np.uint64(1)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(word_hashes(ascii_words(text)), width))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def frame(columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """A frame whose columns keep the arrays' own types (pandas would turn texts into
    chunked string arrays, which Arrow's structs refuse)."""
    return pd.DataFrame({k: pd.Series(v, dtype=v.dtype) for k, v in columns.items()})


def by_rows(frames: Iterable[pd.DataFrame], cells: int) -> Iterator[pd.DataFrame]:
    """Cut pandas batches into pieces of at most ``cells`` rows."""
    for f in frames:
        for a in range(0, len(f), cells):
            yield f.iloc[a : a + cells]
