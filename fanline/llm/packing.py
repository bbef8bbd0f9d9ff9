"""Cost-balanced packing of documents into fixed-size training sequences.

A document costs ``linear * n + quadratic * n**2`` (attention over its own
tokens). A task packs its documents in blocks: a block of T tokens gets
``T // capacity`` full sequences, and the rest of T as sequences of descending
powers of two, which need no padding. Full-length pieces of long documents
take whole sequences; the other pieces go, in descending order of cost, to the
sequence of the lowest cost so far that still has room. A piece that fits none
of the ``tries`` cheapest is cut: it fills the one with the most room, and its
rest is placed likewise. The room of a block equals its tokens, so each
sequence ends up full and nothing is padded.

Blocks are made inside the scan's own tasks: no shuffle, memory bounded by one
block, and a retried task makes the same rows again.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm import tokens


@dataclass(frozen=True)
class PackingRule:
    """capacity: tokens of a sequence (a power of two); block_tokens: tokens that
    are packed together; tries: sequences tried before a piece is cut; linear and quadratic:
    weights of the cost."""

    capacity: int = 2048
    block_tokens: int = 1 << 20
    linear: float = 1.0
    quadratic: float = 1.0 / 2048
    tries: int = 64

    def cost(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n


def room_of(total: int, capacity: int) -> list[int]:
    """Sequence lengths that hold ``total`` tokens: full ones, then powers of two."""
    rooms = [capacity] * (total // capacity)
    rest, size = total % capacity, capacity // 2
    while rest:
        if rest >= size:
            rooms.append(size)
            rest -= size
        size //= 2
    return rooms


def pack_block(lengths: list[int], rule: PackingRule) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document index, start, length, sequence index, offset) of a block."""
    rooms = room_of(sum(lengths), rule.capacity)
    out: list[tuple[int, int, int, int, int]] = []
    used = [0] * len(rooms)
    pieces: list[tuple[int, int, int]] = []  # (length, document, start)
    nxt = 0
    for doc, n in enumerate(lengths):
        full = n // rule.capacity
        for k in range(full):  # whole sequences of a long document
            out.append((doc, k * rule.capacity, rule.capacity, nxt, 0))
            used[nxt] = rule.capacity
            nxt += 1
        if n % rule.capacity:
            pieces.append((n % rule.capacity, doc, full * rule.capacity))
    # sequences by (cost so far, index); those that are full leave the heap
    heap = [(0.0, s) for s in range(nxt, len(rooms))]
    heapq.heapify(heap)
    cost = [0.0] * len(rooms)
    pieces.sort(key=lambda p: (-p[0], p[1]))
    for n, doc, start in pieces:
        while n:
            passed, found = [], None
            while heap:
                item = heapq.heappop(heap)
                if rooms[item[1]] - used[item[1]] >= n:
                    found = item[1]
                    break
                passed.append(item)
                if len(passed) >= rule.tries:
                    break
            if found is None:
                found = max(passed, key=lambda p: (rooms[p[1]] - used[p[1]], -p[1]))[1]
                passed = [p for p in passed if p[1] != found]
            for item in passed:
                heapq.heappush(heap, item)
            take = min(n, rooms[found] - used[found])
            out.append((doc, start, take, found, used[found]))
            used[found] += take
            cost[found] += rule.cost(take)
            if used[found] < rooms[found]:
                heapq.heappush(heap, (cost[found], found))
            start, n = start + take, n - take
    return out


def pack(
    docs: DataFrame,
    rule: PackingRule = PackingRule(),
    tokenizer_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_tokens: bool = True,
) -> DataFrame:
    """Pieces of all documents, one row each.

    Returns (id_col, start long, length long, ids_crc32 long, doc_tokens long,
    sequence_id long, offset long, token_ids array<int> when ``with_tokens``).
    Every id of every document, its end id included, lies in exactly one piece;
    the pieces of a sequence follow one another from offset 0. Defined results:
    NULL or empty text is the end id alone; a NULL id is carried as NULL; each
    row is a document of its own, repeated ids included; long texts are cut;
    other columns are not read; an empty table gives no rows. sequence_id is
    unique over the table (task number, block and sequence within the task).
    """
    path = tokenizer_path or tokens.default_path()

    def rows_of(held: list, task: int, block: int) -> pd.DataFrame:
        placed = pack_block([len(x[2]) for x in held], rule)
        cols: dict[str, list] = {k: [] for k in names}
        for doc, start, length, seq, offset in placed:
            id_, no_id, ids = held[doc]
            part = ids[start : start + length]
            cols["id"].append(id_)
            cols["no_id"].append(no_id)
            cols["start"].append(start)
            cols["length"].append(length)
            cols["ids_crc32"].append(zlib.crc32(part.astype("<u4").tobytes()))
            cols["doc_tokens"].append(len(ids))
            cols["sequence_id"].append((task << 40) + (block << 20) + seq)
            cols["offset"].append(offset)
            if with_tokens:
                cols["token_ids"].append(part.astype(np.int32))
        return pd.DataFrame(cols)

    names = ["id", "no_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    names += ["token_ids"] * with_tokens

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, task = tokens.encoder(path), TaskContext.get().partitionId()
        held, size, block = [], 0, 0
        for f in c.by_rows(frames, 1024):
            for id_, no_id, text in zip(f["id"], f["no_id"], f["text"], strict=True):
                ids = enc.encode(text)
                held.append((id_, no_id, ids))
                size += len(ids)
                if size >= rule.block_tokens:
                    yield rows_of(held, task, block)
                    held, size, block = [], 0, block + 1
        if held:
            yield rows_of(held, task, block)

    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
        F.col(id_col).isNull().alias("no_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    longs = ", ".join(f"{x} long" for x in names[2:8])
    out = rows.mapInPandas(run, f"id long, no_id boolean, {longs}" + ", token_ids array<int>" * with_tokens)
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), *names[2:])
