"""Running words that stand at an earlier place too, wherever lines break.

A window of ``length`` words in a row repeats when the same words (ASCII lower
case, any white space between them) stand at an earlier (id, word) place that it
does not overlap. Winnowing finds the documents to look at: of the hashes of all
runs of half the length, each document keeps the smallest of every ``length -
half + 1`` in a row, so two equal windows always keep a hash in common. Only
around shared hashes are all windows hashed (128 bits) and grouped; what is
found is every repeated window, not a share of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")  # the words of common.ascii_words


def run_hashes(words: np.ndarray, width: int, base: np.uint64 = c.GOLDEN) -> np.ndarray:
    """Hashes of all runs of ``width`` words: differences of one polynomial's
    prefix sums, divided by the power of the place (odd bases have inverses)."""
    powers, inverse = (np.multiply.accumulate(np.full(len(words), x, np.uint64)) for x in (base, _inverse(base)))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers, dtype=np.uint64)))
    n = max(0, len(words) - width + 1)
    return c.mix64((total[width:] - total[: len(total) - width]) * inverse[:n]) if n else words[:0]


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def _slide(x: np.ndarray, span: int, best: np.ufunc) -> np.ndarray:
    """Least or greatest of every ``span`` values in a row."""
    done = 1
    n = len(x) - span + 1
    while done < span:
        step = min(done, span - done)
        x, done = best(x[:-step], x[step:]), done + step
    return x[:n]


def winnowed(words: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the kept runs of ``length // 2`` words of texts that lie
    behind one another; ``text`` numbers the text of each word. Texts of fewer
    than ``length`` words keep none."""
    if len(words) < length:
        return words[:0], np.zeros(0, np.int64)
    half = length // 2
    span = length - half + 1
    h = run_hashes(words, half)
    least = _slide(h, span, np.minimum)
    least[text[: len(least)] != text[length - 1 :]] = 0  # no window crosses texts
    none = np.zeros(span - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate((none, least, none)), span, np.maximum) == h)
    return h[at], at


def _words(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts behind one another, and the number of each word's text."""
    words = [c.word_hashes(c.ascii_words(t)) for t in texts]
    return np.concatenate(words), np.repeat(np.arange(len(words)), [len(w) for w in words])


def repeated_windows(texts: DataFrame, length: int) -> DataFrame:
    """(doc, pos, h): windows of (doc long, text string) that repeat; pos counts
    words. Texts of an id that repeats count as one document."""

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in c.by_rows(frames, 128):
            words, text = _words(f["text"])
            h, at = winnowed(words, text, length)
            order = np.lexsort((h, text[at]))
            h, row = h[order], text[at][order]
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))[: len(h)])
            n = np.diff(np.append(new, len(h)))
            yield pd.DataFrame({"h": c.as_long(h[new]), "doc": f["doc"].to_numpy()[row[new]], "n": n})

    kept = c.materialise(texts.mapInPandas(keep, "h long, doc long, n long"), "winnowed")
    shared = kept.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    shared = c.join_by_keys(kept.select("h", "doc"), c.materialise(shared, "shared"), "h")
    per_doc = c.materialise(shared.groupBy("doc").agg(F.collect_set("h").alias("hs")), "looked-at")

    def windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        back = np.arange(length - length // 2 + 1)
        for f in c.by_rows(frames, 128):
            words, text = _words(f["text"])
            h, at = winnowed(words, text, length)
            wanted = [np.isin(c.as_long(x), hs) for x, hs in zip(np.split(h, np.searchsorted(text[at], np.arange(1, len(f)))), f["hs"], strict=True)]
            at = at[np.concatenate(wanted)]
            pos = np.unique(at[:, None] - back)
            pos = pos[(pos >= 0) & (pos <= len(words) - length)]
            pos = pos[text[pos] == text[pos + length - 1]]
            one, two = run_hashes(words, length), run_hashes(words, length, c.MIX_1 | np.uint64(1))
            start = np.searchsorted(text, np.arange(len(f)))
            row = text[pos]
            yield pd.DataFrame(
                {"h": c.as_long(one[pos]), "g": c.as_long(two[pos]), "doc": f["doc"].to_numpy()[row], "pos": pos - start[row]}
            )

    near = c.join_by_keys(texts, per_doc, "doc").select("doc", "text", "hs").mapInPandas(windows, "h long, g long, doc long, pos long")
    near = c.materialise(near, "windows")
    first = F.min(F.struct("doc", "pos")).alias("first")
    firsts = near.groupBy("h", "g").agg(F.count("*").alias("n"), first).where("n > 1").drop("n")
    met = near.join(c.materialise(firsts, "first-windows"), ["h", "g"])
    return met.where(f"doc <> first.doc OR pos >= first.pos + {length}").select("doc", "pos", "h")


def without_windows(text: str, pos: np.ndarray, h: np.ndarray, length: int) -> tuple[str, int]:
    """Text without the words of the windows (pos, h) that it holds, and the
    number of runs cut. A line break beside a cut run stays."""
    raw = text.encode("utf-8", "surrogatepass")
    words = c.word_hashes(c.ascii_words(text))
    own = c.as_long(run_hashes(words, length))
    h, pos = h[pos < len(own)], pos[pos < len(own)]
    pos = np.unique(pos[own[pos] == h])
    if not len(pos):
        return text, 0
    spans = [m.span() for m in _WORD.finditer(raw)]
    edge = np.zeros(len(words) + 1, np.int64)
    edge[pos] += 1
    edge[pos + length] -= 1
    cut = np.flatnonzero(np.diff(np.concatenate(([False], np.cumsum(edge) > 0, [False])).astype(np.int8)))
    out, at, runs = [], 0, cut.reshape(-1, 2)
    for a, b in runs:
        before = spans[a - 1][1] if a else 0
        after = spans[b][0] if b < len(spans) else len(raw)
        out.append(raw[at:before])
        gaps = [raw[before : spans[a][0]], raw[spans[b - 1][1] : after]]
        if a and b < len(spans):
            out.append(gaps[1] if b"\n" in gaps[1] and b"\n" not in gaps[0] else gaps[0])
        at = after
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass"), len(runs)
