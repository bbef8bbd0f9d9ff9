"""Toxicity by compression distance: two zstandard dictionaries, window by window.

Fitting (on a bounded sample of labelled texts, which stays in Spark; the driver
gets counts of words that may enter a dictionary and eight numbers a text):
* words are counted by their distinct neighbours, so copies of a passage count
  once; words that stand out in toxic texts by a clear and significant ratio
  are the toxic dictionary's own content, the commonest other words the
  ordinary dictionary's;
* both compressors hold the ordinary content, only the toxic one the toxic
  content before it: ordinary text costs the same on both sides.

Scoring. A window of text is compressed under both dictionaries; its gain is the
length under the ordinary one minus that under the toxic one. A window is one
word set in a fixed frame that both dictionaries hold, because zstandard
neither searches the last bytes of an input nor shortens inputs of a few bytes;
equal windows are compressed once per worker (bounded memo). The gain that
separates the classes best becomes the window threshold; the number of windows
above it, the largest gain and their share go through a logistic calibration.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm.labelled import class_weights, drawn_rows

#: entries of a worker's memo of window gains; emptied when full
MEMO_WINDOWS = 300_000
#: longer words are compressed each time, so the memo's keys stay small
MEMO_BYTES = 64
#: gains in bytes that may become the window threshold
THRESHOLDS = range(1, 7)
#: words of the ordinary dictionary at most
USUAL_WORDS = 4000


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    head: bytes
    tail: bytes
    threshold: int = 1
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    name: str = field(default="", compare=False)


class WindowGain(dict):
    """Memo window -> gain in bytes under a model."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model
        # fixed values: a lazy search over a dictionary of some 10 KB
        p = zstandard.ZstdCompressionParameters(
            window_log=16,
            hash_log=15,
            chain_log=15,
            search_log=5,
            min_match=4,
            strategy=zstandard.STRATEGY_LAZY2,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        frame = model.tail + model.head
        self.by = []
        for content in (model.ordinary + frame, model.toxic + model.ordinary + frame):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)

    def __missing__(self, word: bytes) -> int:
        window = self.model.head + word + b" " + self.model.tail
        gain = len(self.by[0](window)) - len(self.by[1](window))
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_WINDOWS:
                self.clear()
            self[word] = gain
        return gain

    def of(self, text) -> np.ndarray:
        words = c.ascii_words(c.text_of(text))
        return np.fromiter(map(self.__getitem__, words), np.int16, len(words))


def word_contexts(sample: DataFrame) -> DataFrame:
    """(word, toxic long, ordinary long): in how many distinct (word before, word
    after) pairs a word stands in the texts of label 1 and of label 0; words as
    ``common.ascii_words`` finds them."""
    words = F.split(F.translate("text", ascii_uppercase, ascii_lowercase), "[\\x20\\x09-\\x0D]+")
    held = sample.select("label", F.filter(words, lambda w: w != "").alias("words"))

    def context(w: Column, at: Column) -> Column:
        before, after = (F.coalesce(F.get("words", k), F.lit("")) for k in (at - 1, at + 1))
        return F.struct(w.alias("word"), F.xxhash64(before, w, after).alias("context"))

    met = held.select("label", F.explode(F.transform("words", context)).alias("met")).select("label", "met.*")
    count = lambda label: F.count_if(F.col("label") == label)
    return met.distinct().groupBy("word").agg(count(1).alias("toxic"), count(0).alias("ordinary"))


def _summary(gains: np.ndarray, thresholds: Iterable[int]) -> list[int]:
    """Number of windows, the largest gain, and how many gains reach each threshold."""
    top = int(gains.max()) if len(gains) else 0
    return [len(gains), top, *(int((gains >= t).sum()) for t in thresholds)]


def _features(windows: int, top: int, hits: int) -> list[float]:
    return [1.0, math.log1p(hits), min(float(top), 8.0) / 4, hits / max(1, windows) ** 0.5]


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - y)) + ridge * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        beta -= np.clip(step, -2, 2)
    return beta


def fit_toxicity(
    sample: DataFrame,
    sizes: dict[int, int],
    toxic_bytes: int = 8192,
    ordinary_bytes: int = 16384,
    least_contexts: int = 6,
    least_log_ratio: float = 3.0,
    least_z: float = 2.5,
) -> ToxicityModel:
    """Train both dictionaries, the window threshold and the calibration on the rows
    of ``labelled.drawn_rows`` (a written table).

    Without a toxic or an ordinary text the model has no toxic content and its
    scores are the classes' smoothed share.
    """
    words = c.materialise(word_contexts(sample), "contexts")
    total = words.agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).first()
    n_bad, n_good = max(1, total["toxic"] or 0), max(1, total["ordinary"] or 0)
    own = []
    for r in words.where(F.col("toxic") >= least_contexts).collect() if total["ordinary"] else []:
        a, b = r["toxic"], r["ordinary"]
        ratio = math.log((a + 0.5) / n_bad) - math.log((b + 0.5) / n_good)
        if ratio >= least_log_ratio and ratio / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= least_z:
            own.append((a, r["word"].encode()))
    own.sort()
    picked = {w for _, w in own}
    known = "ordinary" if total["ordinary"] else "toxic"
    top = words.where(F.col(known) > 0).orderBy(F.desc(known), F.desc("word")).select("word").limit(USUAL_WORDS + len(own))
    usual = [w for w in (r["word"].encode() for r in top.collect()) if w not in picked][:USUAL_WORDS]
    toxic = (b" " + b" ".join(w for _, w in own) + b" ")[-toxic_bytes:] if own else b""
    ordinary = (b" " + b" ".join(usual[::-1]) + b" ")[-ordinary_bytes:]
    frame = (b" ".join(usual[:60]) + b" 0123456789 abcdefghijklmnopqrstuvwxyz " * 4).ljust(160, b".")
    model = ToxicityModel(ordinary, toxic, b" " + frame[:95] + b" ", b" " + frame[100:140])
    summary = window_summary(model, "text") if own else F.lit(None)
    rows = sample.select("id", "nth", "label", summary.alias("summary")).collect()
    rows.sort(key=lambda r: (r["id"], r["nth"]))
    weights = class_weights([(None, r["label"]) for r in rows], sizes)
    y = np.array([r["label"] for r in rows], float)
    w = np.array([weights[r["label"]] for r in rows], float)
    if not own or not len(y) or y.min() == y.max():
        share = (float((w * y).sum()) + 0.5) / (float(w.sum()) + 2.0) if len(y) else 0.25
        return ToxicityModel(ordinary, b"", model.head, model.tail, 1, (math.log(share / (1 - share)), 0.0, 0.0, 0.0), "none")

    def fitted(t: int):
        x = np.array([_features(n, top, hits[t - THRESHOLDS[0]]) for n, top, *hits in (r["summary"] for r in rows)])
        beta = _logistic(x, y, w)
        wrong = float((w * ((x @ beta >= 0) != (y == 1))).sum())
        loss = float((w * np.logaddexp(0, np.where(y == 1, -(x @ beta), x @ beta))).sum())
        return wrong, loss, t, tuple(beta)

    _, _, t, beta = min(fitted(t) for t in THRESHOLDS)
    name = xxhash.xxh3_64_hexdigest(ordinary + toxic)
    return ToxicityModel(ordinary, toxic, model.head, model.tail, t, beta, name)


_kept: dict[str, WindowGain] = {}


def _gains(model: ToxicityModel) -> WindowGain:
    if model.name not in _kept or _kept[model.name].model != model:
        for gain in _kept.values():
            gain.clear()
        _kept.clear()
        _kept[model.name] = c.hold("toxicity", WindowGain(model))
    return _kept[model.name]


def window_summary(model: ToxicityModel, text: str | Column = "text") -> Column:
    """Array column: the ``_summary`` of a whole text's gains for ``THRESHOLDS``."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c.claim("toxicity")
        gains = _gains(model)
        for texts in batches:
            yield pd.Series([_summary(gains.of(t), THRESHOLDS) for t in texts])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<int>")(F.col(text) if isinstance(text, str) else text)


def toxicity_score(model: ToxicityModel, text: str | Column = "text") -> Column:
    """Score column, 0 to 1, over whole texts; NULL counts as the empty text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c.claim("toxicity")
        gains = _gains(model)
        beta = np.array(model.weights)
        for texts in batches:
            x = [_features(*_summary(gains.of(t), (model.threshold,))) for t in texts]
            x = np.array(x).reshape(len(texts), 4)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ beta, -30, 30))))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(F.col(text) if isinstance(text, str) else text)


def train(
    docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
    toxic_rows: int = 1500, ordinary_rows: int = 4500,
) -> ToxicityModel:
    """Fit on at most ``toxic_rows`` and ``ordinary_rows`` labelled rows for which
    ``may_learn`` holds (rows of labels: id_col, toxic)."""
    sample, sizes = drawn_rows(
        docs, labels, "toxic", may_learn, {1: toxic_rows, 0: ordinary_rows}, id_col=id_col, text_col=text_col
    )
    return fit_toxicity(sample, sizes)


def score_documents(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, score double, predicted int) for every row, repeated rows and NULL
    ids included; other columns are not read; an empty table gives no rows."""
    scored = docs.select(F.col(id_col).alias(id_col), toxicity_score(model, F.col(text_col).cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
