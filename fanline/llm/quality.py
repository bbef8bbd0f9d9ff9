"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

A text is read as runs of letters or digits and runs of signs; a token equal to
the one before counts as the token "=". One- and two-token runs are hashed into
``2**bits`` places; a text's vector holds each place's share of its n-grams.
The follow-the-regularised-leader updates run over a bounded labelled sample, whose
texts stay in Spark; scoring is a sparse dot product of that vector with the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm.labelled import class_weights, drawn_rows

_TOKEN = regex.compile(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+")
#: entries of a worker's memo of token hashes; emptied when full
MEMO_TOKENS = 300_000


@dataclass(frozen=True)
class FtrlRule:
    """bits: log2 of the hashed places; alpha, beta, l1, l2: the FTRL-proximal
    settings; passes: passes over the sample; scale: factor on the shares."""

    bits: int = 18
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    passes: int = 4
    scale: float = 20.0


@dataclass(frozen=True)
class QualityModel:
    bias: float
    weights: np.ndarray  # float32, 2**bits
    rule: FtrlRule


class TokenMemo(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO_TOKENS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass"))
        if len(token) <= 64:
            self[token] = h
        return h


_memo = c.hold("quality", TokenMemo())
_REPEAT = np.uint64(xxhash.xxh3_64_intdigest(b"="))
_PAIR = c.seeds(2, 23) | np.uint64(1)


def places(text, rule: FtrlRule) -> tuple[np.ndarray, np.ndarray]:
    """(sorted places, counts) of a whole text's n-grams."""
    tokens = _TOKEN.findall(c.text_of(text).lower())
    h = np.fromiter(map(_memo.__getitem__, tokens), np.uint64, len(tokens))
    if len(h) > 1:
        same = np.concatenate(([False], h[1:] == h[:-1]))
        h = np.where(same, _REPEAT, h)
    grams = np.concatenate((c.mix64(h), c.mix64(h[:-1] * _PAIR[0] + h[1:] * _PAIR[1])))
    at = (grams >> np.uint64(64 - rule.bits)).astype(np.int64)
    return np.unique(at, return_counts=True)


def shares(counts: np.ndarray, rule: FtrlRule) -> np.ndarray:
    return rule.scale * counts / max(1, counts.sum())


def vector(text, rule: FtrlRule) -> tuple[np.ndarray, np.ndarray]:
    at, n = places(text, rule)
    return at, shares(n, rule)


def text_vectors(rule: FtrlRule, text: str | Column = "text") -> Column:
    """Struct column (digest of the text, places, counts): ``places`` as 32-bit numbers."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c.claim("quality")
        for texts in batches:
            found = [places(t, rule) for t in texts]
            yield pd.DataFrame(
                {
                    "digest": [xxhash.xxh3_64_hexdigest(t.encode("utf-8", "surrogatepass")) for t in texts],
                    "places": [at.astype(np.int32).tobytes() for at, _ in found],
                    "counts": [n.astype(np.int32).tobytes() for _, n in found],
                }
            )

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    made = F.pandas_udf(run, "digest string, places binary, counts binary")
    return made(F.col(text) if isinstance(text, str) else text)


def fit_ftrl(sample: DataFrame, sizes: dict[int, int], rule: FtrlRule = FtrlRule()) -> QualityModel:
    """FTRL-proximal over the rows of ``labelled.drawn_rows``, in an order fixed by the
    texts' hashes. Texts are read by the tasks; the driver gets their places and counts."""
    size = 1 << rule.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rows = sample.select("id", "nth", "label", text_vectors(rule).alias("vector")).collect()
    rows.sort(key=lambda r: (r["vector"]["digest"], r["id"], r["nth"]))
    weights = class_weights([(None, r["label"]) for r in rows], sizes)

    def weight(at):
        za, na = z[at], n[at]
        shrunk = -(za - np.sign(za) * rule.l1) / ((rule.beta + np.sqrt(na)) / rule.alpha + rule.l2)
        return np.where(np.abs(za) <= rule.l1, 0.0, shrunk)

    for _ in range(rule.passes):
        for r in rows:
            _, at, v = r["vector"]
            at = np.append(np.frombuffer(at, np.int32), size)
            v = np.append(shares(np.frombuffer(v, np.int32), rule), 1.0)
            w = weight(at)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ v)))))
            g = weights[r["label"]] * (p - r["label"]) * v
            g2 = g * g
            z[at] += g - (np.sqrt(n[at] + g2) - np.sqrt(n[at])) / rule.alpha * w
            n[at] += g2
    all_w = weight(np.arange(size + 1))
    return QualityModel(float(all_w[size]), all_w[:size].astype(np.float32), rule)


def quality_score(model: QualityModel, text: str | Column = "text") -> Column:
    """Score column, 0 to 1, over whole texts; NULL counts as the empty text,
    whose score comes from the bias alone."""
    weights, bias, rule = model.weights, model.bias, model.rule

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c.claim("quality")
        for texts in batches:
            out = np.empty(len(texts))
            for k, t in enumerate(texts):
                at, v = vector(t, rule)
                out[k] = bias + float(weights[at] @ v)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(F.col(text) if isinstance(text, str) else text)


def train(
    docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
    good_rows: int = 4000, poor_rows: int = 2500, rule: FtrlRule = FtrlRule(),
) -> QualityModel:
    """Fit on at most ``good_rows`` and ``poor_rows`` labelled rows for which
    ``may_learn`` holds (rows of labels: id_col, quality)."""
    sample, sizes = drawn_rows(
        docs, labels, "quality", may_learn, {1: good_rows, 0: poor_rows}, id_col=id_col, text_col=text_col
    )
    return fit_ftrl(sample, sizes, rule)


def score_documents(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, score double, predicted int) for every row, repeated rows and NULL
    ids included; other columns are not read; an empty table gives no rows."""
    scored = docs.select(F.col(id_col).alias(id_col), quality_score(model, F.col(text_col).cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
