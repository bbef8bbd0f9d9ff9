"""op2 and op8: held-out accuracy, folds, and inputs of a score."""

import random
import tracemalloc
import zlib

import pytest
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm import quality, toxicity
from fanline.llm.labelled import class_weights, fold_is, labelled_sample

PLAIN = [a + b + d for a in ("th", "on", "re", "st", "me") for b in ("an", "er", "in", "ou") for d in ("d", "s", "ing", "t", "")]
RUDE = [a + b for a in ("vequ", "scum", "chlla", "worthless") for b in ("", "ta", "oir")]


def corpus(seed, n, poor=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = [rng.choice(PLAIN) + rng.choice(["", "", rng.choice(PLAIN)]) for _ in range(rng.randrange(20, 150))]
        y = rng.random() < 0.25
        if y and poor:
            t = [w + rng.choice(["%%%", "&&&", "!!"]) for w in t]
        elif y:
            for _ in range(rng.randrange(2, 6)):
                t.insert(rng.randrange(len(t)), rng.choice(RUDE))
        rows.append((i, " ".join(t), int(y)))
    return rows


@pytest.fixture(scope="module", params=["toxic", "quality"])
def case(request, spark):
    rows = corpus(1, 900, poor=request.param == "quality")
    rows = [(i, t, 1 - y if request.param == "quality" else y) for i, t, y in rows]
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], f"doc_id long, {request.param} int, text string")
    return request.param, rows, labels


def test_held_out_accuracy(spark, make_docs, case):
    kind, rows, labels = case
    operator = toxicity if kind == "toxic" else quality
    held = fold_is("doc_id", 5, 0)
    docs = make_docs([r[:2] for r in rows] + [(None, None), (5000, None), (5001, ""), (5001, ""), (5002, "%%% " * 9000)])
    model = operator.train(docs, labels, ~held)
    got = operator.score_documents(docs, model).withColumn("held", held).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: y for i, _, y in rows}
    for r in got:
        assert r.held == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    fold = [r for r in got if r.held and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in fold) >= 0.97 * len(fold)
    empty = [r.score for r in got if r.doc_id in (5000, 5001)]
    assert len(set(empty)) == 1  # NULL and empty texts score alike
    assert operator.score_documents(make_docs([]), model).count() == 0


def test_labels_out_of_the_fold_are_not_learned(spark, make_docs, case):
    """Turning the held-out labels round changes no score."""
    kind, rows, labels = case
    operator = toxicity if kind == "toxic" else quality
    held = fold_is("doc_id", 5, 0)
    docs = make_docs([r[:2] for r in rows])
    turned = labels.withColumn(kind, F.when(held, 1 - F.col(kind)).otherwise(F.col(kind)))
    scores = [
        sorted((r.doc_id, r.score) for r in operator.score_documents(docs, operator.train(docs, x, ~held)).collect())
        for x in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    docs = make_docs([(1, "a b c"), (2, None)])
    for operator in (toxicity, quality):
        got = operator.score_documents(docs, operator.train(docs, none, F.lit(True))).collect()
        assert len(got) == 2 and all(0 <= r.score <= 1 for r in got)


def test_sample_is_bounded_and_weighted(spark, make_docs):
    docs = make_docs([(i, "x" * (10 + i)) for i in range(100)] + [(100, "y" * 300), (101, None)])
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(102)] + [(None, 1), (4, 0), (5, None)], "doc_id long, toxic int"
    )
    sample, sizes = labelled_sample(docs, labels, "toxic", F.lit(True), {1: 10, 0: 20}, max_chars=200)
    assert sizes == {1: 26, 0: 76}
    assert sum(y for _, y in sample) <= 10 and sum(1 - y for _, y in sample) <= 20
    w = class_weights(sample, sizes)
    assert abs(sum(w[y] for _, y in sample) - len(sample)) < 1e-9


def test_texts_of_the_sample_stay_out_of_the_driver(spark):
    word = "concat(if(id % 4 = 0 AND i % 10 = 0, 'rude', 'w'), pmod(xxhash64(id, i), 20))"
    docs = spark.range(600).selectExpr("id AS doc_id", f"concat_ws(' ', transform(sequence(1, 10000), i -> {word})) AS text")
    labels = spark.range(600).selectExpr("id AS doc_id", "int(id % 4 = 0) AS toxic", "int(id % 4 = 0) AS quality")
    docs = c.materialise(docs, "test")
    size = docs.selectExpr("sum(length(text))").first()[0]
    for operator in (toxicity, quality):
        tracemalloc.start()
        model = operator.train(docs, labels, F.lit(True))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < size
        assert operator.score_documents(docs, model).count() == 600


def test_word_contexts_equal_plain_counting(spark):
    texts = [
        ("A b a b\ta\x0bB  A\x85b \x1cb É é\u00a0é İ", 1), ("a b a b a", 1), ("b A c", 0), ("", 0), (" \r\n", 0),
        ("one", 0), ("漢 字\x0c漢 字", 0), ("\x00 a \x00", 1), ("a b a b a", 0),
    ]
    met = {}
    for text, label in texts:
        w = ["", *(x.decode() for x in c.ascii_words(text)), ""]
        for k in range(1, len(w) - 1):
            met.setdefault(w[k], ({}, {}))[label][w[k - 1], w[k + 1]] = 1
    got = toxicity.word_contexts(spark.createDataFrame(texts, "text string, label int")).collect()
    assert {r.word: (r.ordinary, r.toxic) for r in got} == {w: (len(a), len(b)) for w, (a, b) in met.items()}
    assert len(got) == len(met)
