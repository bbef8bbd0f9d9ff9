"""Tables written on the way go once nothing reads them, and small steps write few files."""

import itertools
import random

import pytest
from conftest import words

import corpus_pipeline
from fanline.llm import common as c
from fanline.llm.components import connected_components
from fanline.llm.paragraph_dedup import remove_repeats


@pytest.fixture
def left(monkeypatch, tmp_path):
    """Lists the labels of the tables that are there, in the order written."""
    n = itertools.count()
    monkeypatch.setattr(c, "shared_path", lambda _, label: f"{tmp_path}/{next(n):04d}-{label}")
    return lambda: [p.name[5:] for p in sorted(tmp_path.iterdir())]


def test_steps_of_components_leave_one_table_of_few_files(spark, left, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {x: spark.conf.get(x) for x in names}
    for x, value in zip(names, ("64", "false"), strict=True):
        spark.conf.set(x, value)
    try:
        links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501)], "a long, b long")
        found = connected_components(links)
        assert left() == ["cc-small"]
        assert len(list(tmp_path.glob("*/*.parquet"))) <= spark.sparkContext.defaultParallelism
        got = {r.node: r.component for r in found.collect()}
    finally:
        for x, value in before.items():
            spark.conf.set(x, value)
    assert got == {i: 0 for i in range(301)} | {500: 500, 501: 500}


def test_repeats_leave_only_what_the_result_reads(make_docs, left):
    rng = random.Random(3)
    line, run = " ".join(words(rng, 30)), " ".join(words(rng, 60))
    other = " ".join(f"u{k}" for k in range(60))
    rows = [(1, f"{line}\n{run} end"), (2, f"start\n{line}"), (3, f"{other} {run} tail"), (4, "a few words")]
    out = remove_repeats(make_docs(rows))
    assert left() == ["gone", "runs", "cuts"]
    got = {r.doc_id: (r.text, r.n_removed) for r in out.collect()}
    assert got == {1: (rows[0][1], 0), 2: ("start", 1), 3: (f"{other} tail", 1), 4: ("a few words", 0)}


def test_copies_leave_only_what_the_stage_reads(spark, make_docs, left):
    rng = random.Random(4)
    text = " ".join(words(rng, 100))
    out = corpus_pipeline.keep_one_of_each(
        spark, make_docs([(1, text), (2, text), (3, f"{text} more"), (4, " ".join(words(rng, 100)))]), ""
    )
    assert left() == ["copies"]
    assert sorted(r.doc_id for r in out.collect()) == [1, 4]


def test_tables_go_after_an_error_and_inner_ones_before_outer_ones(spark, left):
    def inner():
        return c.materialise(spark.range(3), "one")

    def outer():
        table = c.materialise_alone(inner, "two")
        assert left() == ["two"]
        return table

    assert c.materialise_alone(outer, "three").count() == 3 and left() == ["three"]

    def fails():
        c.materialise(spark.range(3), "four")
        raise ValueError

    with pytest.raises(ValueError):
        c.materialise_alone(fails, "five")
    assert left() == ["three"]
