"""The registered queries and the pipeline's stages on the smallest tables."""

import duckdb
import pytest
from llm_tools import SF_SMALL, components, shingles

import __spark_entry__ as E
import corpus_pipeline
from fanline.llm import common as c
from fanline.llm.queries import ORACLES, QUERIES


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in got.select(*names).collect())


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, as {doc_id: text} but for the last."""
    docs = c.read_table(spark, SF_SMALL, "documents")
    seen = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = c.materialise(stage(spark, docs, SF_SMALL), f"test-{name}")
        seen.append((name, docs))
    return dict(seen)


def test_stage_columns_and_order(stages):
    names = list(stages)
    assert names == ["documents", "toxicity", "quality", "minhash_near_dedup", "paragraph_dedup", "packing"]
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_filters_only_drop_and_keep_texts(spark, stages):
    texts = {r.doc_id: r.text for r in stages["documents"].collect()}
    labels = {r.doc_id: r for r in c.read_table(spark, SF_SMALL, "labels").collect()}
    before = texts
    for name, column, keep in (("toxicity", "toxic", 0), ("quality", "quality", 1)):
        now = {r.doc_id: r.text for r in stages[name].collect()}
        assert set(now) <= set(before) and all(before[i] == t for i, t in now.items())
        known = [i for i in before if i in labels]
        agree = sum((i in now) == (labels[i][column] == keep) for i in known)
        assert agree >= 0.9 * len(known)
        clean = [i for i in known if labels[i][column] == keep]
        assert sum(i in now for i in clean) >= 0.97 * len(clean)
        before = now


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: shingles(r.text, 5) for r in stages["quality"].collect()}
    ids = sorted(before)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if before[a] and before[b] and 100 * len(before[a] & before[b]) >= 80 * len(before[a] | before[b])
    ]
    first = components(ids, links)
    assert {r.doc_id for r in stages["minhash_near_dedup"].collect()} == {i for i in ids if first[i] == i}


def test_passages_leave_and_lengths_follow(stages):
    before = {r.doc_id: r.text for r in stages["minhash_near_dedup"].collect()}
    rows = stages["paragraph_dedup"].collect()
    assert {r.doc_id for r in rows} == set(before)
    seen, runs = set(), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        assert r.n_chars == len(r.text)
        # only words leave, in order: what stays is a subsequence of what was
        left = iter(before[r.doc_id].split())
        assert all(w in left for w in r.text.split())
        for line in r.text.split("\n"):
            if len(line.split()) >= 20:
                assert line not in seen
                seen.add(line)
        w = r.text.split()
        for k in range(len(w) - 50 + 1):
            runs.setdefault(tuple(w[k : k + 50]), set()).add(r.doc_id)
    # no run of 50 words that two documents held before is still held by both
    was = {}
    for i, t in before.items():
        w = t.split()
        for k in range(len(w) - 50 + 1):
            was.setdefault(tuple(w[k : k + 50]), set()).add(i)
    assert any(len(v) > 1 for v in was.values())
    assert not [g for g, v in runs.items() if len(v) > 1 and len(was.get(g, ())) > 1]


def test_packing_holds_every_document(stages):
    rows = stages["packing"].collect()
    docs = {r.doc_id for r in stages["paragraph_dedup"].collect()}
    assert {r.doc_id for r in rows} == docs
    per_doc, per_seq = {}, {}
    for r in rows:
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.length
        per_seq[r.sequence_id] = per_seq.get(r.sequence_id, 0) + r.length
    assert all(per_doc[r.doc_id] == r.doc_tokens for r in rows)
    assert all(n == 2048 or n & (n - 1) == 0 for n in per_seq.values())
