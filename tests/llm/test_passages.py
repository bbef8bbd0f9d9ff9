"""op4: removed paragraphs equal a brute-force comparison."""

import random

from llm_tools import components, shingles
from pyspark.sql import functions as F

from fanline.llm.paragraph_dedup import PassageRule, remove_repeats, repeated_paragraphs


def brute(rows, rule):
    paras = {}
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            if i is not None and len(line.split()) >= rule.min_words:
                paras[i, k] = shingles(line, rule.width)
    keys = sorted(paras)
    links = [
        (a, b)
        for n, a in enumerate(keys)
        for b in keys[n + 1 :]
        if 100 * len(paras[a] & paras[b]) >= rule.percent * len(paras[a] | paras[b])
    ]
    first = components(keys, links)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        out[i] = [x for k, x in enumerate(lines) if i is None or first.get((i, k), (i, k)) == (i, k)]
    return out


def test_repeats_equal_brute_force(make_docs):
    rng = random.Random(11)
    passages = [[f"p{rng.randrange(5000)}" for _ in range(rng.choice([12, 20, 25, 60, 90]))] for _ in range(9)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.4:
                p = list(rng.choice(passages))
                for _ in range(rng.randrange(0, 4)):
                    p[rng.randrange(len(p))] = f"q{rng.randrange(10**6)}"
                lines.append(" ".join(p))
            else:
                lines.append(" ".join(f"u{rng.randrange(10**5)}" for _ in range(rng.choice([3, 22, 40]))))
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, rows[0][1]), (103, rows[0][1])]
    rows += [(104, "Straße Ünï " * 30 + "\n" + "Straße Ünï " * 30)]
    rule = PassageRule()
    want = brute(rows, rule)
    out = remove_repeats(make_docs(rows), rule)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.columns[-1] == "n_removed"
    got = {r.doc_id: r for r in out.collect()}
    removed = 0
    for i, t in rows:
        if i is None or t is None:
            assert got[i].text == t and got[i].n_removed == 0
            continue
        assert got[i].text == "\n".join(want[i])
        assert got[i].n_removed == len(t.split("\n")) - len(want[i])
        removed += got[i].n_removed
    assert removed > 10
    # a document whose paragraphs all repeat earlier ones keeps only its short lines
    assert all(len(x.split()) < rule.min_words for x in got[103].text.split("\n"))


def test_repeated_rows_and_empty_table(make_docs):
    text = " ".join(f"a{k}" for k in range(40))
    rows = make_docs([(1, text), (1, text), (2, text)])
    got = sorted((r.doc_id, r.n_removed) for r in remove_repeats(rows).collect())
    assert got == [(1, 0), (1, 0), (2, 1)]
    gone = repeated_paragraphs(rows).collect()
    assert {(r.doc, r["pos"], r.first_doc, r.first_pos) for r in gone} == {(2, 0, 1, 0)}
    assert remove_repeats(make_docs([])).count() == 0


def test_bands_reach_the_recall():
    rule = PassageRule()
    miss = (1 - (rule.percent / 100) ** rule.rows) ** rule.bands
    assert miss <= 1 - rule.recall
    assert rule.similarity.hashes >= rule.bands * rule.rows


def test_columns_named_like_the_operators_own(make_docs):
    text = " ".join(f"a{k}" for k in range(70))
    rows = make_docs([(1, text), (2, text + "\nshort"), (3, "before " + text), (4, None)])
    plain = {r.doc_id: (r.text, r.n_removed) for r in remove_repeats(rows).collect()}
    assert plain[2] == ("short", 1) and plain[3][1] == 1
    names = ["__doc", "__GONE", "__runs", "__cut", "__doc_", "doc", "pos", "h", "n_removed"]
    odd = remove_repeats(rows.withColumns({x: F.lit(f"own {x}") for x in names}))
    assert odd.columns[-1] == "n_removed" and set(names) <= set(odd.columns)
    for r in odd.collect():
        assert (r.text, r.n_removed) == plain[r.doc_id]
        assert all(r[x] == f"own {x}" for x in names[:-1])


def test_texts_without_repeats_stay_where_they_are(make_docs, monkeypatch):
    """Only documents that may hold a repeat are joined with what was found."""
    rng = random.Random(3)
    lines = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(400)]
    rows = list(enumerate(lines)) + [(1000, lines[5] + "\n" + lines[9])]
    docs = make_docs(rows)
    joined = []
    real = type(docs).join

    def join(self, other, on=None, how=None):
        if "text" in self.columns and not {"__at", "__bits"} & set(other.columns):
            joined.append(self.count())
        return real(self, other, on, how)

    monkeypatch.setattr(type(docs), "join", join)
    got = {r.doc_id: r for r in remove_repeats(docs, PassageRule(running=50)).collect()}
    assert got[1000].text == "" and got[1000].n_removed == 2
    assert all(got[i].text == t and got[i].n_removed == 0 for i, t in rows[:-1])
    assert joined and max(joined) < 100
