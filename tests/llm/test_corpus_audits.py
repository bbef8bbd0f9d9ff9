"""op11, op12 and op13 against plain-Python forms, odd rows included."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from llm_tools import lower_words

from fanline.llm import license_scan as ls
from fanline.llm.filter_audit import MaskDiagram, adjacent_swaps, filter_audit
from fanline.llm.source_divergence import divergence_audit, term_counts

SCHEMA = "doc_id long, text string, lang string, source string, part string, mask int, term string, bundle long, words string"


def table(spark, rows):
    """Rows (doc_id, text, lang, source) with further columns whose names clash."""
    return spark.createDataFrame([(*r, "p", 1, "t", 2, "w") for r in rows], SCHEMA).repartition(3)


# ---- op12


def audit_brute(rows, labels):
    good, toxic = {}, {}
    for i, q, t in labels:
        if i is not None:
            good[i], toxic[i] = max(good.get(i, 0), int(q == 1)), max(toxic.get(i, 0), int(t == 1))
    least = {}
    for i, t, _, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    docs = []
    for i, t, _, s in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > least[t],
        }
        docs.append((s or "", {k for k, v in fails.items() if v}, good.get(i, 0), toxic.get(i, 0)))
    out = {}
    for part in {d[0] for d in docs}:
        own, total = [d for d in docs if d[0] == part], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone), sum(d[3] for d in gone),
                ]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in df.collect()}


def test_audit_of_odd_rows_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        w = [rng.choice(["word", "Word", "one", "TWO"]) + str(rng.randrange(rng.choice([3, 900]))) for _ in range(rng.choice([5, 199, 200, 260]))]
        rows.append((i, " ".join(w) + rng.choice(["", "", " #"]), "en", rng.choice(["a", "b", None])))
    rows += [(100 + k, rows[k][1], None, "a") for k in range(0, 60, 4)]
    rows += [(1, rows[1][1], "en", "b"), (-5, rows[2][1], "en", ""), (None, rows[2][1], "en", "c"), (None, None, None, None)]
    rows += [(200, None, "en", "c"), (201, "", "en", "c"), (202, " \t\n ", "en", "c"), (2**53 + 1, "É" * 50_000 + " A", "en", "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 60, 2), *range(0, 60, 6), 100, 200, None]]
    got = audit_rows(filter_audit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == audit_brute(rows, labels)
    assert len(got) == 4 * 600 and sum(v[0] for v in got.values()) > 0


def test_audit_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(table(spark, []), none).collect() == []
    assert len(filter_audit(table(spark, [(1, "x", "en", "s")]), none).collect()) == 600


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_adjacent_swaps_meet_every_order_once(n):
    order, seen = list(range(n)), [tuple(range(n))]
    for i in adjacent_swaps(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.append(tuple(order))
    assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_diagrams_share_nodes_and_survive_swaps():
    rng = random.Random(9)
    counts = {m: (rng.randrange(3), 0, 0) for m in range(32)}
    d = MaskDiagram(5, counts)
    assert all(len(level) <= 1 << k for k, level in enumerate(d.levels))
    assert len(MaskDiagram(5, {}).levels[4]) == 1  # all equal below: one node a level
    for i in adjacent_swaps(5):
        d.swap(i)
        for mask, want in counts.items():
            n = d.root
            for f in d.order:
                n = n.high if mask >> f & 1 else n.low
            assert n.counts == want
        for level in d.levels:
            assert len({(id(n.low), id(n.high)) for n in level}) == len(level)


# ---- op13


def divergence_brute(rows, least, top):
    docs = [(l or "", s or "", Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))) for _, t, l, s in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(w for d in own for w in d[2])
        kept = sorted(w for w, n in held.items() if n >= least)
        by = defaultdict(Counter)
        for _, s, t in own:
            by[s].update({w: n for w, n in t.items() if w in kept})
        share = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        q, p = share(sum(by.values(), Counter())), {}
        for s in {d[1] for d in own}:
            p[s] = share(by[s])
        for s in p:
            pair = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in p if o != s]
            term = [(p[s][w] - q[w], w) for w in kept if by[s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, w, v, k) for k, (v, w) in enumerate(found[:limit], 1)}
    return out


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(11)
    vocabulary = ["The", "the", "an-an", "a1b", "É", "Über-the", "x", "-", "42", "of,the", "Σς", "漢字"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    rows = []
    for i in range(150):
        w = [vocabulary[min(rng.randrange(len(vocabulary)), rng.randrange(len(vocabulary)))] for _ in range(rng.randrange(0, 40))]
        rows.append((i % 140, rng.choice([" ", "\n", "\t "]).join(w), rng.choice(["en", "en", "fr", None]), rng.choice(["s1", "s2", "s3", "é", None])))
    rows += [(None, None, None, None), (500, None, "xx", "alone"), (501, "", "yy", "one"), (502, "only", "yy", "two"), (503, "k " * 60_000, "en", "s1")]
    return rows


@pytest.mark.parametrize("chars", [10**6, 700])
def test_divergence_equals_brute_force(spark, mixed, chars, monkeypatch):
    from fanline.llm import source_divergence as sd

    if chars == 700:  # many bundles, several blocks of terms and tiles of sources
        monkeypatch.setattr(sd, "BLOCK_TERMS", 7)
        monkeypatch.setattr(sd, "TILE_SOURCES", 2)
    got = divergence_audit(table(spark, mixed), least_docs=5, top_terms=6, bundle_chars=chars).collect()
    want = divergence_brute(mixed, 5, 6)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert ("yy", "one", "pair", "two", 0, 1) in want


def test_terms_that_several_chunks_of_a_document_hold_count_one_document(spark):
    rows = [(i, "The the THE, (the)", "en", "s") for i in range(4)] + [(9, "the", "en", "t")]
    cells, _, terms = term_counts(table(spark, rows), least_docs=5)
    cells = cells.join(terms, "id")
    assert sorted((r.source, r.term, r.docs, r.n) for r in cells.collect()) == [("s", "the", 4, 16), ("t", "the", 1, 1)]


def test_divergence_of_an_empty_table(spark):
    assert divergence_audit(table(spark, [])).collect() == []


# ---- op11


def words_brute(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def license_brute(rows, percent):
    half = max(32, *(len(words_brute(t)) for t, _ in ls.TEMPLATES))
    out = []
    for i, t, _, _ in rows:
        w = words_brute(t)
        places = [(k, label) for p, label in ls.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        held = []
        for k in range(max(1, -(-len(w) // half) - 1)):
            block = set(w[k * half : (k + 2) * half])
            for template, label in ls.TEMPLATES:
                own = set(words_brute(template))
                if 100 * len(own & block) >= percent * len(own):
                    held.append((len(own & block) / len(own), label))
        base = {label for _, label in places}
        ks = [k for k, _ in places]
        out.append((
            i, len(w), len(ks), min(ks, default=None), max(ks, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {label for _, label in held})), 1.0 if ks else max([x for x, _ in held], default=0.0),
        ))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def licensed(odd_rows):
    rng = random.Random(2)
    rows = [(i, t, "en", "s") for i, t in odd_rows]
    common = ["the", "of", "software", "license", "and", "to", "is", "public"]
    for i in range(100, 180):
        w = [rng.choice(common) if rng.random() < 0.5 else f"u{rng.randrange(300)}" for _ in range(rng.randrange(0, 150))]
        for _ in range(rng.randrange(3)):
            own = words_brute(rng.choice(ls.TEMPLATES + ls.PHRASES)[0])
            for _ in range(rng.randrange(5)):
                own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = own
        rows.append((i, rng.choice([" ", "\n", "-", ", "]).join(w).title(), "en", None))
    rows += [(300, "cc by nc cc by nc", "", ""), (301, "under the mit licenses", "", ""), (302, "CC-BY/NC; Under the MIT License", "", "")]
    return rows


@pytest.mark.parametrize("percent", [80, 60, 100])
def test_license_scan_equals_brute_force(spark, licensed, percent):
    got = ls.license_scan(table(spark, licensed), percent=percent).collect()
    want = license_brute(licensed, percent)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(r[2] == 0 and r[6] != "" for r in want) >= 5
    assert (300, 6, 2, 0, 3, "cc-by-nc", "cc-by-nc", 1.0) in want


def test_license_matches_name_the_words(spark):
    notice = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    rows = [(1, "w " * 40 + notice, None, None), (2, notice.upper(), None, None), (3, "w " * 500, None, None)]
    got = {r.doc_id: r for r in ls.license_matches(table(spark, rows)).collect()}
    assert set(got) == {1, 2} and got[1].label == "bsd" and got[1].containment == 1.0 and got[1].template == ls.TEMPLATES[5][0]
    assert (got[2].first_word, got[2].last_word) == (0, len(lower_words(notice)) - 1)


def test_license_scan_of_an_empty_table_and_bad_templates(spark):
    assert ls.license_scan(table(spark, [])).collect() == []
    with pytest.raises(ValueError):
        ls.license_scan(table(spark, []), templates=[("--", "none")])
