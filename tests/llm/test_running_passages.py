"""op4: words in a row that stand at an earlier place leave, wherever lines break."""

import random

from fanline.llm.paragraph_dedup import remove_repeats


def brute(rows, length):
    first, left = {}, {}
    for i, t in sorted(rows):
        w = t.split()
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), (i, k))
    for i, t in rows:
        w, gone = t.split(), set()
        for k in range(len(w) - length + 1):
            d, p = first[tuple(w[k : k + length])]
            if d != i or k >= p + length:
                gone |= set(range(k, k + length))
        left[i] = [x for k, x in enumerate(w) if k not in gone]
    return left


def test_runs_inside_lines_and_over_short_lines(make_docs):
    rng = random.Random(8)

    def own(n):
        return [f"u{rng.randrange(10**7)}" for _ in range(n)]

    passages = [own(n) for n in (50, 57, 80, 130)]
    rows = []
    for i in range(40):
        w = own(rng.randrange(60, 200))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            a = rng.randrange(len(w))
            w[a:a] = p
        size = rng.choice([7, 13, 10**6])  # short lines or a single one
        rows.append((i, "\n".join(" ".join(w[k : k + size]) for k in range(0, len(w), size))))
    rows += [(50, " ".join(passages[0][:49])), (51, "a " * 200)]
    want = brute(rows, 50)
    got = {r.doc_id: r for r in remove_repeats(make_docs([*rows, (None, rows[0][1]), (60, None), (61, "")])).collect()}
    assert {i: got[i].text.split() for i, _ in rows} == want
    assert sum(len(t.split()) - len(want[i]) for i, t in rows) > 1000
    assert all((got[i].n_removed > 0) == (len(want[i]) < len(t.split())) for i, t in rows)
    assert got[None].text == rows[0][1] and got[60].text is None and got[61].text == ""
    texts = [t for i, t in rows if want[i] == t.split()]
    assert texts and all(got[i].text == t for i, t in rows if t in texts)
