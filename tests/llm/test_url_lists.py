"""op5: every capture's verdict equals a replay of the list in plain Python."""

import datetime as dt
import random
import re

from fanline.llm.url_lists import filter_captures, validity_intervals

DAY0 = dt.date(2024, 1, 1)


def host_of(url):
    m = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)(?:/([^/?#]+))?", (url or "").strip())
    if not m:
        return "", ""
    host = re.sub(":[0-9]*$", "", m[1].rpartition("@")[2]).rstrip(".").lower()
    return host, m[2] or ""


def replay(captures, entries):
    out = []
    for i, url, day in captures:
        host, segment = host_of(url)
        labels = host.split(".")
        best = None
        if host and day and len(labels) <= 127:
            names = [".".join(labels[k:]) for k in range(len(labels))]
            names += [n + "/" + segment for n in names if segment]
            for name in names:
                log = {}
                for p, d, a in entries:
                    if p and d and a in ("add", "remove") and d <= day:
                        head, slash, tail = p.partition("/")
                        if head.lower() + slash + tail == name:
                            log[d] = max(log.get(d, ""), "b" if a == "add" else "a")
                if log and log[max(log)] == "b":
                    cand = (-len(name), name, max(log))
                    best = min(best, cand) if best else cand
        out.append((i, host, day, best is not None, best and best[1], best and best[2]))
    return sorted(out, key=repr)


def test_captures_against_a_replayed_list(spark):
    rng = random.Random(8)
    names = ["a.example", "b.example", "x.a.example", "Example", "b.example/ads", "x.a.example/News", "long.b.example"]
    entries = [
        (rng.choice(names), DAY0 + dt.timedelta(rng.randrange(60)), rng.choice(["add", "add", "remove"])) for _ in range(60)
    ]
    entries += entries[:3] + [(None, DAY0, "add"), ("a.example", None, "add"), ("a.example", DAY0, "other"), ("c", DAY0, None)]
    hosts = ["a.example", "x.a.example", "y.X.a.Example.", "b.example:8080", "user@b.example", "long.b.example", "z.test", "c"]
    urls = [f"{s}//{h}{p}" for s in ("http:", "https:", "") for h in hosts for p in ("", "/", "/ads", "/ads/x?y#z", "/News?q", "?x")]
    urls += [None, "", "no host", "http:///path", "mailto:a@b.example", " http://a.example/ ", "http://" + "a." * 200 + "example/"]
    captures = [(k, rng.choice(urls), DAY0 + dt.timedelta(rng.randrange(-3, 70))) for k in range(900)]
    captures += [(None, urls[0], DAY0), (5000, urls[0], None), (1, urls[3], DAY0)] + [(6000 + k, "http://a.example/", DAY0) for k in range(300)]
    df = spark.createDataFrame([(*r, "p", "s", "w") for r in captures], "page_id long, url string, day date, pattern string, segment string, host string")
    log = spark.createDataFrame([(*e, 1) for e in entries], "pattern string, day date, action string, listed int")
    got = sorted((tuple(r) for r in filter_captures(df, log).collect()), key=repr)
    assert got == replay(captures, entries)
    assert any(r[3] for r in got) and not all(r[3] for r in got)
    none = filter_captures(df, log.where("false")).collect()
    assert len(none) == len(captures) and not any(r.listed for r in none)
    assert filter_captures(df.where("false"), log).count() == 0


def test_intervals_of_a_pattern_do_not_overlap(spark):
    day = lambda n: DAY0 + dt.timedelta(n)
    log = [("A.b", day(1), "add"), ("a.b", day(1), "remove"), ("a.b", day(4), "remove"), ("a.b", day(6), "add"), ("a.b", day(9), "add")]
    df = spark.createDataFrame(log, "pattern string, day date, action string")
    got = sorted((r.pattern, r.start, r.stop) for r in validity_intervals(df).collect() if r.stop) + [
        (r.pattern, r.start) for r in validity_intervals(df).collect() if not r.stop
    ]
    assert got == [("a.b", day(1), day(4)), ("a.b", day(6), day(9)), ("a.b", day(9))]
