"""Exact quantiles against numpy, plain and range-split, and merged sketches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fanline.operators.metrics import latency_stats
from fanline.operators.quantiles import exact_quantiles, merged_sketches, quantile_sketches, sketch_quantiles

WANTED = {"lo": 0.0, "q25": 0.25, "mid": 0.5, "q95": 0.95, "hi": 1.0}


def rows():
    rng = np.random.default_rng(5)
    out = [("hot", int(v)) for v in rng.integers(-500, 5000, 3000)]
    out += [("ties", 7)] * 50 + [("ties", 9)] * 50 + [("one", 3), ("none", None), ("pair", 1), ("pair", 2), ("pair", None)]
    return out + [(None, int(v)) for v in rng.integers(0, 9, 40)]


@pytest.mark.parametrize("threshold", [2_000_000, 40])
def test_equal_to_numpy_on_both_paths(spark, threshold):
    df = spark.createDataFrame(rows(), "g string, v long")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", WANTED, threshold).collect()}
    by = {}
    for g, v in rows():
        if v is not None:
            by.setdefault(g, []).append(v)
    assert set(got) == set(by)
    for g, vs in by.items():
        r = got[g]
        assert (r.n, r.least, r.most, r.total) == (len(vs), min(vs), max(vs), sum(vs))
        for name, p in WANTED.items():
            assert r[name] == pytest.approx(np.quantile(vs, p), abs=1e-9), (g, name)


def test_doubles_and_several_group_columns(spark):
    df = spark.createDataFrame([("a", i % 3, i / 7) for i in range(500)], "g string, h int, v double")
    got = {(r.g, r.h): r.mid for r in exact_quantiles(df, ["g", "h"], "v", {"mid": 0.5}, 20).collect()}
    for h in range(3):
        assert got["a", h] == pytest.approx(np.quantile([i / 7 for i in range(500) if i % 3 == h], 0.5))


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, v long")
    assert exact_quantiles(df, ["g"], "v", WANTED).count() == 0
    assert latency_stats(df, ["g"], "v").columns == ["g", "n", "min_ms", "max_ms", "mean_ms", "p50_ms", "p95_ms", "p99_ms"]


def test_no_group_map_is_kept(spark):
    df = spark.createDataFrame(rows(), "g string, v long")
    plan = exact_quantiles(df, ["g"], "v", WANTED)._jdf.queryExecution().toString()
    assert "percentile" not in plan and "CartesianProduct" not in plan


def test_sketches_merge_over_days(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 2).alias("g"), (F.col("id") % 10).alias("day"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v")
    )
    days = quantile_sketches(df, ["g", "day"], "v")
    merged = sketch_quantiles(merged_sketches(days, ["g"]), ["g"], {"mid": 0.5, "q95": 0.95})
    exact = {r.g: r for r in exact_quantiles(df, ["g"], "v", {"mid": 0.5, "q95": 0.95}).collect()}
    got = merged.collect()
    assert len(got) == 2 and all(r.n == 20_000 for r in got)
    for r in got:
        assert abs(r.mid - exact[r.g].mid) <= 15 and abs(r.q95 - exact[r.g].q95) <= 15
