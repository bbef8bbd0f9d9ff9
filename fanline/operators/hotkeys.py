"""Hot keys: detection, and keyed running computations that never gather a key.

A key (a queue, a subscriber, a work item) may hold a third of all rows.
``keyed_window`` computes running aggregates per key in key order:

* keys with at most ``threshold`` rows use an ordinary window
  ``partitionBy(key).orderBy(order)`` (the group size is proven bounded);
* hotter keys are range-partitioned on ``(key, order)`` into slices of about
  ``threshold`` rows, each slice runs the same window locally, and a small
  per-slice aggregate table (one row per slice: bounded by the slice count)
  supplies the carry from earlier slices of the same key. Running counts,
  sums, minima, maxima and last-non-null values compose this way exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# At most rows/threshold hot keys exist; this caps the collected list.
MAX_HOT_KEYS = 100_000
DEFAULT_THRESHOLD = 2_000_000


HOT_KEY_CONF = "spark.fanline.hotKeyRows"


def resolve_threshold(spark, threshold: int | None) -> int:
    """Rows a key may hold before it takes the range-split path: the
    argument, else the session setting ``spark.fanline.hotKeyRows``, else
    2,000,000 (a few hundred MB per task for narrow rows)."""
    if threshold is not None:
        return int(threshold)
    return int(spark.conf.get(HOT_KEY_CONF, str(DEFAULT_THRESHOLD)))


def hot_keys(df: DataFrame, keys: list[str], threshold: int) -> DataFrame | None:
    """Keys with more than ``threshold`` rows, with their counts (``_n``), or None.

    The count is a partial (map-side) aggregation; the result has at most
    ``rows / threshold`` entries. Up to ``MAX_HOT_KEYS`` of them are collected
    and marked for broadcast; a longer list stays a checkpointed table that
    Spark joins as its size demands.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold)
    rows = counts.limit(MAX_HOT_KEYS + 1).collect()
    if not rows:
        return None
    if len(rows) > MAX_HOT_KEYS:  # a list too long for the driver stays a table
        from fanline.session import checkpoint_dir

        checkpoint_dir(df.sparkSession)
        return counts.checkpoint()
    return F.broadcast(df.sparkSession.createDataFrame(rows, counts.schema))


HK = "_hk"


def surrogate_key(keys: list[str]) -> Column:
    """A never-NULL text standing for the key tuple (``{}`` for all NULL)."""
    return F.to_json(F.struct(*[F.col(k) for k in keys]))


def slice_count(hot: DataFrame, threshold: int) -> int:
    """Range slices for the rows of the ``hot`` keys: about ``threshold`` rows each,
    but where that makes more than a few slices per core, not under the default
    number of rows (a task per handful of rows costs more than it spreads)."""
    total = hot.agg(F.sum("_n")).first()[0]
    few = 4 * hot.sparkSession.sparkContext.defaultParallelism
    return max(2, min(math.ceil(total / threshold), max(few, math.ceil(total / DEFAULT_THRESHOLD))))


def split_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(cold rows, hot rows) of ``df``; NULL keys compare equal, since a
    missing key is a classic hot key."""
    h = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys])  # hot_keys marks a bounded list for broadcast
    cond = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    return df.join(h, cond, "left_anti"), df.join(h, cond, "left_semi")


@dataclass(frozen=True)
class Scan:
    """One running aggregate: kind in row_number|sum|min|max|last."""

    kind: str
    col: str | None = None
    exclusive: bool = False  # frame ends at the previous row


def _frame(w, exclusive: bool):
    return w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)


def _local(spec: Scan, w) -> Column:
    if spec.kind == "row_number":
        return F.count(F.lit(1)).over(_frame(w, spec.exclusive)).cast("bigint")
    c = F.col(spec.col)
    f = _frame(w, spec.exclusive)
    return {
        "sum": lambda: F.sum(c).over(f),
        "min": lambda: F.min(c).over(f),
        "max": lambda: F.max(c).over(f),
        "last": lambda: F.last(c, ignorenulls=True).over(f),
    }[spec.kind]()


def keyed_window(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    scans: dict[str, Scan],
    threshold: int | None = None,
    hot_from: DataFrame | None = None,
    hot: DataFrame | None | str = "detect",
) -> DataFrame:
    """Adds one column per ``scans`` entry, computed per key in ``order``.

    Hot keys are found by counting ``df`` per key, or ``hot_from`` when given
    (a cheaper frame whose per-key counts bound those of ``df``). A caller
    that can bound the counts itself passes ``hot``: a frame of the keys that
    may be hot with an upper bound ``_n`` of their rows, or None when it has
    proven that no key exceeds ``threshold``.
    """
    threshold = resolve_threshold(df.sparkSession, threshold)
    w = Window.partitionBy(*keys).orderBy(*order)
    if isinstance(hot, str):
        hot = hot_keys(hot_from if hot_from is not None else df, keys, threshold)
    if hot is None:
        return df.withColumns({name: _local(s, w) for name, s in scans.items()})

    cold, hot_rows = split_hot(df, hot, keys)
    cold = cold.withColumns({name: _local(s, w) for name, s in scans.items()})

    slices = slice_count(hot, threshold)
    # inside the hot path the key is a never-NULL surrogate (NULL is a key too)
    hot_rows = hot_rows.withColumn(HK, surrogate_key(keys))
    user_keys, keys = keys, [HK]
    from fanline.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    # The slice id is read by two branches below: materialise it once (reliable
    # checkpoint) so both see the same ids after AQE or a lost executor.
    rows = (
        hot_rows
        .repartitionByRange(slices, *keys, *order)
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint()
    )
    wl = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = rows.withColumns({name: _local(s, wl) for name, s in scans.items()})

    # One row per (key, slice): totals of the slice, then carries from the
    # earlier slices of the same key. Bounded by the number of slices.
    ordkey = F.struct(*order)
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    for name, s in scans.items():
        if s.kind in ("sum", "min", "max"):
            aggs.append(getattr(F, s.kind)(s.col).alias(f"_t_{name}"))
        elif s.kind == "last":
            aggs.append(F.max_by(F.col(s.col), F.when(F.col(s.col).isNotNull(), ordkey)).alias(f"_t_{name}"))
    per_slice = rows.groupBy(*keys, "_slice").agg(*aggs)
    wc = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = {}
    for name, s in scans.items():
        if s.kind == "row_number":
            carry_cols[f"_c_{name}"] = F.coalesce(F.sum("_cnt").over(wc), F.lit(0)).cast("bigint")
        elif s.kind == "last":
            carry_cols[f"_c_{name}"] = F.last(f"_t_{name}", ignorenulls=True).over(wc)
        else:
            carry_cols[f"_c_{name}"] = getattr(F, s.kind)(f"_t_{name}").over(wc)
    carry = per_slice.select(*keys, "_slice", *[v.alias(k) for k, v in carry_cols.items()])

    joined = local.join(F.broadcast(carry), [*keys, "_slice"], "left")
    combined = {}
    for name, s in scans.items():
        lc, cc = F.col(name), F.col(f"_c_{name}")
        if s.kind == "row_number":
            combined[name] = lc + cc
        elif s.kind == "sum":
            combined[name] = F.when(lc.isNull() & cc.isNull(), F.lit(None)).otherwise(
                F.coalesce(lc, F.lit(0)) + F.coalesce(cc, F.lit(0))
            )
        elif s.kind == "min":
            combined[name] = F.least(lc, cc)
        elif s.kind == "max":
            combined[name] = F.greatest(lc, cc)
        else:
            combined[name] = F.coalesce(lc, cc)
    hot_out = joined.withColumns(combined).drop("_slice", HK, *[f"_c_{n}" for n in scans])
    return cold.unionByName(hot_out.select(*cold.columns))


# ---------------------------------------------------------------------------
# Exact as-of lookup that stays balanced whatever the key skew


def asof_next(probes: DataFrame, events: DataFrame, key: str, slices: int) -> DataFrame:
    """For each probe (key, t, pid): the first event (key, t, eid) with t >= probe t.

    ``probes``: key, ``t`` (bigint), ``pid``; ``events``: key, ``t``, ``eid``.
    Events are ordered by (t, eid). Both sides are range-partitioned together
    on (key, t): slices are balanced by row count even inside one key. Each
    slice resolves its probes with a vectorised reverse scan; a probe with no
    later event in its slice takes the first event of its key in a later
    slice, read from a one-row-per-(slice, key) summary (bounded by slices +
    keys) that is broadcast.
    """
    u = probes.select(key, "t", F.lit(0).alias("kind"), F.col("pid").alias("id")).unionByName(
        events.select(key, "t", F.lit(1).alias("kind"), F.col("eid").alias("id"))
    )
    u = u.repartitionByRange(slices, key, "t", "kind", "id").withColumn("_slice", F.spark_partition_id())
    kt = dict(u.dtypes)[key]
    out_schema = f"tag int, {key} {kt}, _slice int, id bigint, nid bigint, nt bigint"

    def scan(batches):
        import numpy as np
        import pandas as pd

        parts = list(batches)
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True).sort_values([key, "t", "kind", "id"], kind="mergesort")
        keys = pdf[key].to_numpy()
        kind = pdf["kind"].to_numpy()
        ids = pdf["id"].to_numpy()
        ts = pdf["t"].to_numpy()
        sl = int(pdf["_slice"].iloc[0])
        n = len(pdf)
        pos = np.where(kind == 1, np.arange(n), n)
        nxt = np.minimum.accumulate(pos[::-1])[::-1]  # first event at or after i
        ok = nxt < n
        nk = np.where(ok, keys[np.minimum(nxt, n - 1)], keys)
        same = ok & (nk == keys)
        probe = kind == 0
        at = np.minimum(nxt, n - 1)
        hit = same[probe]
        res = pd.DataFrame({"tag": 0, key: keys[probe], "_slice": sl, "id": ids[probe]})
        res["nid"] = pd.array(ids[at][probe], dtype="Int64")
        res["nt"] = pd.array(ts[at][probe], dtype="Int64")
        res.loc[~hit, ["nid", "nt"]] = pd.NA
        # summary: first event of each key in this slice (or none: key seen only)
        ev = pdf[kind == 1].groupby(key, sort=False).head(1)
        seen = pd.DataFrame({key: pd.unique(keys)})
        summ = seen.merge(ev[[key, "id", "t"]], on=key, how="left")
        summ = pd.DataFrame({"tag": 1, key: summ[key].to_numpy(), "_slice": sl, "id": pd.array([None] * len(summ), dtype="Int64"),
                             "nid": summ["id"].astype("Int64"), "nt": summ["t"].astype("Int64")})
        yield pd.concat([res, summ], ignore_index=True)

    scanned = u.mapInPandas(scan, out_schema).checkpoint()
    summary = scanned.where("tag = 1").select(key, "_slice", "nid", "nt")
    w = Window.partitionBy(key).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    later = summary.select(
        key, "_slice",
        F.first(F.when(F.col("nid").isNotNull(), F.struct("nid", "nt")), ignorenulls=True).over(w).alias("_later"),
    )
    res = scanned.where("tag = 0")
    fixed = res.join(F.broadcast(later), [key, "_slice"], "left")
    return fixed.select(
        key,
        F.col("id").alias("pid"),
        F.coalesce("nid", "_later.nid").alias("nid"),
        F.coalesce("nt", "_later.nt").alias("nt"),
    )
