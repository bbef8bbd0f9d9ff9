"""Duplicate detection with an anchored time-to-live.

Semantics (per key, rows in (ts, tiebreak) order):

* only *eligible* rows (publishable ones) may become anchors;
* an eligible row is **accepted** (an anchor) when no anchor lies within the
  TTL before it: ``ts >= last_anchor_ts + ttl``; rejected rows never extend
  the TTL;
* any row is a **duplicate** when it is not accepted and the latest anchor
  before it satisfies ``ts < anchor_ts + ttl``.

This is a sequential fold, not ``dropDuplicates`` and not a fixed window.

Plan. One cheap aggregation counts rows per key (map-side combined). Keys at
or below ``hot_threshold`` rows take one shuffle: ``repartition(key)`` +
``sortWithinPartitions(key, ts, tiebreak)`` + ``mapInArrow``, which folds
every key of a partition at once with vectorised numpy (no per-key Python
call); no key there is larger than the proven threshold. Keys above it (a
key may hold a third of all rows) are never gathered into one task: they
are cut into count-balanced range slices, whose transfer functions are composed
(``fanline.operators.ttl_slices``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanline.functions.time import epoch_us
from fanline.operators.hotkeys import hot_keys, resolve_threshold, split_hot
from fanline.operators.ttl_fold import _fold_partitions, fold_sorted  # noqa: F401
from fanline.operators.ttl_slices import ttl_status_sliced


def ttl_status(
    df: DataFrame,
    key: str,
    ttl_seconds: int,
    ts: str = "received_at",
    tiebreak: str = "event_id",
    eligible: Column | None = None,
    hot_threshold: int | None = None,
) -> DataFrame:
    """Adds boolean ``accepted`` and ``duplicate`` columns (see module doc)."""
    hot_threshold = resolve_threshold(df.sparkSession, hot_threshold)
    elig_col = "_eligible"
    base = df.withColumn(elig_col, F.coalesce(eligible, F.lit(False)) if eligible is not None else F.lit(True))
    schema = T.StructType(
        base.schema.fields
        + [T.StructField("accepted", T.BooleanType(), False), T.StructField("duplicate", T.BooleanType(), False)]
    )
    fold = _fold_partitions(key, ts, elig_col, int(ttl_seconds * 1_000_000))

    def cold_fold(rows: DataFrame) -> DataFrame:
        ordered = rows.repartition(key).sortWithinPartitions(key, ts, tiebreak)
        return ordered.mapInArrow(fold, schema)

    hot = hot_keys(base, [key], hot_threshold)
    if hot is None:
        out = cold_fold(base)
    else:
        cold_rows, hot_rows = split_hot(base, hot, [key])
        out = cold_fold(cold_rows).unionByName(
            ttl_status_sliced(hot_rows, hot, key, ts, tiebreak, elig_col, ttl_seconds, hot_threshold)
        )
    return out.drop(elig_col)


def dedup_ttl(df: DataFrame, key: str, ttl_seconds: int, ts: str = "received_at", tiebreak: str = "event_id",
              eligible: Column | None = None, hot_threshold: int | None = None) -> DataFrame:
    """D1 (batch): the accepted rows only."""
    out = ttl_status(df, key, ttl_seconds, ts, tiebreak, eligible, hot_threshold)
    return out.where("accepted").drop("accepted", "duplicate")


def first_per_key(df: DataFrame, key: str, ts: str = "received_at", tiebreak: str = "event_id") -> DataFrame:
    """The first row per key (no expiry).

    ``min_by`` over a struct of the whole row is an aggregate with a map-side
    partial step, so a hot key is reduced before the shuffle.
    """
    cols = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*cols), F.struct(ts, tiebreak))
    return df.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def not_yet_published(events: DataFrame, ledger: DataFrame, ttl_seconds: int, key: str = "event_id",
                      ts: str = "received_at", created: str = "created_at") -> DataFrame:
    """Events with no unexpired ledger row for their key at arrival time."""
    e, lg, cond = _ledger_hit(events, ledger, key, ts, created, ttl_seconds)
    return e.join(lg, cond, "left_anti").drop("_eb")


def duplicates_of(events: DataFrame, ledger: DataFrame, ttl_seconds: int, key: str = "event_id",
                  ts: str = "received_at", created: str = "created_at") -> DataFrame:
    """Events that do have such a ledger row."""
    e, lg, cond = _ledger_hit(events, ledger, key, ts, created, ttl_seconds)
    return e.join(lg, cond, "left_semi").drop("_eb")


def _ledger_hit(events, ledger, key, ts, created, ttl_seconds):
    """Join condition ``created in (ts - ttl, ts]`` on the key, made an equi-join.

    A ledger keeps at most one unexpired row per key, so its rows for a key
    are at least one TTL apart: at most one per TTL-wide bucket. Each ledger
    row is offered to its own bucket and the next; an event looks only in its
    own bucket and so meets at most two rows. No key, however hot, produces
    all its (event, ledger) pairs, and the join spreads over (key, bucket).
    """
    ttl_us = int(ttl_seconds * 1_000_000)

    def bucket(df, c):
        return F.floor(epoch_us(df, c) / F.lit(ttl_us)).cast("bigint")

    lg = ledger.select(F.col(key).alias("_lk"), F.col(created).alias("_lc"), bucket(ledger, created).alias("_lb"))
    lg = lg.withColumn("_lb", F.explode(F.array(F.col("_lb"), F.col("_lb") + 1)))
    e = events.withColumn("_eb", bucket(events, ts))
    e_ts, l_ts = F.col(ts), F.col("_lc")
    cond = (
        (F.col(key) == F.col("_lk"))
        & (F.col("_eb") == F.col("_lb"))
        & (l_ts <= e_ts)
        & (l_ts > e_ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_seconds)))
    )
    return e, lg, cond
