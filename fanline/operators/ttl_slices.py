"""Anchored TTL for hot keys: transfer functions of range slices, composed.

The rows of hot keys are range-partitioned by (key, time, tiebreak) into slices of
equal size, so a key may span many of them; at most one key crosses any border
between two slices. What a slice does to a key is a transfer function: given the
last anchor before the slice, which eligible row becomes the first anchor in it
(the entry), and which anchor is the last (the exit).

1. Each slice lists that function for its first and last key, the only ones that
   may span several slices: entries can only be the eligible rows up to the first
   one that lies a TTL after the slice's first, each with its exit.
2. An as-of join leads each exit to the entry it causes in a later slice.
3. The entries that really occur are those reachable from the key's first eligible
   row. They are found by composing these leads with themselves (a prefix scan
   over the slices): as many joins as the logarithm of the slices that a key
   spans, however many anchors it has.
4. The exits before a slice are its carry, two entries a slice at most; with it
   every slice folds its own rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanline.functions.time import epoch_us
from fanline.operators.hotkeys import HK, asof_next, slice_count, surrogate_key
from fanline.operators.ttl_fold import _codes, _fold_partitions, next_candidates
from fanline.session import checkpoint_dir

TIME, SLICE = "_ttl_time", "_ttl_slice"
#: one row per entry; a row without entry and exit stands for the key in the slice
FUNCTION_SCHEMA = f"{HK} string, {SLICE} int, eid bigint, entry bigint, exit bigint"


def transfer(t: np.ndarray, ttl_us: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the possible entries, their exits' times) of one key's eligible
    times in a slice, in order."""
    if not len(t):
        return np.zeros(0, np.int64), t
    follow = next_candidates(np.zeros(len(t), np.int64), t, ttl_us)
    last = np.where(follow < 0, np.arange(len(t)), follow)
    while True:  # to the end of each chain
        further = last[last]
        if (further == last).all():
            break
        last = further
    entries = np.arange(min(len(t), int(np.searchsorted(t, t[0] + ttl_us, side="left")) + 1))
    return entries, t[last[entries]]


def _slice_functions(eligible: str, ttl_us: int):
    """mapInArrow body over one slice: rows of ``FUNCTION_SCHEMA``."""

    def rows(table: pa.Table, a: int, b: int):
        t = table.column(TIME).slice(a, b - a).to_numpy()
        e = np.flatnonzero(table.column(eligible).slice(a, b - a).to_numpy().astype(bool))
        at, exits = transfer(t[e], ttl_us)
        key, part = table.column(HK)[a].as_py(), table.column(SLICE)[a].as_py()
        n = len(at)
        eid = (part << 40) + a + e[at]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key] * (n + 1), pa.string()),
                pa.array([part] * (n + 1), pa.int32()),
                pa.array([None, *eid.tolist()], pa.int64()),
                pa.array([None, *t[e[at]].tolist()], pa.int64()),
                pa.array([None, *exits.tolist()], pa.int64()),
            ],
            names=[HK, SLICE, "eid", "entry", "exit"],
        )

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        codes = _codes(table.column(HK).combine_chunks())
        first_end = int(np.searchsorted(codes, 1))
        yield rows(table, 0, first_end)
        if first_end < len(codes):
            yield rows(table, int(np.searchsorted(codes, codes[-1])), len(codes))

    return run


def _carries(functions: DataFrame, ttl_us: int, slices: int) -> dict[tuple[int, str], int]:
    """{(slice, key): time of the key's last anchor before the slice}, for the at most
    two keys of a slice that began in an earlier one."""
    held = functions.where("eid IS NULL").select(HK, SLICE).collect()  # two rows a slice at most
    first: dict[str, int] = {}
    for key, part in sorted(held):
        first.setdefault(key, part)
    spans = {k for k, p in held if p != first[k]}
    if not spans:
        return {}
    spark = functions.sparkSession
    wide = spark.createDataFrame([(k,) for k in sorted(spans)], f"{HK} string")  # fewer than slices
    entries = functions.where("eid IS NOT NULL").join(F.broadcast(wide), HK).checkpoint()
    probes = entries.select(HK, (F.col("exit") + F.lit(ttl_us)).alias("t"), F.col("eid").alias("pid"))
    events = entries.select(HK, F.col("entry").alias("t"), "eid")
    lead = asof_next(probes, events, HK, slices).where("nid IS NOT NULL").select(F.col("pid").alias("eid"), "nid").checkpoint()
    heads = entries.groupBy(HK).agg(F.min("eid").alias("eid")).select("eid")
    reached = heads.checkpoint()
    while not lead.isEmpty():
        # one lead covers as many slices as all leads before it together
        reached = reached.unionByName(reached.join(lead, "eid").select(F.col("nid").alias("eid"))).checkpoint()
        a = lead.select("eid", F.col("nid").alias("by"))
        b = lead.select(F.col("eid").alias("by"), "nid")
        lead = a.join(b, "by").select("eid", "nid").checkpoint()
    # one entry a key and slice at most
    exits = {(r[SLICE], r[HK]): r["exit"] for r in entries.join(reached, "eid", "left_semi").select(HK, SLICE, "exit").collect()}
    out: dict[tuple[int, str], int] = {}
    last: dict[str, int] = {}
    for key, part in sorted(held):
        if key in last:
            out[part, key] = last[key]
        if (part, key) in exits:
            last[key] = exits[part, key]
    return out


def ttl_status_sliced(rows: DataFrame, hot: DataFrame, key: str, ts: str, tiebreak: str, eligible: str, ttl_seconds: int,
                      threshold: int) -> DataFrame:
    """Adds ``accepted`` and ``duplicate`` to the rows of the ``hot`` keys, none of
    which is gathered in one task (see module doc)."""
    ttl_us = int(ttl_seconds * 1_000_000)
    checkpoint_dir(rows.sparkSession)
    slices = slice_count(hot, threshold)
    # written once: every later step sees the same slices and the same order of ties
    placed = (
        rows.withColumns({HK: surrogate_key([key]), TIME: epoch_us(rows, ts)})
        .repartitionByRange(slices, HK, TIME, tiebreak)
        .sortWithinPartitions(HK, TIME, tiebreak)
        .withColumn(SLICE, F.spark_partition_id())
        .checkpoint()
    )
    functions = placed.select(HK, TIME, eligible, SLICE).mapInArrow(_slice_functions(eligible, ttl_us), FUNCTION_SCHEMA).checkpoint()
    carry = _carries(functions, ttl_us, slices)
    schema = T.StructType(
        placed.schema.fields
        + [T.StructField("accepted", T.BooleanType(), False), T.StructField("duplicate", T.BooleanType(), False)]
    )
    folded = placed.mapInArrow(_fold_partitions(HK, TIME, eligible, ttl_us, carry, SLICE), schema)
    return folded.drop(HK, TIME, SLICE)
