"""D1 (stream): anchored-TTL dedup with keyed state.

State per key is one number: the time of the last accepted row. Each
micro-batch's rows of a key are folded in (ts, tiebreak) order starting from
that carry, exactly like the batch fold. The state times out (event time)
``ttl`` after the last anchor: once the watermark has passed it, every later
row would be accepted anyway, so dropping the state changes nothing and keeps
state bounded by the keys active within one TTL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _fold(t: np.ndarray, elig: np.ndarray, ttl_us: int, carry: int | None):
    """Anchors and duplicate flags for one key's sorted rows, given the carry."""
    n = len(t)
    epos = np.flatnonzero(elig)
    te = t[epos]
    nxt = np.searchsorted(te, te + ttl_us, side="left")
    start = 0 if carry is None else int(np.searchsorted(te, carry + ttl_us, side="left"))
    chain, i = [], start
    while i < len(epos):
        chain.append(i)
        i = nxt[i]
    anchors = epos[np.asarray(chain, dtype=np.int64)]
    accepted = np.zeros(n, dtype=bool)
    accepted[anchors] = True
    j = np.searchsorted(anchors, np.arange(n), side="left") - 1
    last_t = np.where(j >= 0, t[anchors[np.maximum(j, 0)]] if len(anchors) else 0, carry if carry is not None else 0)
    has = (j >= 0) | (carry is not None)
    duplicate = ~accepted & has & (t < last_t + ttl_us)
    new_carry = int(t[anchors[-1]]) if len(anchors) else carry
    return accepted, duplicate, new_carry


def dedup_ttl_stream(
    stream: DataFrame,
    key: str,
    ttl_seconds: int,
    ts: str = "received_at",
    tiebreak: str = "event_id",
    eligible: Column | None = None,
    watermark: str = "1 hour",
) -> DataFrame:
    """Adds ``accepted`` and ``duplicate`` to a stream (append mode).

    ``ts`` must be a TIMESTAMP column (watermarks reject TIMESTAMP_NTZ).
    """
    ttl_us = int(ttl_seconds * 1_000_000)
    base = stream.withColumn("_eligible", F.coalesce(eligible, F.lit(False)) if eligible is not None else F.lit(True))
    base = base.withWatermark(ts, watermark)
    out_schema = T.StructType(
        base.schema.fields
        + [T.StructField("accepted", T.BooleanType()), T.StructField("duplicate", T.BooleanType())]
    )
    state_schema = "last_anchor_us long"

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        parts = list(pdfs)
        if not parts:
            return
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        col = pdf[ts]
        if getattr(col.dtype, "tz", None) is not None:
            col = col.dt.tz_convert("UTC").dt.tz_localize(None)
        t_raw = col.to_numpy(dtype="datetime64[us]").astype(np.int64)
        order = np.lexsort((pdf[tiebreak].to_numpy(), t_raw))
        if not np.array_equal(order, np.arange(len(order))):
            pdf = pdf.iloc[order].reset_index(drop=True)
            t_raw = t_raw[order]
        t = t_raw
        carry = state.get[0] if state.exists else None
        acc, dup, new_carry = _fold(t, pdf["_eligible"].to_numpy(dtype=bool), ttl_us, carry)
        pdf["accepted"] = acc
        pdf["duplicate"] = dup
        if new_carry is not None:
            expires_ms = new_carry // 1000 + ttl_us // 1000
            if expires_ms > state.getCurrentWatermarkMs():
                state.update((new_carry,))
                state.setTimeoutTimestamp(expires_ms)
            elif state.exists:
                state.remove()
        yield pdf

    return base.groupBy(key).applyInPandasWithState(
        fn, out_schema, state_schema, "append", GroupStateTimeout.EventTimeTimeout
    ).drop("_eligible")
