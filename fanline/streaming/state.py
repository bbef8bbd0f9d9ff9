"""D3/D4 work-item state, D7 presence, D6 latency join, D8 delivery query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fanline import constants as C
from fanline.functions.http import classify_outcome, is_retryable
from fanline.operators.delivery import Transport, deliver

PICKED = "Picked"
WORK_STATE_OUT = "queue string, item_id long, state string, failure_count int, dispatches int, due_again boolean"
#: items of one part of a queue, packed into one value of keyed state
ITEMS_STATE = "items binary"
#: parts that a queue's items are dealt to
PARTS = 256
#: rows of an emitted frame
FRAME = 1 << 16
#: the time of rows without one, and of items that were never seen, in milliseconds
NEVER = -(1 << 62)


def _by_parts(rows: DataFrame, ts: str, tie: str, parts: int, *carried) -> GroupedData:
    """Rows of a stream of work items, with what the folds below read, grouped by queue
    and part of the items. A flag carries a NULL item: in an integer column it would
    turn pandas' ids into doubles."""
    item = F.col("item_id").cast("long")
    told = rows.select(
        "queue", ts, F.col(tie).alias("_tie"), item.isNull().alias("_no_item"),
        F.coalesce(item, F.lit(0).cast("long")).alias("_item"),
        F.unix_micros(ts).alias("_us"), *carried,
    )
    return told.withColumn("_part", F.pmod(F.xxhash64("_item"), F.lit(parts)).cast("int")).groupBy("queue", "_part")


def _in_order(pdfs: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """The rows by item, time and tie (NULL last), the place where each item's rows
    begin, and the newest time of each item in milliseconds."""
    names = ["_no_item", "_item", "_us", "_tie"]
    pdf = pd.concat([p.drop(columns=["queue", "_part"], errors="ignore") for p in pdfs], ignore_index=True)
    pdf = pdf.sort_values(names, kind="mergesort", ignore_index=True)
    item, none = pdf["_item"].to_numpy(), pdf["_no_item"].to_numpy(bool)
    begin = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (none[1:] != none[:-1])))
    us = pdf["_us"].to_numpy()
    known = us == us  # NULL times come as not-a-number
    ms = np.where(known, np.floor_divide(np.where(known, us, 0), 1000), NEVER).astype(np.int64)
    return pdf, begin, np.maximum.reduceat(ms, begin)


def _place(items: np.ndarray, pdf: pd.DataFrame, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``items`` with those that ``pdf`` adds (all zero but for their key), and where in
    it the items of ``pdf`` are."""
    fresh = np.zeros(len(begin), items.dtype)
    fresh["item"], fresh["none"] = pdf["_item"].to_numpy()[begin], pdf["_no_item"].to_numpy(bool)[begin]
    every = np.concatenate([items, fresh])
    order = np.lexsort((every["item"], every["none"]))  # stable: known items before fresh ones
    item, none = every["item"][order], every["none"][order]
    first = np.append(True, (item[1:] != item[:-1]) | (none[1:] != none[:-1]))
    place = np.empty(len(every), np.int64)
    place[order] = np.cumsum(first) - 1
    return every[order[first]], place[len(items):]


def _hold(state: GroupState, items: np.ndarray) -> None:
    """Keep the items, and wake when the first of them is due."""
    if len(items):
        state.update((items.tobytes(),))
        state.setTimeoutTimestamp(max(1, int(items["due"].min())))
    elif state.exists:
        state.remove()


def _item_ids(items: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(items["item"].copy(), items["none"].copy())


def _framed(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for at in range(0, len(pdf), FRAME):
        yield pdf.iloc[at : at + FRAME]


WORK_ITEM = np.dtype([("none", "?"), ("item", "<i8"), ("state", "i1"), ("reported", "?"),
                      ("failures", "<i4"), ("dispatches", "<i4"), ("due", "<i8")])
WORK_STATES = (C.TODO, C.IN_PROGRESS, C.FAILED, C.SUCCEEDED, C.PERMANENTLY_FAILED)
_TODO, _IN_PROGRESS, _FAILED, _SUCCEEDED, _PERMANENT = range(5)


def work_state_stream(outcomes: DataFrame, limit: int = C.NUMBER_OF_RETRIES,
                      failed_retry_after_ms: int = C.FAILED_RETRY_AFTER_MS,
                      order: tuple[str, str] = ("sent_at", "attempt_id"), watermark: str = "10 minutes",
                      finished_ttl_ms: int = C.DEAD_WORK_TTL_SECONDS * 1000,
                      in_progress_after_ms: int = C.IN_PROGRESS_RETRY_AFTER_MS, parts: int = PARTS) -> DataFrame:
    """D3 + D4: per work item, apply each dispatch result in order (update mode).

    A failed item arms a timer ``failed_retry_after`` (1 h) after its last
    result, an item picked for dispatch (``outcome = 'Picked'``, no result
    yet) one ``in_progress_after`` (24 h) later (event time, on the
    ``sent_at`` watermark, so replays are deterministic and idle queries
    finish); when it fires the item is emitted again with ``due_again``. Finished items keep their
    state for ``finished_ttl`` (the dead-work TTL) so late results are still
    ignored, then the state is dropped: state stays bounded by the items
    active in one TTL. The batch fold ignores late results forever; the two
    agree whenever results for an item stop within ``finished_ttl``.

    A queue's items are dealt to ``parts`` groups, and one call folds all items of
    a group in arrays; each item keeps its own state and timer. A micro-batch
    rewrites the groups it touches, so raise ``parts`` (fixed for the life of a
    checkpoint) where a group's items outgrow a task.
    """
    ts, tie = order

    def fold(items: np.ndarray, pdfs: Iterator[pd.DataFrame], now: int) -> tuple[np.ndarray, np.ndarray]:
        pdf, begin, last = _in_order(pdfs)
        items, own = _place(items, pdf, begin)
        count = np.diff(np.append(begin, len(pdf)))
        of = np.repeat(np.arange(len(begin)), count)
        kind = pdf["_kind"].to_numpy()
        failed = (kind == 3).astype(np.int64)
        before = np.cumsum(failed) - failed
        before += (items["failures"][own] - before[begin])[of]  # failures of the item before the row
        over = (kind == 1) | (kind == 2) | ((kind == 3) & (before > limit))
        # rows up to the first that ends the item; none of an item that had ended
        ends = np.cumsum(over)
        earlier = ends - over - (ends - over)[begin][of]
        live = (earlier == 0) & (items["state"][own] < _SUCCEEDED)[of]
        closing = live & over
        counted = np.add.reduceat((live & (kind != 0)).astype(np.int64), begin)
        failures = np.add.reduceat((live & (kind == 3) & ~over).astype(np.int64), begin)
        state = items["state"][own].copy()
        final = np.flatnonzero(np.add.reduceat(live.astype(np.int64), begin))  # items that changed
        tail = kind[begin + count - 1][final]
        state[final] = np.where(tail == 0, _IN_PROGRESS, _FAILED)
        state[of[closing]] = np.where(kind[closing] == 1, _SUCCEEDED, _PERMANENT)
        items["state"][own] = state
        items["failures"][own] += failures.astype(np.int32)
        items["dispatches"][own] += counted.astype(np.int32)
        items["reported"][own] = False
        wait = np.full(5, finished_ttl_ms, np.int64)
        wait[_FAILED], wait[_IN_PROGRESS] = failed_retry_after_ms, in_progress_after_ms
        # results behind the watermark arm a timer all the same, or the state would stay
        items["due"][own] = np.maximum(last + wait[state], now + 1)
        return items, own

    def emitted(queue, items: np.ndarray, again: bool) -> Iterator[pd.DataFrame]:
        yield from _framed(pd.DataFrame({
            "queue": np.full(len(items), queue, object), "item_id": _item_ids(items),
            "state": np.array(WORK_STATES, object)[items["state"]],
            "failure_count": items["failures"], "dispatches": items["dispatches"], "due_again": again,
        }))

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        items = np.frombuffer(state.get[0], WORK_ITEM) if state.exists else np.empty(0, WORK_ITEM)
        now = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            items, own = fold(items, pdfs, now)
            yield from emitted(k[0], items[own], False)
        expired = items["due"] < now
        # finished items are kept one dead-work TTL, then dropped, and so are items
        # reported due again to which no result came for a dead-work TTL
        again = expired & (items["state"] < _SUCCEEDED) & ~items["reported"]
        items = items.copy()
        items["reported"] |= again
        items["due"][again] = now + finished_ttl_ms
        yield from emitted(k[0], items[again], True)
        _hold(state, items[~expired | again])

    src = outcomes if "outcome" in outcomes.columns else outcomes.withColumn("outcome", classify_outcome("status_code"))
    src = src.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    kind = F.when(F.col("outcome") == PICKED, 0).when(F.col("outcome") == C.SENT, 1).when(
        F.col("outcome") == C.REMOVED, 2).otherwise(3)
    return _by_parts(src, ts, tie, parts, kind.cast("int").alias("_kind")).applyInPandasWithState(
        fn, WORK_STATE_OUT, ITEMS_STATE, "update", GroupStateTimeout.EventTimeTimeout
    )


PRESENCE_OUT = "instance_id long, last_seen_at timestamp, active boolean"


def presence_stream(heartbeats: DataFrame, timeout_ms: int = C.INSTANCE_TIMEOUT_MS,
                    watermark: str = "1 minute") -> DataFrame:
    """Running membership. Each heartbeat refreshes its instance; an
    instance silent for ``timeout`` (event time) is emitted inactive and its
    state dropped, so state holds only live members."""
    hb = heartbeats.withColumn("seen_at", F.col("seen_at").cast("timestamp")).withWatermark("seen_at", watermark)

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (inst,) = k
        if state.hasTimedOut:
            last = state.get[0]
            state.remove()
            yield pd.DataFrame([{"instance_id": inst, "last_seen_at": pd.Timestamp(last, unit="us"), "active": False}])
            return
        latest = max(pd.to_datetime(p["seen_at"]).max() for p in pdfs)
        last_us = int(latest.value // 1000)
        if state.exists:
            last_us = max(last_us, state.get[0])
        state.update((last_us,))
        state.setTimeoutTimestamp(last_us // 1000 + timeout_ms)
        yield pd.DataFrame([{"instance_id": inst, "last_seen_at": pd.Timestamp(last_us, unit="us"), "active": True}])

    return hb.groupBy("instance_id").applyInPandasWithState(
        fn, PRESENCE_OUT, "last_seen_us long", "update", GroupStateTimeout.EventTimeTimeout
    )


def latency_stream(enqueued: DataFrame, responses: DataFrame, keys: list[str], bound: str = "24 hours",
                   watermark: str = "10 minutes") -> DataFrame:
    """Enqueue and response streams joined within ``bound`` (both watermarked,
    so join state is dropped once the bound has passed; the default covers the
    longest retry span). Every response within the bound yields a row; the
    item's latency is the least of them, as the batch form takes it."""
    e = enqueued.withWatermark("enqueued_at", watermark).alias("e")
    r = responses.withWatermark("handled_at", watermark).alias("r")
    cond = [F.col(f"e.{k}") == F.col(f"r.{k}") for k in keys]
    cond.append(F.col("r.handled_at") >= F.col("e.enqueued_at"))
    cond.append(F.col("r.handled_at") <= F.col("e.enqueued_at") + F.expr(f"INTERVAL {bound}"))
    j = e.join(r, cond)
    ms = (F.unix_micros("r.handled_at") - F.unix_micros("e.enqueued_at")) / 1000
    return j.select(*[F.col(f"e.{k}").alias(k) for k in keys], F.floor(ms).cast("bigint").alias("e2e_ms"))


def run_delivery(requests: DataFrame, transport: Transport, sink_path: str, checkpoint: str,
                 max_connections: int = C.DEFAULT_MAX_CONNECTIONS, trigger: dict | None = None) -> StreamingQuery:
    """One streaming query delivers for every queue (the queue is a column,
    not a query per subscriber); stop with ``query.stop()``, restart resumes
    from the checkpoint."""
    attempts = deliver(requests, transport, max_connections).withColumn("outcome", classify_outcome("status_code"))
    w = attempts.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


RETRY_OUT = ("queue string, item_id long, attempt_id long, attempt_no int, delay_ms double, "
             "cum_delay_ms double")


RETRY_ITEM = np.dtype([("none", "?"), ("item", "<i8"), ("sent", "<i4"), ("ended", "?"), ("cum", "<f8"), ("due", "<i8")])


def retry_stream(attempts: DataFrame, max_retries: int = C.DEFAULT_MAX_RETRIES,
                 min_backoff_ms: int = C.DEFAULT_MIN_BACKOFF_MS, max_backoff_ms: int = C.DEFAULT_MAX_BACKOFF_MS,
                 order: tuple[str, str] = ("sent_at", "attempt_id"), watermark: str = "10 minutes",
                 idle_ttl_ms: int = C.DEAD_WORK_TTL_SECONDS * 1000, parts: int = PARTS) -> DataFrame:
    """The retry chain of each work item, continued across micro-batches.

    State per item: attempts sent so far, whether the chain is still alive
    (every result so far retryable and fewer than max_retries + 1 sent), and
    the cumulative back-off. Each kept attempt is emitted with the
    jitter-free delay before it (``min(max, min * 2^(n-2))``) and the
    cumulative delay, like ``delivery.backoff_schedule`` over
    ``delivery.retry_chain`` in batch. State expires ``idle_ttl`` after the
    item's last attempt (event time). Items are dealt to ``parts`` groups a queue,
    as in ``work_state_stream``.
    """
    ts, tie = order

    def fold(queue, items: np.ndarray, pdfs: Iterator[pd.DataFrame], now: int) -> tuple[np.ndarray, pd.DataFrame]:
        pdf, begin, last = _in_order(pdfs)
        items, own = _place(items, pdf, begin)
        of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(pdf))))
        no = items["sent"][own][of] + np.arange(len(pdf)) - begin[of] + 1
        stop = ~pdf["_again"].to_numpy(bool)
        stops = np.cumsum(stop) - stop
        kept = (stops == stops[begin][of]) & ~items["ended"][own][of] & (no <= max_retries + 1)
        # the kept rows are the first ones of each item
        row = np.flatnonzero(kept)
        of, no = of[row], no[row]
        delay = np.where(no == 1, 0.0, np.minimum(float(max_backoff_ms), min_backoff_ms * 2.0 ** np.maximum(no - 2, 0)))
        head = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(row) else row
        total = np.cumsum(delay)
        lead = (total - delay)[head]
        cum = total - np.repeat(lead - items["cum"][own][of[head]], np.diff(np.append(head, len(row))))
        tail = np.append(head[1:], len(row))[: len(head)] - 1
        at = own[of[tail]]
        items["sent"][at], items["cum"][at], items["ended"][at] = no[tail], cum[tail], stop[row[tail]]
        items["due"][own] = np.maximum(last + idle_ttl_ms, now + 1)
        out = pd.DataFrame({
            "queue": np.full(len(row), queue, object), "item_id": _item_ids(items[own[of]]),
            "attempt_id": pdf["attempt_id"].iloc[row].to_numpy(), "attempt_no": no, "delay_ms": delay, "cum_delay_ms": cum,
        })
        return items, out

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        items = np.frombuffer(state.get[0], RETRY_ITEM) if state.exists else np.empty(0, RETRY_ITEM)
        now = state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            items, out = fold(k[0], items, pdfs, now)
            yield from _framed(out)
        _hold(state, items[items["due"] >= now])

    src = attempts.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    again = is_retryable("status_code", "error_class", "error_message").alias("_again")
    return _by_parts(src, ts, tie, parts, "attempt_id", again).applyInPandasWithState(
        fn, RETRY_OUT, ITEMS_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


#: the start of a queue none of whose rows has a time: pandas' smallest moment
NO_TIME_US = -(1 << 63) // 1000
THROTTLE_OUT = "queue string, id long, slot long, send_at timestamp"


def throttle_stream(rows: DataFrame, elements: int = C.DEFAULT_ELEMENTS, per_ms: int = C.DEFAULT_PER_MS,
                    cost: int = 1, order: tuple[str, str] = ("received_at", "id"), watermark: str = "10 minutes",
                    idle_ttl_ms: int = 86_400_000) -> DataFrame:
    """Admission slots per queue, continued across micro-batches.

    State per queue: the cumulative cost admitted so far and the queue's
    start time; slot = floor((cum - cost) / elements), send_at = start +
    slot * per, exactly as ``delivery.throttle_schedule`` in batch. A hot
    queue's rows of one micro-batch form one group, bounded by the
    micro-batch size (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``); of
    each row the group holds its time, id and rank, and frames leave as they fill.
    """
    ts, tie = order

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # a batch of the group at a time; of each row only its time and id are held
        us, ids, odd = [], [], []
        for pdf in pdfs:
            us.append(pdf["_us"].to_numpy())
            ids.append(pdf["_id"].to_numpy())
            odd.append(pdf["_odd"].to_numpy(np.int8))
        us, ids, odd = np.concatenate(us), np.concatenate(ids), np.concatenate(odd)
        rank = np.lexsort((ids, odd & 1, us, odd & 2))  # NULL times last, then NULL ids
        n, dated = len(rank), (odd & 2) == 0
        cum0, t0_us = state.get if state.exists else (0, int(us[rank[0]]))
        last_ms = int(us[dated].max()) // 1000 if dated.any() else NEVER
        state.update((cum0 + cost * n, t0_us))
        state.setTimeoutTimestamp(max(last_ms + idle_ttl_ms, state.getCurrentWatermarkMs() + 1))
        for at in range(0, n, FRAME):
            row = rank[at : at + FRAME]
            slot = (cum0 + cost * np.arange(at, at + len(row), dtype=np.int64)) // elements
            send = pd.to_datetime(t0_us, unit="us") + pd.to_timedelta(slot * per_ms, unit="ms")
            yield pd.DataFrame({
                "queue": np.full(len(row), k[0], object),
                "id": pd.arrays.IntegerArray(ids[row], (odd[row] & 1).astype(bool)), "slot": slot, "send_at": send,
            })

    src = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    id_, time = F.col(tie).cast("long"), F.unix_micros(ts)
    src = src.select(
        "queue", ts, F.coalesce(time, F.lit(NO_TIME_US)).alias("_us"), F.coalesce(id_, F.lit(0).cast("long")).alias("_id"),
        (id_.isNull().cast("int") + time.isNull().cast("int") * 2).alias("_odd"),
    )
    return src.groupBy("queue").applyInPandasWithState(
        fn, THROTTLE_OUT, "cum long, t0_us long", "append", GroupStateTimeout.EventTimeTimeout
    )
