"""S7 + S5: a queue stream that polls again: rows are released when they fall due.

A row that is not due when it is read waits in keyed state, under the slot of time
in which it falls due, and a timer of that slot releases it. The clock is the
stream's watermark on ``received_at``, so a replay releases the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fanline import constants as C

SLOT_MS = 600_000
SPREAD = 4


def due_at(failed_after_ms: int = C.FAILED_RETRY_AFTER_MS,
           in_progress_after_ms: int = C.IN_PROGRESS_RETRY_AFTER_MS) -> Column:
    """The moment after which ``queue.due_predicate`` holds for a row that does not
    change; NULL when it never does (finished states, no times)."""
    def after(name: str, ms: int) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp")) + F.lit(ms * 1000)

    st, available = F.col("status"), after("available_at", 0)
    failed = after("updated_at", failed_after_ms)
    return (
        F.when(st == C.TODO, available)
        .when((st == C.FAILED) & available.isNotNull() & failed.isNotNull(), F.greatest(failed, available))
        .when(st == C.IN_PROGRESS, after("updated_at", in_progress_after_ms))
    )


#: a waiting row in its group's state; the statuses that fall due, by their number
WAITING = np.dtype([("id", "<i8"), ("no_id", "?"), ("status", "i1"), ("due_us", "<i8")])
DUE_STATUSES = (C.TODO, C.FAILED, C.IN_PROGRESS)
RELEASED = "queue string, id long, status string, due_us long, clock_ms long"
#: rows of an emitted frame
FRAME = 1 << 16


def _packed(part: pd.DataFrame) -> np.ndarray:
    out = np.empty(len(part), WAITING)
    for name in ("id", "no_id", "status", "due_us"):
        out[name] = part[name].to_numpy()
    return out


def _wait(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of one (queue, slot, part): due ones leave, a timer wakes the others."""
    now = max(0, state.getCurrentWatermarkMs())
    kept = [np.frombuffer(state.get[0], WAITING)] if state.exists else []
    batches = [kept.pop()] if state.hasTimedOut else (_packed(part) for part in pdfs)
    for rows in batches:
        due = rows["due_us"] < now * 1000
        kept.append(rows[~due])
        gone = rows[due]
        for at in range(0, len(gone), FRAME):
            some = gone[at : at + FRAME]
            yield pd.DataFrame({
                "queue": key[0],
                "id": pd.arrays.IntegerArray(some["id"].copy(), some["no_id"].copy()),
                "status": np.array(DUE_STATUSES, object)[some["status"]],
                "due_us": some["due_us"], "clock_ms": now,
            })
    rest = np.concatenate(kept) if kept else np.empty(0, WAITING)
    if len(rest):
        state.update((rest.tobytes(),))
        # a timer fires when the clock has passed its millisecond: the row's is over then
        state.setTimeoutTimestamp(max(1, int(rest["due_us"].min()) // 1000))
    elif state.exists:
        state.remove()


def release_due(queue: DataFrame, watermark: str = "10 minutes", slot_ms: int = SLOT_MS, spread: int = SPREAD,
                failed_after_ms: int = C.FAILED_RETRY_AFTER_MS,
                in_progress_after_ms: int = C.IN_PROGRESS_RETRY_AFTER_MS) -> DataFrame:
    """(queue, id, status, due_at, released_at) of a stream of queue rows, each once.

    ``released_at`` is the first clock (watermark) of a micro-batch after ``due_at``.
    State is keyed by (queue, slot of the due time, part of the ids): a slot's rows
    leave together, so a hot queue spreads over its slots and ``spread`` parts, a
    timer reads only rows that are about to go, and nothing is scanned to poll. Every
    key costs a Python call, so widen ``slot_ms`` where the clock moves in big steps,
    and raise ``spread`` where a slot of one queue outgrows a task.
    Rows that never fall due are not kept. Repeated rows are released as often as
    they come; a NULL queue is a queue; rows without ``received_at`` are released too.
    Rows that come more than ``watermark`` behind the clock are refused by Spark:
    choose it as the source's disorder. A group's waiting rows are one packed value of
    its state, so any state store serves.
    """
    id_ = F.col("id").cast("long")
    number = F.when(F.col("status") == C.TODO, 0).when(F.col("status") == C.FAILED, 1).otherwise(2)
    rows = queue.select(
        F.col("queue").cast("string").alias("queue"), id_.alias("id"), number.cast("int").alias("status"),
        F.col("received_at").cast("timestamp").alias("received_at"),
        due_at(failed_after_ms, in_progress_after_ms).alias("due_us"),
    ).withWatermark("received_at", watermark)
    # rows that never fall due move the clock too: a filter that is not deterministic
    # stays above the watermark, where Spark would push another one below it
    rows = rows.where(F.when(F.spark_partition_id() >= 0, F.col("due_us")).isNotNull())
    keyed = rows.withColumns({
        "slot": F.floor(F.col("due_us") / (slot_ms * 1000)).cast("long"),
        "part": F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int"),
    })
    # a NULL in an integer column would turn pandas' ids into doubles: a flag carries it
    keyed = keyed.withColumns({"id": F.coalesce("id", F.lit(0).cast("long")), "no_id": F.col("id").isNull()})
    out = keyed.groupBy("queue", "slot", "part").applyInPandasWithState(
        _wait, RELEASED, "rows binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    return out.select(
        "queue", "id", "status",
        F.timestamp_micros("due_us").alias("due_at"), F.timestamp_millis("clock_ms").alias("released_at"),
    )
