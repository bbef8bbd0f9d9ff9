"""S5, S6, L1, K9, K10, W3, F8, D3 (batch): the subscriber work queues.

A queue row is a work item: ``queue, id, received_at, updated_at,
available_at, status, failure_count, item``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.http import classify_outcome, exhausted
from fanline.operators.hotkeys import Scan, keyed_window


def _interval_ms(ms: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ms / 1000.0))


def due_predicate(as_of: Column, failed_after_ms: int = C.FAILED_RETRY_AFTER_MS,
                  in_progress_after_ms: int = C.IN_PROGRESS_RETRY_AFTER_MS) -> Column:
    """Eligible now: ToDo available, Failed idle 1 h, InProgress idle 24 h."""
    st, upd, avail = F.col("status"), F.col("updated_at"), F.col("available_at")
    return (
        ((st == C.TODO) & (avail < as_of))
        | ((st == C.FAILED) & (upd < as_of - _interval_ms(failed_after_ms)) & (avail < as_of))
        | ((st == C.IN_PROGRESS) & (upd < as_of - _interval_ms(in_progress_after_ms)))
    )


def due_work(queue: DataFrame, as_of: Column) -> DataFrame:
    """The due rows. Plain filter: pushed into the scan where possible."""
    return queue.where(due_predicate(as_of))


def next_due(queue: DataFrame, as_of: Column, n: int) -> DataFrame:
    """L1: the first n due items of every queue by (available_at, id), marked in progress.

    ``row_number() <= n`` is planned as a window group limit: each map task
    keeps only its own top n per queue before the shuffle, so a hot queue
    ships at most n rows per task.
    """
    w = Window.partitionBy("queue").orderBy("available_at", "id")
    ranked = due_work(queue, as_of).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= n).withColumns(
        {"picked_status": F.lit(C.IN_PROGRESS), "picked_at": as_of}
    )


def quarantine_unreadable(queue: DataFrame, item: str = "item", required: tuple[str, ...] = ("event",)) -> DataFrame:
    """Rows whose item is no event any more become permanently failed: text
    that does not parse, that is no JSON object, or that lacks a ``required``
    member (``eventId``, ``subject``, ``groupId``, ``timestamp``, ``event`` for
    whole envelopes)."""
    keys = F.json_object_keys(F.col(item))
    whole = F.coalesce(F.array_size(F.array_except(F.array(*map(F.lit, required)), keys)) == 0, F.lit(False))
    bad = F.col(item).isNotNull() & (F.try_parse_json(F.col(item)).isNull() | ~whole)
    return queue.withColumns(
        {
            "unreadable": bad,
            "status": F.when(bad, F.lit(C.PERMANENTLY_FAILED)).otherwise(F.col("status")),
        }
    )


def expire_dead_work(queue: DataFrame, as_of: Column, ttl_seconds: int = C.DEAD_WORK_TTL_SECONDS) -> DataFrame:
    """K9: only permanently-failed rows expire, ``ttl`` after their last update."""
    dead = (F.col("status") == C.PERMANENTLY_FAILED) & (F.col("updated_at") <= as_of - _interval_ms(ttl_seconds * 1000))
    return queue.where(~dead)


def apply_outcomes(queue: DataFrame, outcomes: DataFrame, as_of: Column,
                   limit: int = C.NUMBER_OF_RETRIES) -> DataFrame:
    """K10 + F8: Sent deletes the row; Failed -> failed (+1) or permanently
    failed once ``failure_count > limit``; Removed -> permanently failed.

    ``outcomes`` has (queue, id, outcome), at most one per item.
    """
    j = queue.join(outcomes.select("queue", "id", "outcome"), ["queue", "id"], "left")
    o = F.col("outcome")
    status = (
        F.when(o.isNull(), F.col("status"))
        .when(o == C.REMOVED, F.lit(C.PERMANENTLY_FAILED))
        .when((o == C.FAILED_OUTCOME) & exhausted("failure_count", limit), F.lit(C.PERMANENTLY_FAILED))
        .when(o == C.FAILED_OUTCOME, F.lit(C.FAILED))
    )
    count = F.when((o == C.FAILED_OUTCOME) & ~exhausted("failure_count", limit), F.col("failure_count") + 1).otherwise(
        F.col("failure_count")
    )
    updated = F.when(o.isNotNull(), as_of).otherwise(F.col("updated_at"))
    return (
        j.where(o.isNull() | (o != C.SENT))
        .withColumns({"status": status, "failure_count": count.cast("int"), "updated_at": updated})
        .drop("outcome")
    )


def work_state(outcomes: DataFrame, keys: list[str], order: list[str], limit: int = C.NUMBER_OF_RETRIES,
               threshold: int | None = None) -> DataFrame:
    """D3 (batch fold) + W3 + F8: final state of every work item.

    ``outcomes`` holds one row per dispatch result (``outcome`` column), in
    ``order`` per item. The machine: Sent -> deleted (``succeeded``);
    Removed -> permanently failed; Failed -> failed with count + 1, or
    permanently failed when the count before it is > limit. Results after a
    terminal one are ignored.

    Running counts of failures and of final results before each row come
    from one skew-safe ``keyed_window``; the per-item result is an aggregate
    with a partial step.
    """
    # 'Picked' rows (a dispatch started) carry no result: no dispatch is
    # counted for them, but an item whose latest row is a pick is in progress
    o = F.col("outcome")
    df = outcomes.withColumns(
        {"_f": (o == C.FAILED_OUTCOME).cast("int"), "_e": ((o == C.SENT) | (o == C.REMOVED)).cast("int")}
    )
    scans = {"_fails_before": Scan("sum", "_f", exclusive=True), "_ends_before": Scan("sum", "_e", exclusive=True)}
    df = keyed_window(df, keys, order, scans, threshold)
    fb = F.coalesce(F.col("_fails_before"), F.lit(0))
    eb = F.coalesce(F.col("_ends_before"), F.lit(0))
    terminal = (F.col("_e") == 1) | ((o == C.FAILED_OUTCOME) & exhausted(fb, limit))
    # live: nothing terminal before this row (a terminal failure is the
    # (limit + 2)-th failure, so later rows see more than limit + 1 before them)
    live = df.where((eb == 0) & (fb <= limit + 1)).withColumn("_term", terminal.cast("int"))
    final_state = (
        F.when(o == C.SENT, F.lit(C.SUCCEEDED))
        .when(o == C.REMOVED, F.lit(C.PERMANENTLY_FAILED))
        .otherwise(F.lit(C.PERMANENTLY_FAILED))
    )
    ordkey = F.struct(*order)
    agg = live.groupBy(*keys).agg(
        F.min_by(F.when(F.col("_term") == 1, final_state), F.when(F.col("_term") == 1, ordkey)).alias("_final"),
        F.sum("_f").alias("_fails"),
        F.sum(F.when(F.col("_term") == 0, F.col("_f")).otherwise(F.lit(0))).alias("_counted"),
        F.count_if(o != "Picked").alias("dispatches"),
        F.max_by(o, ordkey).alias("_last"),
    )
    state = F.coalesce(
        F.col("_final"),
        F.when(F.col("_last") == "Picked", F.lit(C.IN_PROGRESS)),
        F.when(F.col("_fails") > 0, F.lit(C.FAILED)).otherwise(F.lit(C.TODO)),
    )
    fails = F.col("_counted")
    return agg.select(*keys, state.alias("state"), fails.cast("int").alias("failure_count"),
                      F.col("dispatches").cast("int"))


def outcomes_from_attempts(attempts: DataFrame) -> DataFrame:
    """F7 applied to attempt rows."""
    return attempts.withColumn("outcome", classify_outcome("status_code"))
