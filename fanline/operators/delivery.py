"""Requests, sending, back-off, throttling, retry chains."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.json_text import payload_json
from fanline.functions.http import is_retryable
from fanline.operators.hotkeys import Scan, keyed_window

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def number_attempts(attempts: DataFrame, keys: list[str], order: list[str], out: str = "attempt_no",
                    threshold: int | None = None) -> DataFrame:
    """Attempt number per work item (1-based), skew-safe."""
    df = keyed_window(attempts, keys, order, {out: Scan("row_number")}, threshold)
    return df.withColumn(out, F.col(out).cast("int"))


def retry_chain(attempts: DataFrame, keys: list[str], max_retries: int | Column,
                attempt_no: str = "attempt_no") -> DataFrame:
    """Attempts actually sent for one dispatch.

    Attempt n is sent iff every earlier attempt was retryable and
    n <= max_retries + 1. Attempts beyond that bound can never be sent, so
    they are filtered first: each work item's window then holds at most
    ``max_retries + 1`` rows whatever the input skew.
    """
    limit = (F.lit(max_retries) if isinstance(max_retries, int) else max_retries) + 1
    cand = attempts.where(F.col(attempt_no) <= limit).withColumn(
        "_r", is_retryable("status_code", "error_class", "error_message").cast("int")
    )
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(attempt_no).rowsBetween(Window.unboundedPreceding, -1)
    prior_ok = F.coalesce(F.min("_r").over(w), F.lit(1)) == 1
    # attempt numbers must be contiguous from 1 for the chain to reach n
    prior_n = F.count(F.lit(1)).over(w)
    kept = cand.withColumn("_keep", prior_ok & (prior_n == F.col(attempt_no) - 1))
    return kept.where("_keep").drop("_r", "_keep")


def backoff_delay_ms(retry_n: Column, min_ms: Column | int, max_ms: Column | int,
                     base: float = C.BACKOFF_BASE) -> Column:
    """Jitter-free delay before retry n (n = 0 for the first retry)."""
    lo = F.lit(min_ms) if isinstance(min_ms, int) else min_ms
    hi = F.lit(max_ms) if isinstance(max_ms, int) else max_ms
    raw = lo.cast("double") * F.pow(F.lit(base), retry_n.cast("double"))
    return F.least(hi.cast("double"), raw)


def unit_random(seed: int, *counter: Column) -> Column:
    """A number in [0, 1) that only ``seed`` and the counter columns decide (52 bits of
    their MD5), so partitioning, retries and engines all see the same one."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in counter])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def jittered(delay_ms: Column, counter: list[Column], seed: int = 7, factor: float = C.BACKOFF_JITTER) -> Column:
    """Delay with a random factor in [1, 1 + factor), reproducible per counter
    (such as queue, item and attempt)."""
    return delay_ms * (F.lit(1.0) + unit_random(seed, *counter) * F.lit(factor))


def backoff_schedule(chain: DataFrame, keys: list[str], min_ms: Column | int, max_ms: Column | int,
                     attempt_no: str = "attempt_no", jitter: float = 0.0, seed: int = 7) -> DataFrame:
    """Per attempt: the delay before it and the cumulative delay since attempt 1.

    The chain holds at most max_retries + 1 rows per item, so the running
    sum is an ordinary window. ``min_ms`` and ``max_ms`` may be columns: every
    subscriber's own settings. ``jitter`` stretches each delay by up to that share.
    """
    from pyspark.sql import Window

    retry_n = F.col(attempt_no) - 2  # attempt 2 follows retry 0
    delay = backoff_delay_ms(retry_n, min_ms, max_ms)
    if jitter:
        delay = jittered(delay, [*map(F.col, keys), F.col(attempt_no)], seed, jitter)
    delay = F.when(F.col(attempt_no) > 1, delay).otherwise(F.lit(0.0))
    w = Window.partitionBy(*keys).orderBy(attempt_no).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return chain.withColumn("delay_ms", delay).withColumn("cum_delay_ms", F.sum("delay_ms").over(w))


def throttle_schedule(rows: DataFrame, queue: str, order: list[str], elements: Column | int, per_ms: Column | int,
                      cost: Column | int = 1, start: str | None = None,
                      threshold: int | None = None, hot_from: DataFrame | None = None,
                      hot: DataFrame | None | str = "detect") -> DataFrame:
    """Admission slots of a token bucket of ``elements`` per ``per_ms``.

    Each row costs ``cost`` units (``max(instances, 1)`` keeps the fleet-wide
    rate at elements/per). slot = floor((running_cost - cost) / elements),
    send_at = queue start + slot * per. A queue can be hot, so the running
    sum is the skew-safe ``keyed_window``.
    """
    c = F.lit(cost) if isinstance(cost, int) else cost
    el = F.lit(elements) if isinstance(elements, int) else elements
    per = F.lit(per_ms) if isinstance(per_ms, int) else per_ms
    df = rows.withColumn("_cost", c.cast("bigint"))
    scans = {"_cum": Scan("sum", "_cost")}
    start = start or order[0]
    scans["_t0"] = Scan("min", start)
    df = keyed_window(df, [queue], order, scans, threshold, hot_from, hot)
    slot = F.floor((F.col("_cum") - F.col("_cost")) / el).cast("bigint")
    send_at = F.col("_t0") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (slot * per) / F.lit(1000.0))
    return df.withColumn("slot", slot).withColumn("send_at", send_at).drop("_cost", "_cum", "_t0")


def render_requests(queue_rows: DataFrame, subs: DataFrame, bare: bool = False) -> DataFrame:
    """K5: method, uri, content type and the whole envelope as the JSON body.

    The scalar envelope fields go through ``to_json`` (escaping); the payload,
    the ``event`` member of the row's envelope, is already JSON text (``bare``:
    envelopes hold nothing else). Whether
    ``subs``, the subscription catalog, is broadcast is left to Spark, which
    knows its size.
    """
    head = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("eventId"),
            F.col("subject").alias("subject"),
            F.col("group_id").cast("string").alias("groupId"),
            F.date_format("timestamp", ISO_MICROS).alias("timestamp"),
        )
    )
    open_head = F.expr("substring(_head, 1, length(_head) - 1)")
    body = F.concat(open_head, F.lit(',"event":'), payload_json(F.col("event"), bare), F.lit("}"))
    return (
        queue_rows.join(subs.select("topic", "subscriber", "uri", "http_method"), ["topic", "subscriber"])
        .withColumn("_head", head)
        .select(
            "queue", "event_id", F.col("http_method").alias("method"), "uri",
            F.lit(C.CONTENT_TYPE).alias("content_type"), body.alias("body"),
        )
    )


Transport = Callable[[pd.DataFrame], pd.DataFrame]


def deliver(requests: DataFrame, transport: Transport, max_connections: int = C.DEFAULT_MAX_CONNECTIONS,
            queue: str = "queue", key: str = "event_id", instances: int = 1, pace: bool = False) -> DataFrame:
    """K6: send every request through ``transport``, at most
    ``max_connections`` per queue and instance at once.

    Rows are hash-partitioned on (queue, pmod(hash(key), lanes)) with
    lanes = instances * max_connections, so each queue's requests land in at
    most that many groups that run concurrently (the fleet-wide in-flight
    bound); keying on the queue alone would serialise it, and a hot queue is
    spread over all its lanes. ``transport`` gets a pandas batch of requests
    and returns one row per request with ``status_code``, ``error_class``,
    ``error_message``, ``latency_ms``.

    ``pace``: requests carry ``send_at`` (from ``throttle_schedule``, a UTC
    wall-clock time); each lane sends its rows in ``send_at`` order and waits
    until that time, which applies the admission slots on the delivery path
    (D5).
    """
    lane = F.pmod(F.hash(F.col(key)), F.lit(max(1, instances) * max_connections))
    parts = requests.repartition(F.col(queue), lane)
    if pace:
        parts = parts.sortWithinPartitions("send_at")
    out_schema = (
        f"{queue} string, {key} {dict(requests.dtypes)[key]}, status_code int, "
        "error_class string, error_message string, latency_ms bigint"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for pdf in batches:
            if pace and len(pdf):
                pdf = pdf.sort_values("send_at", kind="mergesort").reset_index(drop=True)
                parts = []
                for at, grp in pdf.groupby("send_at", sort=True):
                    wait = pd.Timestamp(at).timestamp() - time.time()
                    if wait > 0:
                        time.sleep(wait)
                    parts.append(transport(grp))
                res = pd.concat(parts, ignore_index=True)
            else:
                res = transport(pdf)
            yield pd.DataFrame(
                {
                    queue: pdf[queue].values,
                    key: pdf[key].values,
                    "status_code": res["status_code"].astype("Int32").values,
                    "error_class": res["error_class"].astype(object).values,
                    "error_message": res["error_message"].astype(object).values,
                    "latency_ms": res["latency_ms"].astype("Int64").values,
                }
            )

    return parts.mapInPandas(run, out_schema)


def http_transport(timeout_s: float = 10.0, opener=None) -> Transport:
    """A ``deliver`` transport that sends each request over HTTP (stdlib).

    Results use the vocabulary of the retry and outcome rules: a response
    gives its status code (4xx/5xx included); a timeout gives
    ``RequestTimeoutException``; a connection dropped by the server gives a
    ``RuntimeException`` with the closed-connection message; anything else
    gives the exception's class and message. ``opener`` replaces
    ``urllib.request.urlopen`` (tests).
    """

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        import http.client
        import socket
        import time
        import urllib.error
        import urllib.request

        open_ = opener or urllib.request.urlopen
        rows = []
        for r in pdf.itertuples(index=False):
            req = urllib.request.Request(
                r.uri, data=str(r.body).encode("utf-8"), method=str(r.method),
                headers={"Content-Type": getattr(r, "content_type", C.CONTENT_TYPE)},
            )
            t0 = time.monotonic()
            code = err = msg = None
            try:
                with open_(req, timeout=timeout_s) as resp:
                    code = int(resp.status)
            except urllib.error.HTTPError as e:
                code = int(e.code)
            except (socket.timeout, TimeoutError) as e:
                err, msg = C.REQUEST_TIMEOUT_CLASS, str(e)
            except (http.client.RemoteDisconnected, ConnectionResetError) as e:
                err, msg = "RuntimeException", f"{C.CLOSED_CONNECTION_TEXT}: {e}"
            except urllib.error.URLError as e:
                reason = e.reason
                if isinstance(reason, (socket.timeout, TimeoutError)):
                    err, msg = C.REQUEST_TIMEOUT_CLASS, str(reason)
                else:
                    err, msg = type(reason).__name__, str(reason)
            except Exception as e:  # noqa: BLE001 - every failure becomes a result row
                err, msg = type(e).__name__, str(e)
            rows.append((code, err, msg, int((time.monotonic() - t0) * 1000)))
        return pd.DataFrame(rows, columns=["status_code", "error_class", "error_message", "latency_ms"])

    return send
