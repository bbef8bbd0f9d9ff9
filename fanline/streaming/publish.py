"""D2 + K3: the publish stream and its all-or-nothing two-output sink.

Each micro-batch writes its ledger rows and its queue rows under
``{root}/ledger/batch_id={n}/`` and ``{root}/queues/batch_id={n}/`` and only
then writes the marker
``{root}/_commits/batch_id={n}``. Readers take only batches that have a
marker, so a batch's ledger and queue rows become visible together or not
at all. A replayed batch id (after a failure) overwrites its own folder
before re-writing the marker, so replays change nothing. ``root`` must be
shared storage on a cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fanline import constants as C
from fanline.operators import matching, publish
from fanline.streaming.dedup import dedup_ttl_stream

COMMITS = "_commits"
#: files that a batch may write per queue
QUEUE_FILES = 8


def commit_batch(ledger: DataFrame, queues: DataFrame, batch_id: int, root: str,
                 responses: DataFrame | None = None) -> None:
    """K3: write the outputs of one batch, then publish them with a marker."""
    ledger.write.mode("overwrite").parquet(f"{root}/ledger/batch_id={batch_id}")
    # a queue's rows go to a few tasks by id, so a batch writes few files per queue
    dealt = queues.repartition("queue", F.pmod(F.xxhash64("id"), F.lit(QUEUE_FILES)))
    dealt.write.mode("overwrite").partitionBy("queue").parquet(f"{root}/queues/batch_id={batch_id}")
    if responses is not None:
        responses.write.mode("overwrite").parquet(f"{root}/responses/batch_id={batch_id}")
    spark = ledger.sparkSession
    marker = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("committed"))
    marker.coalesce(1).write.mode("overwrite").json(f"{root}/{COMMITS}/batch_id={batch_id}")


def read_committed(spark: SparkSession, root: str, what: str) -> DataFrame:
    """Rows of ``what`` (``ledger``, ``queues`` or ``responses``) from committed batches only."""
    # the marker's own content names its batch: no partition column on this
    # side, so no dynamic partition pruning (whose filtered broadcasts Spark
    # could reuse across differently filtered reads of the same table)
    commits = spark.read.schema("committed bigint").json(f"{root}/{COMMITS}/*")
    done = commits.select(F.col("committed").alias("batch_id")).distinct()
    data = spark.read.parquet(f"{root}/{what}")
    # one marker row per batch: grows with the batch count, so Spark (AQE)
    # decides whether to broadcast it
    return data.join(done, "batch_id", "left_semi")


def has_commits(spark: SparkSession, root: str) -> bool:
    """Whether any batch was committed under ``root`` (any store Spark knows)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{COMMITS}")
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


def publish_stream(
    events: DataFrame,
    index: matching.SubscriptionIndex,
    root: str,
    checkpoint: str,
    key: str = "event_id",
    ttl_seconds: int = C.LEDGER_TTL_SECONDS,
    trigger: dict | None = None,
    audit_root: str | None = None,
    watermark: str = "1 hour",
) -> StreamingQuery:
    """Events -> match -> TTL dedup (state) -> ledger + queues + responses per batch.

    ``watermark`` is how far ``received_at`` may run behind the latest one seen;
    with arrival times (``events_from_bodies``) no row is ever that late.

    K4: if a batch cannot be committed, audit rows for its accepted events
    (reason = the error) go to ``audit_root`` and the error is raised again,
    so Spark retries the batch.
    """
    audit_root = audit_root or f"{root}-audit"
    m = matching.publishable(events, index)
    st = dedup_ttl_stream(m, key, ttl_seconds, eligible=F.col("publishable"), watermark=watermark)

    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            acc = df.where("accepted")
            ledger = publish.to_published(acc)
            queues = publish.queue_rows(acc.withColumn("subscriber", F.explode("subscribers")))
            status = (
                F.when(F.col("duplicate"), F.lit(C.ST_DUPLICATE))
                .when(~F.col("topic_known"), F.lit(C.ST_NO_TOPIC))
                .when(F.size("subscribers") == 0, F.lit(C.ST_NO_SUBSCRIBERS))
                .otherwise(F.lit(C.ST_PUBLISHED))
            )
            responses = publish.publish_response(df.withColumn("status", status)).select(
                "event_id", "status", "http_code", "body"
            )
            try:
                commit_batch(ledger, queues, batch_id, root, responses)
            except Exception as e:
                reason = F.lit(str(e) or type(e).__name__)
                audit = publish.audit_rows(acc, reason)
                audit.write.mode("overwrite").parquet(f"{audit_root}/batch_id={batch_id}")
                raise
        finally:
            df.unpersist()

    w = st.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def events_from_bodies(bodies: DataFrame, received_at: Column | None = None) -> DataFrame:
    """S1 + S2 on a stream: the valid bodies as EVENT rows (topic = subject, the
    whole body is the envelope the filters read). ``received_at`` is the time
    the micro-batch took the body in, not the publisher's ``timestamp``: it only
    moves on, so no event is late and every one gets its response. A log that
    holds its own arrival times is replayed by passing them as ``received_at``."""
    from fanline.sources.ingest import parse_bodies, valid_events

    ok = valid_events(parse_bodies(bodies))
    return ok.select(
        F.col("subject").alias("topic"), "event_id", "subject", "group_id", "timestamp",
        F.col("body").alias("event"), (F.current_timestamp() if received_at is None else received_at.cast("timestamp")).alias("received_at"),
    )


def rejected_stream(bodies: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The 400 responses of invalid bodies, as their own exactly-once query."""
    from fanline.sources.ingest import invalid_events, parse_bodies

    bad = publish.invalid_response(invalid_events(parse_bodies(bodies)))
    cols = [c for c in bodies.columns if c != "body"] + ["http_code", "body", "errors"]
    w = bad.select(*cols).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
