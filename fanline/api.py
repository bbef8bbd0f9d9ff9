"""Incremental batch publishing: what one publish call per event does, for a
batch of events against the ledger already written.

``publish_events`` folds the batch with each key's latest ledger row as a
pre-accepted anchor, so the anchored TTL carries across batches exactly as
across one long run; ``publish`` commits the batch's ledger rows, queue rows
and responses together (``streaming.publish.commit_batch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.operators import dedup, matching, publish as ops
from fanline.streaming.publish import commit_batch, has_commits, read_committed


def publish_events(events: DataFrame, index: matching.SubscriptionIndex, ledger: DataFrame | None,
                   key: str = "event_id", ttl_seconds: int = C.LEDGER_TTL_SECONDS,
                   hot_threshold: int | None = None) -> DataFrame:
    """Status of every event of the batch (duplicate > no-topic > no-subscribers > published).

    ``ledger`` (``key``, ``created_at``) holds earlier accepted events. Only
    each key's latest row can matter, so it is reduced per key (partial
    aggregate) and restricted to keys of the batch before it joins the fold.
    """
    m = matching.publishable(events, index).withColumn("_seed", F.lit(False))
    rows = m.withColumn("_tie", F.struct(F.lit(1).alias("o"), F.col("event_id").alias("id")))
    if ledger is not None:
        # rows that expired before the batch's first event cannot matter
        first = events.agg((F.min("received_at") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_seconds))).alias("_t0"))
        live = ledger.join(F.broadcast(first), F.col("created_at") > F.col("_t0")).drop("_t0")
        keys = events.select(F.col(key).alias("_bk")).distinct()
        last = live.groupBy(F.col(key).alias("_lk")).agg(F.max("created_at").alias("received_at"))
        last = last.join(keys, F.col("_lk").eqNullSafe(F.col("_bk")), "left_semi")  # NULL is a key too
        id_type = m.schema["event_id"].dataType
        seeds = last.select(
            F.col("_lk").cast(m.schema[key].dataType).alias(key),
            F.col("received_at").cast(m.schema["received_at"].dataType).alias("received_at"),
            F.lit(True).alias("_seed"),
            # at equal times the ledger's row comes before the batch's
            F.struct(F.lit(0).alias("o"), F.lit(None).cast(id_type).alias("id")).alias("_tie"),
        )
        rows = rows.unionByName(seeds, allowMissingColumns=True)
    elig = F.col("_seed") | F.coalesce(F.col("publishable"), F.lit(False))
    st = dedup.ttl_status(rows, key, ttl_seconds, tiebreak="_tie", eligible=elig, hot_threshold=hot_threshold)
    st = st.where(~F.col("_seed")).drop("_seed", "_tie")
    status = (
        F.when(F.col("duplicate"), F.lit(C.ST_DUPLICATE))
        .when(~F.col("topic_known"), F.lit(C.ST_NO_TOPIC))
        .when(F.size("subscribers") == 0, F.lit(C.ST_NO_SUBSCRIBERS))
        .otherwise(F.lit(C.ST_PUBLISHED))
    )
    return st.withColumn("status", status)


def publish(events: DataFrame, index: matching.SubscriptionIndex, root: str, batch_id: int,
            key: str = "event_id", ttl_seconds: int = C.LEDGER_TTL_SECONDS) -> DataFrame:
    """Publish one batch against the ledger committed under ``root`` and
    commit its ledger rows, queue rows and responses; returns the responses.

    Publishing a batch id again reads the ledger without that batch's own rows
    and so writes the same rows again: a replay changes nothing. If the commit
    fails, audit rows (K4) go to ``{root}-audit`` and the error is raised again.
    """
    from fanline.session import checkpoint_dir

    spark = events.sparkSession
    checkpoint_dir(spark)
    ledger = None
    if has_commits(spark, root):
        ledger = read_committed(spark, root, "ledger").where(F.col("batch_id") != batch_id).select(key, "created_at")
    # evaluated once: three outputs are written from it
    st = publish_events(events, index, ledger, key, ttl_seconds).checkpoint()
    acc = st.where("accepted")
    responses = ops.publish_response(st).select("event_id", "status", "http_code", "body")
    queues = ops.queue_rows(acc.withColumn("subscriber", F.explode("subscribers")))
    try:
        commit_batch(ops.to_published(acc), queues, batch_id, root, responses)
    except Exception as e:
        failed = ops.audit_rows(acc, F.lit(str(e) or type(e).__name__))
        failed.write.mode("overwrite").parquet(f"{root}-audit/batch_id={batch_id}")
        raise
    return read_committed(spark, root, "responses").where(F.col("batch_id") == batch_id)
