"""S7 and stream inputs: file-backed streams with admission caps."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fanline.plans import fixture as fx


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A file source stream. ``max_files_per_trigger`` caps each micro-batch
    (admission control, D5); ``glob`` selects files in a shared folder."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table read as a stream (the folder holds one file per table)."""
    schema = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema
    return file_stream(spark, sf_dir, schema, glob=f"{name}.parquet", max_files_per_trigger=max_files_per_trigger)


def to_event_rows(raw: DataFrame) -> DataFrame:
    """EVENT rows from ``events``-shaped rows; ``received_at`` as TIMESTAMP
    (watermarks need it), ``timestamp`` stays local."""
    return raw.select(
        F.col("event_type").alias("topic"),
        F.col("event_id"),
        F.col("event_type").alias("subject"),
        F.col("user_id").alias("group_id"),
        F.col("ts").alias("timestamp"),
        fx.envelope_json(F.col("event_type"), F.col("user_id"), F.col("props")).alias("event"),
        F.col("ts").cast("timestamp").alias("received_at"),
    )


def queue_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """Queue rows as an endless stream; the trigger sets the poll interval."""
    return file_stream(spark, path, schema, max_files_per_trigger=max_files_per_trigger)


def poll_trigger() -> dict:
    """The service's queue poll interval as a processing-time trigger."""
    from fanline.constants import POLLING_INTERVAL_MS

    return {"processingTime": f"{POLLING_INTERVAL_MS} milliseconds"}


def kafka_body_stream(spark: SparkSession, servers: str, topic: str,
                      max_offsets_per_trigger: int | None = None, **options: str) -> DataFrame:
    """JSON publish bodies from a Kafka topic as a ``body`` column (plus the
    record's topic, partition, offset and timestamp).

    ``maxOffsetsPerTrigger`` bounds each micro-batch (admission control). The
    Kafka connector must be on the classpath; without it a clear error is
    raised instead of a failure at query start.
    """
    jvm = spark.sparkContext._jvm
    try:
        jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception as e:  # the connector is an optional package
        raise RuntimeError("the Spark Kafka connector is not on the classpath") from e
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(
        F.col("value").cast("string").alias("body"), F.col("topic").alias("source_topic"),
        "partition", "offset", F.col("timestamp").alias("arrived_at"),
    )
