"""Subscription catalog: configuration rows -> validated, defaulted table.

Input rows follow ``RAW_SUBSCRIPTION_SCHEMA`` (every value text or NULL, one
row per (topic, subscriber); a topic without subscribers is a row whose
``subscriber`` is NULL). Only ``uri`` is mandatory; every other field falls
back to the subscription defaults. All field errors of a row are reported
together in ``errors``; the row is usable iff ``errors`` is empty.

Filter paths are checked where the rows are, by the parser that matching uses;
no path comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline import constants as C
from fanline.functions.durations import parse_duration_ms
from fanline.operators.content_match import path_errors
from fanline.schemas import RAW_SUBSCRIPTION_SCHEMA, SUBSCRIPTION_COLUMNS

# Catalog rows that may be compiled into expressions; a larger catalog is joined as data.
MAX_INLINE_SUBSCRIPTIONS = 2_000


def valid_name(col: Column) -> Column:
    """the whole name matches ``[0-9a-z-]+``."""
    return F.coalesce(col.rlike(r"\A" + C.NAME_PATTERN + r"\z"), F.lit(False))


def valid_method(col: Column) -> Column:
    """POST or PUT, case-insensitive."""
    return F.upper(col).isin(*C.ALLOWED_HTTP_METHODS)


def _at(topic: Column, sub: Column, field: str) -> Column:
    return F.concat(F.lit("at '"), topic, F.lit("."), sub, F.lit(f".{field}': "))


def _int_field(raw: Column, default: int) -> tuple[Column, Column]:
    val = F.coalesce(raw.try_cast("int"), F.when(raw.isNull(), F.lit(default)))
    bad = raw.isNotNull() & raw.try_cast("int").isNull()
    return val, bad


def _duration_field(raw: Column, default_ms: int) -> tuple[Column, Column]:
    parsed = parse_duration_ms(raw)
    val = F.when(raw.isNull(), F.lit(default_ms).cast("bigint")).otherwise(parsed)
    bad = raw.isNotNull() & parsed.isNull()
    return val, bad


def _one_per_name(raw: DataFrame) -> DataFrame:
    """One row per (topic, subscriber): of rows with different settings, the least
    in column order (NULLs first), so every run keeps the same one."""
    rest = [c for c in raw.columns if c not in ("topic", "subscriber")]
    least = raw.groupBy("topic", "subscriber").agg(F.min(F.struct(*rest)).alias("_r"))
    return least.select("topic", "subscriber", "_r.*").select(*raw.columns)


def load_subscriptions(raw: DataFrame) -> DataFrame:
    """S3 + F4 + F5 + U1: resolve defaults, validate, collect every error."""
    t, s = F.col("topic"), F.col("subscriber")
    method_raw = F.col("http_method")
    method = F.upper(F.coalesce(method_raw, F.lit(C.DEFAULT_HTTP_METHOD)))
    elements, bad_elements = _int_field(F.col("elements"), C.DEFAULT_ELEMENTS)
    per, bad_per = _duration_field(F.col("per"), C.DEFAULT_PER_MS)
    maxc, bad_maxc = _int_field(F.col("max_connections"), C.DEFAULT_MAX_CONNECTIONS)
    minb, bad_minb = _duration_field(F.col("min_back_off"), C.DEFAULT_MIN_BACKOFF_MS)
    maxb, bad_maxb = _duration_field(F.col("max_back_off"), C.DEFAULT_MAX_BACKOFF_MS)
    retries, bad_retries = _int_field(F.col("max_retries"), C.DEFAULT_MAX_RETRIES)

    path_error = F.col("_path_error")

    def err(cond: Column, field: str, msg: Column) -> Column:
        return F.when(cond, F.concat(_at(t, s, field), msg))

    checks = [
        F.when(~valid_name(t), F.concat(F.lit("Invalid topic name: "), F.coalesce(t, F.lit("")))),
        F.when(s.isNotNull() & ~valid_name(s), F.concat(F.lit("Invalid subscriber name: "), s)),
        err(s.isNotNull() & F.col("uri").isNull(), "uri", F.lit("Unknown key.")),
        err(s.isNotNull() & method_raw.isNotNull() & ~valid_method(method_raw), "http-method",
            F.concat(F.lit("expected one of [POST, PUT], but got: "), method_raw, F.lit("."))),
        err(s.isNotNull() & bad_elements, "elements", F.lit("Expected type NUMBER. Found STRING instead.")),
        err(s.isNotNull() & bad_per, "per", F.concat(F.lit("Cannot convert '"), F.col("per"), F.lit("' to Duration"))),
        err(s.isNotNull() & bad_maxc, "max-connections", F.lit("Expected type NUMBER. Found STRING instead.")),
        err(s.isNotNull() & bad_minb, "min-back-off",
            F.concat(F.lit("Cannot convert '"), F.col("min_back_off"), F.lit("' to Duration"))),
        err(s.isNotNull() & bad_maxb, "max-back-off",
            F.concat(F.lit("Cannot convert '"), F.col("max_back_off"), F.lit("' to Duration"))),
        err(s.isNotNull() & bad_retries, "max-retries", F.lit("Expected type NUMBER. Found STRING instead.")),
        err(s.isNotNull() & path_error.isNotNull(), "filter-path", path_error),
    ]
    return (
        _one_per_name(raw)  # U1: set semantics
        .withColumn("_path_error", path_errors(F.col("filter_path")))
        .select(
            t.alias("topic"),
            s.alias("subscriber"),
            F.col("uri"),
            method.alias("http_method"),
            elements.alias("elements"),
            per.alias("per_ms"),
            maxc.alias("max_connections"),
            minb.alias("min_backoff_ms"),
            maxb.alias("max_backoff_ms"),
            retries.alias("max_retries"),
            F.col("filter_path"),
            F.filter(F.array(*checks), lambda x: x.isNotNull()).alias("errors"),
        )
    )


def valid_subscriptions(catalog: DataFrame) -> DataFrame:
    """Usable subscriber rows (topic rows without subscribers dropped)."""
    return catalog.where((F.size("errors") == 0) & F.col("subscriber").isNotNull()).select(*SUBSCRIPTION_COLUMNS)


def topics_of(catalog: DataFrame) -> DataFrame:
    """Known topics, including topics that have no subscribers."""
    return catalog.where(valid_name(F.col("topic"))).select("topic").distinct()


def catalog_from_nested(spark: SparkSession, topics: dict) -> DataFrame:
    """``{topic: {subscriber: {field: value}} | ""}`` -> raw rows.

    A topic whose value is a string has no subscribers.
    """
    fields = [f.name for f in RAW_SUBSCRIPTION_SCHEMA.fields][2:]
    rows = []
    for topic, subs in topics.items():
        if isinstance(subs, str):
            rows.append((topic, None) + (None,) * len(fields))
            continue
        for name, conf in subs.items():
            conf = {k.replace("-", "_"): v for k, v in conf.items()}
            rows.append((topic, name) + tuple(None if conf.get(f) is None else str(conf.get(f)) for f in fields))
    return spark.createDataFrame(rows, RAW_SUBSCRIPTION_SCHEMA)
