"""JSON event bodies -> typed, validated EVENT rows.

Bodies are parsed with ``from_json`` against the fixed envelope schema; the
payload field is declared as a string, so Spark keeps the nested object as
its raw JSON text. Validation collects every field error of a body into one
array, like the reference's accumulated JSON errors; valid and invalid rows
are two filters of the same parsed frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


UUID_RE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
LOCAL_DT_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?$"
OFFSET_RE = r"(Z|[+-]\d{2}:\d{2})$"


def local_timestamp(text: Column) -> Column:
    """ISO local date-time; a trailing offset is dropped, not applied."""
    shaped = text.rlike(LOCAL_DT_RE)
    return F.when(shaped, F.regexp_replace(text, OFFSET_RE, "").try_cast("timestamp_ntz"))


# One parse: the scalar fields as VARIANT (absent -> NULL, JSON null ->
# 'VOID', else their JSON type), the payload as raw text (bytes unchanged).
_TYPED_ENVELOPE = "struct<eventId: variant, subject: variant, groupId: variant, timestamp: variant, event: string>"


def parse_bodies(bodies: DataFrame, body: str = "body") -> DataFrame:
    """S1 + S2: parse each body once; adds typed columns and ``errors`` (array).

    Every field that is absent, JSON null, or of another JSON type than
    expected gets its own error, and every error of a body is reported. A
    body that is not a JSON object gets one error.
    """
    df = bodies.withColumn("_p", F.from_json(F.col(body), _TYPED_ENVELOPE))

    def jtype(name: str) -> Column:
        return F.schema_of_variant(F.col(f"_p.{name}"))

    def text(name: str) -> Column:
        return F.when(jtype(name) == "STRING", F.variant_get(F.col(f"_p.{name}"), "$", "string"))

    eid, subj, gid, ts, ev = text("eventId"), text("subject"), text("groupId"), text("timestamp"), F.col("_p.event")
    parsed_ts = local_timestamp(ts)

    def string_field(name: str) -> tuple[Column, Column]:
        t = jtype(name)
        return (
            F.when(t.isNull(), F.lit(f"obj.{name}: error.path.missing")),
            F.when(t.isNotNull() & (t != "STRING"), F.lit(f"obj.{name}: error.expected.jsstring")),
        )

    # the payload may be any JSON value, null included: only its absence is an error
    event_absent = ev.isNull() & ~F.coalesce(F.array_contains(F.json_object_keys(F.col(body)), "event"), F.lit(False))
    is_object = F.ltrim(F.col(body)).startswith("{")
    ts_type = jtype("timestamp")
    errors = F.array(
        *string_field("eventId"),
        F.when(eid.isNotNull() & ~eid.rlike(UUID_RE), F.lit("obj.eventId: error.expected.uuid")),
        *string_field("subject"),
        *string_field("groupId"),
        F.when(ts_type.isNull(), F.lit("obj.timestamp: error.path.missing")),
        F.when(ts_type.isNotNull() & (ts_type != "STRING"), F.lit("obj.timestamp: error.expected.date")),
        F.when(ts.isNotNull() & parsed_ts.isNull(), F.lit("obj.timestamp: error.expected.date.isoformat")),
        F.when(event_absent, F.lit("obj.event: error.path.missing")),
    )
    errs = F.filter(errors, lambda x: x.isNotNull())
    errs = F.when(~is_object, F.array(F.lit("obj: error.expected.jsobject"))).otherwise(errs)
    return df.select(
        "*",
        F.lower(eid).alias("event_id"),
        subj.alias("subject"),
        gid.alias("group_id"),
        parsed_ts.alias("timestamp"),
        ev.alias("event"),
        errs.alias("errors"),
    ).drop("_p")


def where_derived(df: DataFrame, cond: Column) -> DataFrame:
    """Filter on columns derived by expensive expressions (JSON parsing).

    Pushing a filter below the projection that defines its columns makes
    Catalyst copy each definition into the predicate once per reference, so
    every body would be parsed many times. A nondeterministic, always-true
    gate column in the projection stops that push; the parse runs once.
    (Plain stored columns should be filtered normally, so the predicate
    still reaches the scan.)
    """
    gated = df.withColumn("_gate", F.rand(0))
    return gated.where((F.col("_gate") >= 0) & cond).drop("_gate")


def valid_events(parsed: DataFrame) -> DataFrame:
    return where_derived(parsed, F.size("errors") == 0).drop("errors")


def invalid_events(parsed: DataFrame) -> DataFrame:
    return where_derived(parsed, F.size("errors") > 0)


def read_event_bodies(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """Batch source: one JSON body per line (``text``) or a ``body`` column (parquet)."""
    if fmt == "text":
        return spark.read.text(path).withColumnRenamed("value", "body")
    return spark.read.format(fmt).load(path)


def ledger_lookup(ledger: DataFrame, event_id: Column) -> DataFrame:
    """S4 + L2: the ledger row of one event id, at most one (pushed-down filter + limit)."""
    return ledger.where(F.col("event_id") == event_id).limit(1)
