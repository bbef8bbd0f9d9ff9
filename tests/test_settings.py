"""Settings of subscribers reach throttling, retries and back-off; defaults elsewhere."""

import datetime as dt

from pyspark.sql import functions as F

from fanline import constants as C
from fanline.operators.settings import DEFAULTS, retries_by_subscriber, throttle_by_subscriber, with_settings
from fanline.sources.catalog import catalog_from_nested, load_subscriptions

TOPICS = {
    "parcels": {"depot": {"uri": "http://x", "elements": "2", "per": "5 seconds", "max-retries": "1",
                          "min-back-off": "3 seconds", "max-back-off": "4 seconds"},
                "torn": {"uri": "http://x", "elements": "few"}},
    "quiet": "",
}


def catalog(spark):
    return load_subscriptions(catalog_from_nested(spark, TOPICS))


def test_defaults_null_queues_and_clashing_columns(spark):
    rows = spark.createDataFrame(
        [("parcels_depot_queue", 1, -1), ("parcels_torn_queue", 2, -1), ("other", 3, -1), (None, 4, -1), (None, 4, -1)],
        "queue string, id long, elements int",
    )
    got = sorted(with_settings(rows, catalog(spark), list(DEFAULTS)).collect(), key=lambda r: r.id)
    assert [r.elements for r in got] == [2, 60, 60, 60, 60]
    assert got[0].asDict() == {"queue": "parcels_depot_queue", "id": 1, "elements": 2, "per_ms": 5000, "max_connections": 4,
                               "min_backoff_ms": 3000, "max_backoff_ms": 4000, "max_retries": 1}
    assert all({k: r[k] for k in DEFAULTS} == DEFAULTS for r in got[1:])
    assert with_settings(rows.limit(0), catalog(spark), ["per_ms"]).count() == 0


def test_rates_differ_by_queue(spark):
    t0 = dt.datetime(2024, 5, 1)
    rows = spark.createDataFrame(
        [(q, i, t0) for q in ("parcels_depot_queue", "other") for i in range(130)], "queue string, id long, received_at timestamp"
    )
    got = throttle_by_subscriber(rows, catalog(spark), ["received_at", "id"], instances=2).collect()
    for r in got:
        elements, per = (2, 5) if r.queue.startswith("parcels") else (C.DEFAULT_ELEMENTS, 3)
        assert r.slot == 2 * r.id // elements
        assert r.send_at == t0 + dt.timedelta(seconds=per * r.slot)


def test_retry_limits_and_spans_differ_by_queue(spark):
    rows = spark.createDataFrame(
        [(q, 1, n, 503) for q in ("parcels_depot_queue", "other") for n in range(1, 7)],
        "queue string, item_id long, attempt_no int, status_code int",
    ).withColumns({"error_class": F.lit(None).cast("string"), "error_message": F.lit(None).cast("string")})
    got = retries_by_subscriber(rows, catalog(spark), ["queue", "item_id"]).orderBy("queue", "attempt_no").collect()
    by = {}
    for r in got:
        by.setdefault(r.queue, []).append(r.delay_ms)
    assert by == {"other": [0.0, 100.0, 200.0, 400.0, 800.0, 1600.0], "parcels_depot_queue": [0.0, 3000.0]}
