"""Import every module that registers queries."""

from fanline.plans import (  # noqa: F401
    queries,
    queries_delivery,
    queries_exact,
    queries_ingest,
    queries_match,
    queries_metrics,
    queries_publish,
    queries_settings,
    queries_stream,
)
