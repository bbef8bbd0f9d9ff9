"""fanline: topic-based event fan-out and delivery analytics on Spark.

Every operator is a DataFrame -> DataFrame transform (or a Column builder)
so Catalyst sees the whole plan; stateful streaming lives in
``fanline.streaming``.
"""

from fanline.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
