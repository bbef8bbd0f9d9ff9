"""Quantiles per group without a group in one buffer: exact ranks, or a mergeable sketch.

Exact form: values are counted per (group, value) with a map-side step, running
counts per group come from the skew-safe ``keyed_window`` (a group with many
distinct values is cut into range slices), and the value that covers a wanted rank
is picked by the aggregate that also gives the totals. Approximate form: KLL sketches, a few KB a group, kept as
binary columns, merged over days or partitions, and asked later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline.operators.hotkeys import Scan, keyed_window

#: names of the helper columns, unlikely to meet a group column's
VALUE, COUNT, BEFORE = "__fanline_value", "__fanline_count", "__fanline_before"


def value_counts(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group..., value, count), NULL values left out: spread by (group, value)."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*[F.col(g) for g in group], F.col(value).alias(VALUE))
        .agg(F.count(F.lit(1)).alias(COUNT))
    )


def _interpolated(p: float, n: Column) -> tuple[Column, Column, Column]:
    """(rank below, rank above, weight of the rank above) for quantile ``p`` of n values."""
    at = F.lit(p) * (n - 1)
    low = F.floor(at).cast("bigint")
    return low, F.ceil(at).cast("bigint"), at - low


def exact_quantiles(df: DataFrame, group: list[str], value: str, wanted: dict[str, float],
                    threshold: int | None = None) -> DataFrame:
    """One row per group: ``n``, ``least``, ``most``, ``total`` and one double per entry
    of ``wanted`` (name -> share), interpolated between neighbouring ranks.

    ``group`` names at least one column (a constant one for a whole table). NULL values do not count; a NULL group is a group; a group without values gives
    no row; one value gives that value for every share. ``threshold`` is the number
    of distinct values of a group that one task may rank (default: the session's
    hot-key rows).
    """
    counts = value_counts(df, group, value)
    ranked = keyed_window(counts, group, [VALUE], {BEFORE: Scan("sum", COUNT, exclusive=True)}, threshold)
    ranked = ranked.withColumn(BEFORE, F.coalesce(F.col(BEFORE), F.lit(0)))
    first, last = F.col(BEFORE), F.col(BEFORE) + F.col(COUNT)
    size = counts.groupBy(*[F.col(g).alias(f"__of_{g}") for g in group]).agg(F.sum(COUNT).alias("__n"))
    # one small row per group meets the ranked values: adaptive execution broadcasts it by
    # its size, or splits the side of a hot group
    met = ranked.join(size, [F.col(g).eqNullSafe(F.col(f"__of_{g}")) for g in group])
    ends = []
    for name, p in wanted.items():
        low, high, _ = _interpolated(p, F.col("__n"))
        for end, rank in (("low", low), ("high", high)):
            ends.append(F.max(F.when((first <= rank) & (rank < last), F.col(VALUE))).cast("double").alias(f"__{name}_{end}"))
    out = met.groupBy(*group).agg(
        F.sum(COUNT).alias("n"),
        F.min(VALUE).alias("least"),
        F.max(VALUE).alias("most"),
        F.sum(F.col(VALUE).cast("double") * F.col(COUNT)).alias("total"),
        *ends,
    )
    columns = []
    for name, p in wanted.items():
        weight, low, high = _interpolated(p, F.col("n"))[2], F.col(f"__{name}_low"), F.col(f"__{name}_high")
        columns.append((low + (high - low) * weight).alias(name))
    return out.select(*group, "n", "least", "most", "total", *columns)


def quantile_sketches(df: DataFrame, group: list[str], value: str, k: int = 800) -> DataFrame:
    """(group..., n, sketch): one KLL sketch of ``value`` per group, map-side combined;
    its size depends on ``k``, not on the rows. Ranks are off by about 2.3 / k."""
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).groupBy(*group).agg(
        F.count(v).alias("n"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Sketches of finer groups (days, partitions) merged into one per ``group``."""
    return sketches.groupBy(*group).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, group: list[str], wanted: dict[str, float]) -> DataFrame:
    """(group..., n, one double per entry of ``wanted``) read from sketches."""
    return sketches.select(
        *group, "n",
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in wanted.items()],
    )
