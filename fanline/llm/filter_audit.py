"""Filter interaction audit by count-weighted decision diagrams.

Every document fails some of several filters: its failure mask. The documents
of a part are counted by mask (a shuffle of at most ``2**filters`` counts per
part and task), and the counts of each part become a decision diagram: one level
per filter, a low child for documents that pass it and a high child for those
that fail it, equal nodes shared, each node weighted with the counts below it.
Swapping two adjacent levels rewrites only these two, so one walk through all
orders by adjacent swaps gives every order's diagram; the path of low children
is the documents that pass so far, and its high children are what each step
removes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c

#: what is counted: documents, those labelled good, those labelled toxic
Counts = tuple[int, int, int]
NOTHING: Counts = (0, 0, 0)


class Node:
    """low: passes the level's filter, high: fails it; both None at the bottom."""

    __slots__ = ("low", "high", "counts")

    def __init__(self, low: Node | None, high: Node | None, counts: Counts):
        self.low, self.high, self.counts = low, high, counts


def _sum(a: Counts, b: Counts) -> Counts:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


class MaskDiagram:
    """Decision diagram of {mask: counts}; ``order[i]`` is the filter at level i."""

    def __init__(self, filters: int, counts: dict[int, Counts]):
        self.order = list(range(filters))
        bottom: dict[Counts, Node] = {}
        row = [bottom.setdefault(x, Node(None, None, x)) for x in (counts.get(m, NOTHING) for m in range(1 << filters))]
        # bit i of a mask is filter i: the last filter is the lowest level
        self.levels: list[list[Node]] = []
        for i in reversed(range(filters)):
            unique: dict[tuple[int, int], Node] = {}
            half = 1 << i
            row = [self._node(unique, row[m], row[m + half]) for m in range(half)]
            self.levels.insert(0, list(unique.values()))
        self.root = row[0]

    @staticmethod
    def _node(unique: dict[tuple[int, int], Node], low: Node, high: Node) -> Node:
        key = id(low), id(high)
        if key not in unique:
            unique[key] = Node(low, high, _sum(low.counts, high.counts))
        return unique[key]

    def swap(self, i: int) -> None:
        """Exchange the filters of levels i and i + 1. Nodes of level i keep their
        identity, so nothing above changes, and those below level i + 1 stay."""
        unique: dict[tuple[int, int], Node] = {}
        for n in self.levels[i]:
            a, b = n.low, n.high
            n.low, n.high = self._node(unique, a.low, b.low), self._node(unique, a.high, b.high)
        self.levels[i + 1] = list(unique.values())
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> Iterator[tuple[int, Counts, Counts]]:
        """(filter, counts kept after it, counts it removes) along the all-pass path."""
        n = self.root
        for f in self.order:
            yield f, n.low.counts, n.high.counts
            n = n.low


def adjacent_swaps(n: int) -> Iterator[int]:
    """Positions i whose swaps with i + 1 run through all orders of n things, each once."""
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    down = True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        yield at + 1 if down else at
        down = not down


def audit_part(filters: str, counts: dict[int, Counts]) -> list[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) of one part, for every order of the named filters."""
    d = MaskDiagram(len(filters), counts)
    walked = [(list(d.order), list(d.steps()))]
    for i in adjacent_swaps(len(filters)):
        d.swap(i)
        walked.append((list(d.order), list(d.steps())))
    failing, alone, shapley = {}, {}, dict.fromkeys(range(len(filters)), 0)
    for _, steps in walked:
        failing[steps[0][0]] = steps[0][2][0]  # a first filter removes all that fail it
        alone[steps[-1][0]] = steps[-1][2][0]  # a last one, those that fail no other
        for f, _, gone in steps:
            shapley[f] += gone[0]
    return [
        ("".join(filters[f] for f in order), k, kept[0], gone[0], failing[f] - gone[0], alone[f], gone[1], gone[2], shapley[f])
        for order, steps in walked
        for k, (f, kept, gone) in enumerate(steps, 1)
    ]


AUDIT_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def audit_masks(masks: DataFrame, filters: str) -> DataFrame:
    """Audit rows of every part of ``masks`` (part, mask int, good int, toxic int)."""
    counted = masks.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    # at most 2**len(filters) counts a part
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in AUDIT_SCHEMA.split(", ")]
        for b in batches:
            for part, counts in zip(b["part"], b["counts"]):
                rows = audit_part(filters, {int(x["mask"]): (int(x["n"]), int(x["good"]), int(x["toxic"])) for x in counts})
                yield pd.DataFrame([(part, *r) for r in rows], columns=names)

    return parts.mapInPandas(run, AUDIT_SCHEMA)


@dataclass(frozen=True)
class TextRules:
    """least_words: A; percent_distinct: B; percent_capitals: C; signs: D."""

    least_words: int = 200
    percent_distinct: int = 50
    percent_capitals: int = 2
    signs: str = "[#$%&*|]"


FILTERS = "ABCDE"


def text_failures(text: Column, rules: TextRules = TextRules()) -> list[Column]:
    """The failure conditions of filters A to D over a text without NULLs."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n = F.size(words)
    return [
        n < rules.least_words,
        F.lit(100) * F.size(F.array_distinct(words)) < F.lit(rules.percent_distinct) * n,
        F.lit(100) * F.regexp_count(text, F.lit("[A-Z]")) > F.lit(rules.percent_capitals) * F.char_length(text),
        text.rlike(rules.signs),
    ]


def failure_masks(docs: DataFrame, labels: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """(part, mask, good, toxic) per row of ``docs`` (doc_id, text, source).

    Bit i of the mask is set if filter i of ``FILTERS`` fails; the last one, E,
    fails a text that a smaller doc_id has too, whatever the other filters say.
    Texts are compared by their SHA-256. NULL text and source count as empty;
    rows with a NULL doc_id have no smaller one and no labels; repeated rows count
    each, and equal texts of one doc_id do not fail each other. A doc_id with
    several labels counts as good or toxic if any says so. Other columns are not
    read. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("doc_id"), text.alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    bits = [F.when(x, F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(text_failures(F.col("text"), rules))]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    # the narrow rows are written once: texts are read and cut into words a single time
    narrow = c.materialise(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    # map-side minima: a text that a third of the rows repeat sends one row per task
    first = narrow.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    repeated = first.where("copies > 1").select(F.col("digest").alias("twin"), "first_id")
    known = (
        labels.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t"))
        .where("labelled IS NOT NULL")
        .groupBy("labelled")
        .agg(F.max(F.expr("int(q = 1)")).alias("q"), F.max(F.expr("int(t = 1)")).alias("t"))
    )
    return (
        narrow.join(repeated, F.col("digest") == F.col("twin"), "left")
        .join(known, F.col("doc_id") == F.col("labelled"), "left")
        .select(
            "part",
            (F.col("mask") + F.when(F.col("doc_id") > F.col("first_id"), F.lit(16)).otherwise(F.lit(0))).alias("mask"),
            F.coalesce("q", F.lit(0)).alias("good"),
            F.coalesce("t", F.lit(0)).alias("toxic"),
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame, rules: TextRules = TextRules()) -> DataFrame:
    """Every order of filters A to E over every source of ``docs``: see
    ``failure_masks`` for odd rows and ``audit_part`` for the columns."""
    return audit_masks(failure_masks(docs, labels, rules), FILTERS)
