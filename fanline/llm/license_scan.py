"""License scans: an exact set-similarity join of text blocks with templates.

A text is lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
Its blocks are the runs of twice ``half`` words that start at every ``half``
words, ``half`` being at least as long as the longest template: whatever stands in
``half`` consecutive words lies whole in a block, wherever lines break. A block
meets a template if it holds at least ``percent`` of the template's distinct
words.

The join. Words of the templates are ordered by the number of blocks that hold
them, rarest first, over the whole table. Two sets that share enough words share
one within their prefixes in that order, so only prefix words are joined; the
length filter leaves out blocks with too few words, the positional filter pairs
whose words after the shared one cannot suffice. What is left is verified on the
full sets, so no block that meets the threshold is missed and none is added.

Base labels come from phrases whose words stand consecutively.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fanline.llm import common as c

# fixed values: phrases and the labels that they give
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# fixed values: opening words of public license notices, by family of license
TEMPLATES = [
    ("this work is licensed under the gnu general public license", "gnu"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu"),
    ("this work is licensed under a creative commons attribution international license", "creative-commons"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

# A-Z become a-z; other bytes below x80 but a-z and 0-9 separate words
_WORD_BYTES = bytes(
    x + 32 if 0x41 <= x <= 0x5A else x if x >= 0x80 or 0x61 <= x <= 0x7A or 0x30 <= x <= 0x39 else 0x20 for x in range(256)
)

DOCUMENT_SCHEMA = (
    "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base array<string>, blocks array<struct<block:long,words:array<int>>>"
)


def words_of(text) -> list[bytes]:
    return c.text_of(text).encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Templates:
    """Templates as sets of word numbers (a bounded list that the caller states).

    A template without words is refused: every block would meet it."""

    labels: tuple[str, ...]
    sets: tuple[tuple[int, ...], ...]
    words: tuple[bytes, ...]
    needs: tuple[int, ...]
    half: int

    @classmethod
    def of(cls, templates: list[tuple[str, str]], percent: int) -> "Templates":
        cut = [words_of(t) for t, _ in templates]
        if not all(cut) or not 0 < percent <= 100:
            raise ValueError("a template has words, and the threshold is 1 to 100 percent")
        words = tuple(sorted({w for x in cut for w in x}))
        number = {w: k for k, w in enumerate(words)}
        sets = tuple(tuple(sorted({number[w] for w in x})) for x in cut)
        return cls(
            tuple(label for _, label in templates),
            sets,
            words,
            tuple(-(-percent * len(s) // 100) for s in sets),
            max([32, *(len(x) for x in cut)]),
        )


def phrase_starts(words: list[bytes], phrases: list[list[bytes]]) -> list[list[int]]:
    """For each phrase, the places (in words, from 0) where it stands."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for p in phrases:
        needle, starts, seen, spaces = b" " + b" ".join(p) + b" ", [], 0, 0
        at = joined.find(needle)
        while at >= 0:
            spaces += joined.count(b" ", seen, at)
            seen = at
            starts.append(spaces)
            at = joined.find(needle, at + 1)
        out.append(starts)
    return out


def _blocks(words: list[bytes], number: dict[bytes, int], half: int, least: int) -> list[tuple[int, np.ndarray]]:
    """(block, distinct template words) of the blocks that hold at least ``least``."""
    of = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
    at = np.flatnonzero(of >= 0)
    if len(at) < least:
        return []
    n = len(number)
    step = at // half
    # a block is its own step and the next one; the last step alone adds nothing to the block before it
    last = max(0, -(-len(words) // half) - 2)
    cells = np.unique(np.concatenate((np.minimum(step, last) * n + of[at], np.maximum(step - 1, 0) * n + of[at])))
    block, first, sizes = np.unique(cells // n, return_index=True, return_counts=True)
    token = (cells % n).astype(np.int32)
    return [(int(b), token[a : a + k]) for b, a, k in zip(block, first, sizes) if k >= least]


def scan_documents(docs: DataFrame, phrases: list[tuple[str, str]], t: Templates) -> DataFrame:
    """Rows of ``DOCUMENT_SCHEMA``, one per row of ``docs`` (doc_id, text)."""
    number = {w: k for k, w in enumerate(t.words)}
    half, least = t.half, min(t.needs, default=1)
    cut, labels = [words_of(p) for p, _ in phrases], [label for _, label in phrases]
    names = [x.split()[0] for x in DOCUMENT_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                words = words_of(text)
                starts = phrase_starts(words, cut)
                places = [x for s in starts for x in s]
                out.append(
                    (
                        row,
                        None if doc_id is None else int(doc_id),
                        len(words),
                        len(places),
                        min(places) if places else None,
                        max(places) if places else None,
                        sorted({label for label, s in zip(labels, starts) if s}),
                        [{"block": k, "words": w} for k, w in _blocks(words, number, half, least)],
                    )
                )
                row += 1
            # object columns keep whole numbers whole beside NULLs
            yield pd.DataFrame(out, columns=names, dtype=object)

    return docs.mapInPandas(run, DOCUMENT_SCHEMA)


def block_matches(scanned: DataFrame, t: Templates) -> DataFrame:
    """(row, doc_id, block, template int, shared int) of every block of ``scanned``
    that meets a template: the exact join."""
    spark = scanned.sparkSession
    blocks = scanned.select("row", "doc_id", F.explode("blocks").alias("b")).select("row", "doc_id", "b.block", "b.words")
    held = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # one count per template word
    n = {r["word"]: r["n"] for r in held.collect()}
    order = sorted(range(len(t.words)), key=lambda k: (n.get(k, 0), t.words[k]))
    rank = {w: k for k, w in enumerate(order)}
    ranks = F.array(*[F.lit(rank[k]) for k in range(len(t.words))])
    sets = [sorted(rank[w] for w in s) for s in t.sets]
    entries = [
        (k, i, s[i], s, len(s), need) for k, (s, need) in enumerate(zip(sets, t.needs)) for i in range(len(s) - need + 1)
    ]
    # bounded by the templates' words
    prefixes = F.broadcast(
        spark.createDataFrame(entries, "template int, place int, first int, own array<int>, size int, need int")
    )
    least = min(t.needs)
    ordered = blocks.withColumn("words", F.array_sort(F.transform("words", lambda w: F.get(ranks, w))))
    # of a block's words, only those of its own prefix that are in some template's prefix
    starts = F.array(*[F.lit(x) for x in sorted({e[2] for e in entries})])
    prefix = F.slice("words", F.lit(1), F.size("words") - F.lit(least - 1))
    probes = ordered.where(F.arrays_overlap(prefix, starts)).select(
        "row", "doc_id", "block", "words", F.posexplode(prefix).alias("at", "word")
    )
    # the words from the shared one on, itself included
    may_reach = F.least(F.col("size") - F.col("place"), F.size("words") - F.col("at")) >= F.col("need")
    pairs = probes.join(prefixes, (F.col("word") == F.col("first")) & (F.size("words") >= F.col("need")) & may_reach)
    shared = F.size(F.array_intersect("words", "own"))
    met = pairs.select("row", "doc_id", "block", "template", "need", shared.alias("shared")).where("shared >= need")
    return met.select("row", "doc_id", "block", "template", "shared").distinct()


def license_matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = 80) -> DataFrame:
    """(doc_id, first_word, last_word, label, template, containment) of every text block
    that meets a template; odd rows as for ``license_scan``."""
    t = Templates.of(templates, percent)
    scanned = c.materialise(scan_documents(_plain(docs), [], t), "license-blocks")
    n_words = scanned.select(F.col("row").alias("of_row"), "n_words")
    first = F.col("block") * t.half
    return (
        block_matches(scanned, t)
        .join(n_words, F.col("row") == F.col("of_row"))
        .select(
            "doc_id",
            first.alias("first_word"),
            (F.least(first + 2 * t.half, F.col("n_words")) - 1).alias("last_word"),
            _pick(list(t.labels)).alias("label"),
            _pick([x for x, _ in templates]).alias("template"),
            (F.col("shared") / _pick([len(s) for s in t.sets])).alias("containment"),
        )
    )


def _pick(values: list):
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("template"))


def _plain(docs: DataFrame) -> DataFrame:
    # ids travel as text: pandas would turn a column with NULLs into doubles
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))


def license_scan(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    percent: int = 80,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for
    every row of ``docs`` (doc_id, text); other columns are not read.

    score is 1 where a phrase stands, else the largest share of a template that a
    block holds if it meets the threshold, else 0. NULL texts count as empty: no
    words, no labels (empty strings) and NULL places. Rows with NULL or repeated
    ids are scanned each for itself; an empty table gives no rows.
    """
    t = Templates.of(templates, percent)
    scanned = c.materialise(scan_documents(_plain(docs), phrases, t), "license-blocks")
    found = block_matches(scanned, t).groupBy(F.col("row").alias("of_row")).agg(
        F.collect_set(_pick(list(t.labels))).alias("more"), F.max(F.col("shared") / _pick([len(s) for s in t.sets])).alias("held")
    )
    own = scanned.select("row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base")
    both = F.concat("base", F.coalesce("more", F.array().cast("array<string>")))
    return own.join(found, F.col("row") == F.col("of_row"), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("held", F.lit(0.0))).alias("score"),
    )
