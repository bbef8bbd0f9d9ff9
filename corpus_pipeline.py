"""Training-corpus pipeline: filter, deduplicate and pack the documents table.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanline.llm import common as c
from fanline.llm import paragraph_dedup, quality, toxicity
from fanline.llm.labelled import fold_is
from fanline.llm.minhash_dedup import Similarity, near_duplicates
from fanline.llm.packing import pack


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the compression-distance classifier calls toxic."""
    labels = c.read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, ~fold_is("doc_id", 5, 0))
    return docs.where(toxicity.toxicity_score(model, "text") < 0.5)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the n-gram classifier calls poor."""
    labels = c.read_table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, ~fold_is("doc_id", 3, 1))
    return docs.where(quality.quality_score(model, "text") >= 0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8), keep the smallest id."""

    def copies() -> DataFrame:
        found = near_duplicates(docs, Similarity(width=5, percent=80))
        return found.where("NOT kept").select("doc_id").distinct()

    gone = c.materialise_alone(copies, "copies")
    return docs.join(gone, "doc_id", "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated passages out of the texts; n_chars follows."""
    cut = paragraph_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens."""
    return pack(docs, with_tokens=False)


STAGES = [
    ("toxicity", keep_harmless),
    ("quality", keep_good),
    ("minhash_near_dedup", keep_one_of_each),
    ("paragraph_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: no SQL form: trained classifiers, min-hashing and a tokenizer; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = c.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = c.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
