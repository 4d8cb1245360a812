"""A training corpus from raw documents: filter, drop common lines, drop near copies, mask secrets, pack.

Each stage takes the documents its predecessor kept, all of them, and its decisions take effect: rejected documents are
gone, repeated lines are cut from texts, one document of each group of near copies stays, secrets are masked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.llm import bpe, line_dedup, near_copies, packing, quality, secret_scan
from facetry.llm.common import table, written
from facetry.llm.queries import vocabulary


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of documents, n_chars after the text as it is now."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("long"))
    return changed.select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(docs, quality.draw(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(docs, line_dedup.dedup_lines(docs))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(docs, near_copies.keep_one(docs))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(docs, secret_scan.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers still hold what the stages before left in them, so the memo is smaller than packing alone may have
    return packing.pack(docs, vocabulary(), keep_ids=False, memo=bpe.MEMO)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_copy_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Hashed n-gram models, fingerprints and byte-pair merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
