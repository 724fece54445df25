"""A training corpus from raw documents: the stages in order, and all of them at once.

1. ``quality``: documents that the classifier rejects go.
2. ``line_dedup``: later copies of repeated runs of lines are cut out of the texts.
3. ``near_dedup``: one document of each group of near duplicates stays.
4. ``decontaminate``: documents with a benchmark passage go.
5. ``pack``: the rest is tokenised and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeway.llm import decontaminate, lines, pack, quality, simhash
from ridgeway.llm.common import read, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.7; the classifier learns from the labels of ``docs``."""
    return quality.drop_rejected(docs, read(spark, sf_dir, "labels"), threshold=0.7)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines in runs of 50 words or more that occur earlier."""
    return lines.dedup_lines(docs, min_words=50)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints of 3-word shingles within 3 bits."""
    return simhash.keep_one(docs, width=3, radius=3)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of 10 benchmark words."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), window=10)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return pack.pack(docs, capacity=2048)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pack", pack_stage),
]

#: The classifier and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
