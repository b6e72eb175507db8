"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; what it returns is written as
Parquet and read again as the next stage's documents. All but the last return the columns of ``documents``.

Defined cases, for every stage: other columns may be null or have any name and stay as they are; an empty table gives an empty one. A
null or empty text is scored like any other, equals other null and empty texts in exact dedup, is never a near copy, has no words to take out, and is
packed as its end token. A row with a null id is scored, and compared in exact dedup only. Rows that repeat an id keep their own texts. Ties go to the largest id in
exact dedup, to the smallest in near and substring dedup.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from churn_engine.llm import exact_dedup, near_dedup, packing, quality, substring_dedup
from churn_engine.llm.common import store, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labelled documents that are still there."""
    return quality.drop_poor(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_copies(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages of 50 words and more that a document with a smaller id also has go."""
    return substring_dedup.drop_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("substring dedup", substring_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier, the near dedup and the packing have no SQL; the tests hold exact, near and substring dedup against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
