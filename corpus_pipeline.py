"""Corpus pipeline: documents to a filtered, deduplicated, decontaminated, mixed and encoded corpus.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents;
the last returns, per row it was given, doc_id, start, n_tokens and ids_crc32.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postmill.llm import bagminhash, containment, huffman_ids, quality_ratio, queries, systematic_mix
from postmill.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ratio.kept_documents(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.first_of_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return containment.without_items(docs, queries.table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return systematic_mix.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return huffman_ids.encoded(docs, queries.tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token ids", token_ids),
]

# Signatures, tokens and word hashes have no SQL. tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i}")
    return docs
