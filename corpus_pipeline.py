"""From raw documents to packed training sequences, in stages that each write a table.

Documents that the quality classifier rejects go, one of each group of near copies stays, personal data is
replaced in the texts, sources are mixed to their target weights, and the result is packed into token windows.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from customer_canon.llm import mixing, near, packing, pii, quality
from customer_canon.llm.common import checkpoint_folder, drop_folder, table

#: Documents below this score are rejected.
LEAST_QUALITY = 0.3

#: SQL cannot train the classifier, align texts or run the tokenizer.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Those that the quality classifier, trained on the labelled ones among them, does not reject."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.good_documents(docs, model, LEAST_QUALITY)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.deduplicated(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redacted(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or cut as their source's share asks."""
    return mixing.mixture(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens, with their ids."""
    return packing.pack_documents(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        with_ids=True,
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near_copies", without_near_copies),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads the table that the one before wrote.

    The tables are in the shared folder of checkpoints. A stage's input goes once its output is written.
    """
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            drop_folder(spark, before)
        before = f"{folder}/{name}"
    return docs
