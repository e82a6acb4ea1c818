"""The corpus pipeline: quality, exact copies, near copies, mixture, tokens.

Each stage takes (spark, docs, folder) and returns what it keeps; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
as Parquet in the shared folder and reads it back for the next one.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import bpe, exact, mixture, neardup, quality
from tallyforge.session import ensure_checkpoint_dir

#: The near-duplicate stage: words of a shingle, similarity in hundredths.
SHINGLE_WORDS, SIMILARITY = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.good_documents(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays."""
    return neardup.drop_near(docs, width=SHINGLE_WORDS, above=SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row for each time a document is taken, in training order."""
    return mixture.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe.bpe_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("source mixture", mix_sources),
    ("byte-level BPE", encode_texts),
]

#: The classifier, the near copies and the tokens have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{out}/{number}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
