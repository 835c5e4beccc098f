"""A training corpus from `documents`: without toxic texts and near copies, secrets masked, sources mixed, encoded.

STAGES lists (name, function); each function takes (spark, docs, sf_dir).  The result of each stage is written to the
shared folder as Parquet and read again as the next one's documents.  The last one returns ids instead of texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spolia.llm import bpe_pieces, mixing, ngram_join, secret_links, toxicity
from spolia.llm.common import DOCUMENT_COLUMNS, table, written

NEAR_WORDS, NEAR_PERCENT = 5, 80
RANKS = "byte_bpe_50k.tiktoken"
BATCH_ROWS = 500  # whole texts in an Arrow batch; Spark's default of 10,000 fills an executor


def small_batches(spark: SparkSession) -> None:
    """For the session, as a stage's plan runs when the caller writes it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"), DOCUMENT_COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.one_of_each(docs, DOCUMENT_COLUMNS, NEAR_WORDS, NEAR_PERCENT)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secret_links.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids` (little-endian unsigned 32-bit integers), and checksums of ids and decoded bytes."""
    small_batches(spark)
    return bpe_pieces.digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_join", without_near_copies),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: SQL cannot express the first stage's model nor the last one's merges; tests/llm/test_pipeline.py has the plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
