"""The corpus pipeline: each stage works on what its predecessor kept.

Stages take and return the columns of ``documents``; the last one returns token ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.llm import bpe, decontaminate, ngram_join, pii, quality
from tallykeep.llm.common import shared_root, table
from tallykeep.llm.queries import vocabulary
from tallykeep.session import remove_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality rules accept."""
    return quality.keep_good(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of linked documents.

    Groups are those of five-word shingles and a similarity of at least 0.8.
    """
    return ngram_join.first_of_each(docs, ngram_join.NEAR_DUPLICATE)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain an item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; the number of characters follows."""
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    return bpe.encoded_digest(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", pii_redaction),
    ("BPE encoding and decoding", bpe_encoding),
]

# Quality keys, trained trees and BPE have no SQL form; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written and read again.

    Only the last stage's files stay, below the shared folder, as the result reads them.
    """
    folder = f"{shared_root(spark).rstrip('/')}/tallykeep-corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}-{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
