"""Documents made ready for training: filter, deduplicate, pack.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from orderlens.llm.common import table
from orderlens.sources.staging import discard, staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from labels outside its held-out fold, does not reject.

    Null and empty texts are scored like any other; repeated rows alike; without labels nothing is rejected; an empty table gives no rows.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; a null text equals an empty one, and of rows that tie in text and id one stays."""
    return exact_dedup.dedup_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose SimHash fingerprints (word 3-shingles) differ in 2 bits or fewer the document with the smallest id.

    Texts without words share the fingerprint zero, so one of them stays. Rows without an id stay; an empty table gives no rows.
    """
    return simhash.dedup_near(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that a document of smaller id holds; n_chars counts what is left.

    Documents that lose all their text stay, empty; null texts stay null; rows of one id take nothing from each other.
    """
    cut = suffix_dedup.without_passages(docs)
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in a training sequence; a null or empty text is its end token alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("suffix_dedup", without_repeated_passages),
    ("best_fit_packing", packed),
]

# Scores, fingerprints and token ids are not expressible in SQL; tests/llm/test_pipeline.py compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents, each stage's result stored before the next reads it and dropped after."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir).select(
        "doc_id", "piece", "start", "length", F.col("ids_crc32"), "sequence_id", "offset"
    )
