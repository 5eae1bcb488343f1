"""Registered queries of the corpus operators, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import (
    bpe,
    chat_format,
    embedding_dedup,
    exact_dedup,
    lexical_search,
    license_scan,
    mixing,
    packing,
    quality,
    simhash,
    suffix_dedup,
    token_alignment,
    url_filter,
)
from orderlens.llm.common import settle, table
from orderlens.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files source/lang/<id div 1000>/<id div 100>/<id>.

    A document with a licence match of its own, whatever its length, is a licence file, LICENSE-<id>. It lies 0 to 3 folders
    (id mod 4) above the folder that its id has otherwise, and gives to all below. A row without an id is a file named
    ``null`` of its folder, scanned like any other; such rows share the best match.
    Returns doc_id, path, license, score, found_in, origin.
    """
    docs = table(spark, sf_dir, "documents")
    own = settle(license_scan.scan_texts(docs, path_col="doc_id").withColumnRenamed("path", "_id"), "own_ids")
    docs = docs.withColumn("_name", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    own = own.withColumn("_id", F.coalesce("_id", F.lit("null")))
    own = own.groupBy("_id").agg(F.max(F.struct("score", "license")).alias("b")).select("_id", "b.license", "b.score")
    name = F.col("_name")
    gives = F.col("license").isNotNull()
    above = F.when(gives, F.coalesce(F.pmod("doc_id", F.lit(4)), F.lit(0))).otherwise(0)
    folders = F.array_compact(F.array("source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 100).cast("string")))
    folders = F.slice(folders, F.lit(1), F.greatest(F.size(folders) - above, F.lit(0)).cast("int"))
    path = F.concat_ws("/", folders, F.when(gives, F.concat(F.lit("LICENSE-"), name)).otherwise(name))
    files = docs.join(own, name == F.col("_id"), "left").select("doc_id", path.alias("path"), "license", "score")
    files = settle(files, "files")
    mine = files.where("license IS NOT NULL").groupBy("path").agg(F.max(F.struct("score", "license")).alias("b"))
    found = license_scan.inherited(files.select("path", "doc_id"), mine.select("path", "b.license", "b.score"))
    return found.select("doc_id", "path", "license", "score", "found_in", "origin")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.passages(table(spark, sf_dir, "documents")).drop("spans")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_texts(table(spark, sf_dir, "documents"), path)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat_format.digest(chat_format.format_conversations(rows.unionByName(more)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("_id").alias("doc_id"), F.col("_keep_id").alias("keep_id"), F.col("_group_size").alias("group_size"),
        F.col("_kept").alias("kept"), F.col("_sha256").alias("text_sha256"),
    )


def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align(table(spark, sf_dir, "documents"), a, b)[0]


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_chat_format": op9_chat_format,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_mix_sources": op11_mix_sources,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}
