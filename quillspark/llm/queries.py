"""The driver's queries for the operators of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.byte_bpe import byte_bpe_digests
from quillspark.llm.centroids import centroid_digest, lloyd_clusters
from quillspark.llm.decontamination import find_contamination
from quillspark.llm.embedding_dedup import near_embeddings
from quillspark.llm.fingerprints import fingerprint_neighbours
from quillspark.llm.language_id import identify_languages, train_models
from quillspark.llm.licences import scan_licences, train_licences
from quillspark.llm.minhash import near_duplicates
from quillspark.llm.oracles import clusters_sql, contamination_sql, judge_urls_sql, near_duplicates_sql, near_embeddings_sql
from quillspark.llm.packing import pack_documents
from quillspark.llm.token_counts import token_counts
from quillspark.llm.toxicity import score_toxicity, train_toxicity
from quillspark.llm.url_filters import judge_urls
from quillspark.llm.whitening import whitened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budget=1024)


#: The rules of the url query, each a verdict and what it fits (fixed values).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, train_models(docs))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_licences(docs, train_licences(docs))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    n_hit = F.size("hit_words").cast("long")
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"), components=16, scale=64, offset=1_000_000)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lloyd_clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed="2:")
    return found.withColumn("centroid_sha256", centroid_digest(F.col("centroid"))).drop("centroid")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_url_filters, op3_toxicity, op4_fingerprints, op5_language_id, op6_licences, op7_byte_bpe, op8_embedding_near_dedup, op9_minhash_near_dedup, op10_best_fit_packing, op11_benchmark_decontamination, op12_embedding_whitening, op13_centroid_clustering)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filters": judge_urls_sql(URL_RULES),
        "op8_embedding_near_dedup": near_embeddings_sql(0.95),
        "op9_minhash_near_dedup": near_duplicates_sql(4, 80),
        "op11_benchmark_decontamination": contamination_sql(10),
        "op13_centroid_clustering": clusters_sql(k=40, rounds=5, dim=64, scale=256, seed="2:"),
    }
