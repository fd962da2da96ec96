"""Queries over the driver's tables, one per operator, each with its production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import mixing, quality, sharding, simplex_clusters
from barlake.llm.alignment import align
from barlake.llm.decontamination import leaks
from barlake.llm.graph_search import nearest
from barlake.llm.packing import pack
from barlake.llm.pii import find_pii
from barlake.llm.simhash import near_duplicates
from barlake.llm.simple8b import encoded_and_read
from barlake.llm.token_counts import token_counts
from barlake.llm.url_lm import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(_table(spark, sf_dir, "documents"))


def op4_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op5_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def op6_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = encoded_and_read(_table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(_table(spark, sf_dir, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    columns = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    return pack(docs).select(*columns)


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_digest(_table(spark, sf_dir, "documents"))


def op12_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex_clusters.clustered(_table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_graph_neighbours": op1_graph_neighbours,
    "op2_hash_shards": op2_hash_shards,
    "op3_pii_spans": op3_pii_spans,
    "op4_quality_scores": op4_quality_scores,
    "op5_url_verdicts": op5_url_verdicts,
    "op6_simple8b_ids": op6_simple8b_ids,
    "op7_window_packing": op7_window_packing,
    "op8_simhash_groups": op8_simhash_groups,
    "op9_token_counts": op9_token_counts,
    "op10_benchmark_leaks": op10_benchmark_leaks,
    "op11_source_mix": op11_source_mix,
    "op12_simplex_clusters": op12_simplex_clusters,
    "op13_token_alignment": op13_token_alignment,
}
ORACLE_SQL = {
    "op2_hash_shards": sharding.oracle(),
    "op11_source_mix": mixing.oracle(),
    "op12_simplex_clusters": simplex_clusters.oracle(),
}
