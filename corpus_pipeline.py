"""The training-data pipeline over ``documents``: each stage works on all that its predecessor kept.

All stages but the last return the columns of ``documents``: rejected documents, further copies and
documents with benchmark items are gone, and personal data is replaced by its kind. The last returns
the pieces of the packed windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import decontamination, pii, quality, simhash
from barlake.llm.queries import packed_digest
from barlake.llm.scratch import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_digest(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("pii", hide_pii),
    ("packing", pack_windows),
]

#: Its stages are trained models and alignments; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
