"""Stores of batches: one folder per batch id under one path, replaced when the batch is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.sources.lake import path_exists

BATCH = "batch_id"


def write_batch(rows: DataFrame, path: str, batch_id: str) -> int:
    """Write rows as one batch of a store and return their number.

    Repeating a batch replaces its rows; a batch without rows writes nothing. Spark escapes the id in
    the folder's name, so readers filter on the column and never build the name themselves.
    """
    if not batch_id:
        raise ValueError("a batch needs an id")
    written = Observation()
    counted = rows.withColumn(BATCH, F.lit(batch_id)).observe(written, F.count(F.lit(1)).alias("n"))
    out = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(BATCH).parquet(path)
    return written.get["n"]


def read_batches(spark: SparkSession, path: str, schema: T.StructType, batch_id: str | list[str] | None = None) -> DataFrame:
    """Rows of one batch or several, for which only their folders are read, or of all."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])).parquet(path)
    wanted = [batch_id] if isinstance(batch_id, str) else batch_id
    return (rows if wanted is None else rows.where(F.col(BATCH).isin(wanted))).drop(BATCH)


def batch_ids(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id) of the batches of a store; no column of their rows is read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{BATCH} string")
    return spark.read.schema(f"{BATCH} string").option("basePath", path).parquet(path).select(BATCH).distinct()
