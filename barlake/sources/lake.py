"""SRC-7, SRC-8, SRC-12: reading stored bars and published tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.schema import BAR_COLUMNS, BARS, TS, VALUES, YEAR
from barlake.sources.generations import GENERATION, without_old_generations

STORED = T.StructType([*BARS.fields, *[T.StructField(c, T.IntegerType()) for c in (YEAR, GENERATION)]])


def empty_bars(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BARS)


def read_bars(
    spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """SRC-7, SRC-8: one multi-file scan of a Parquet store of bars, all series at once.

    The schema is given, never inferred: a store with daily bars only would otherwise read its
    ``timeframe=1d`` folders as the number 1.0. A time range prunes the year folders and, by file
    statistics, the files inside them. Of a folder that was rewritten only the highest generation is read.
    """
    stored = without_old_generations(spark.read.schema(STORED).parquet(path), spark, path)
    for bound, year_test, ts_test in ((since, ">=", ">="), (until, "<=", "<=")):
        if bound is not None:
            stored = stored.where(f"{YEAR} {year_test} {bound.year} AND {TS} {ts_test} TIMESTAMP_NTZ '{bound}'")
    return stored.selectExpr(*[f"nullif({c}, double('NaN')) AS {c}" if c in VALUES else c for c in BAR_COLUMNS])


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists on whatever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_bars_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: the store, or no bars where it was never written."""
    return read_bars(spark, path) if path_exists(spark, path) else empty_bars(spark)


def latest_time(target: DataFrame, column: str = TS) -> DataFrame:
    """SRC-12, AGG-2: one row with the latest time of a table, NULL when it is empty.

    Only the time column is read.
    """
    return target.agg(F.max(column).alias("latest"))
