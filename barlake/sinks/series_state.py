"""FRS-1, FRS-2, AGG-1, SRC-11: rows and time range of each series, kept up with every append.

Counts, first and last times are sums, minima and maxima, so the state of a master is put together from one
small summary for each batch of rows it got. A batch that is repeated replaces its own summary. Freshness,
existing series and their latest times are read from here; the bars are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.counters import series_summary
from barlake.schema import SERIES, TICKER, TIMEFRAME
from barlake.sinks.batches import BATCH, read_batches, write_batch
from barlake.sources.lake import path_exists

SUMMARY = T.StructType(
    [
        T.StructField(TICKER, T.StringType()),
        T.StructField(TIMEFRAME, T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("first_ts", T.TimestampNTZType()),
        T.StructField("latest_ts", T.TimestampNTZType()),
    ]
)
#: The batch that stands for all rows a master had before its state was kept, or was merged into.
BASE = "base"


def combined(summaries: DataFrame) -> DataFrame:
    """One row per series from any number of partial summaries."""
    return summaries.groupBy(*SERIES).agg(
        F.sum("records").alias("records"), F.min("first_ts").alias("first_ts"), F.max("latest_ts").alias("latest_ts")
    )


def add_to_state(added: DataFrame, path: str, batch_id: str) -> None:
    """Put the summary of a batch's appended rows into the state."""
    if batch_id == BASE:
        raise ValueError(f"the batch id {BASE!r} is taken")
    write_batch(series_summary(added), path, batch_id)


def rebuild_state(bars: DataFrame, path: str) -> None:
    """The state of all rows of a master, from the bars; it replaces what was kept."""
    whole = series_summary(bars).withColumn(BATCH, F.lit(BASE))
    whole.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BATCH).parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """(series, records, first_ts, latest_ts), one row per series."""
    return combined(read_batches(spark, path, SUMMARY))


def has_state(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)
