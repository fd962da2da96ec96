"""DQ-9: what became of each landing file or answer, the latest batch of a file winning.

A batch adds one small row for each of its files: the reason why the file could not be used as a whole, or
none. A file that is mended later is no error any more, and no raw line is read again to find that out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.plans.clean import FETCH_ERROR, file_reasons
from barlake.sinks.batches import read_batches, write_batch

NUMBER = "number"
STATES = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField(NUMBER, T.LongType()),
    ]
)


def latest_states(states: DataFrame) -> DataFrame:
    """(source_file, reason): of each file the row with the highest number."""
    return states.groupBy("source_file").agg(F.max_by("reason", NUMBER).alias("reason"))


def errors_of(states: DataFrame, with_fetches: bool = False) -> DataFrame:
    """(source_file, reason) of files that cannot be used as they last came. An answer that failed is no file;
    it counts only where asked for."""
    found = latest_states(states).where("reason IS NOT NULL")
    return found if with_fetches else found.where(F.col("reason") != FETCH_ERROR)


def add_file_states(cleaned: DataFrame, path: str, batch_id: str) -> None:
    """The files of a batch, numbered behind all others; a repeated batch replaces its rows."""
    last = read_states(cleaned.sparkSession, path).agg(F.max(NUMBER)).first()[0]
    number = F.lit(0 if last is None else last + 1).cast("long")
    write_batch(file_reasons(cleaned).withColumn(NUMBER, number), path, batch_id)


def read_states(spark: SparkSession, path: str, batch_id: str | None = None) -> DataFrame:
    return read_batches(spark, path, STATES, batch_id)


def current_errors(spark: SparkSession, path: str, with_fetches: bool = False) -> DataFrame:
    return errors_of(read_states(spark, path), with_fetches)
