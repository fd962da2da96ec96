"""SNK-6, JOIN-1, JOIN-2, FLT-5: published tables kept in buckets, so that a batch comes to them.

Stored rows are dealt into buckets by their key when they are written, once. Whatever meets them by the key
later is dealt the same way: only the batch moves, never the stored side, and two stored tables meet
without any exchange. Buckets are by the whole key, time included, so a hot series is in all of them.

For marks per series a small table beside the rows has the latest time of each series; it is added to with
every append, and the mark of a series is the maximum over its few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.operators.keyed import one_per_key, with_time
from barlake.operators.lookup import attach
from barlake.schema import BAR_COLUMNS, KEY, SERIES, TS

BUCKETS = 64
MARKS = "_marks"


def append_bucketed(
    bars: DataFrame, table: str, path: str, buckets: int = BUCKETS, candidates: DataFrame | None = None
) -> int:
    """Add bars to a bucketed table, and their latest times to its marks; returns the number of rows.

    ``path`` is the folder of the table's files. Rows are dealt first, so every task writes one bucket and an
    append adds one file to each. Marks are taken from ``candidates``, rows that are all in the table once
    ``bars`` are (by default ``bars``). They follow the rows: after a failure in between they lag behind, and rows
    that are met again are known by their keys.
    """
    if not with_time(bars).sparkSession.catalog.tableExists(table):
        empty = bars.select(*BAR_COLUMNS).limit(0)
        empty.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).mode("append").saveAsTable(table)
        empty.select(*KEY).write.option("path", f"{path}{MARKS}").mode("append").saveAsTable(f"{table}{MARKS}")
    dealt = with_time(bars).select(*BAR_COLUMNS).repartition(buckets, *[F.col(c) for c in KEY])
    written = Observation()
    counted = dealt.observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).mode("append").saveAsTable(table)
    if written.get["n"]:
        marks = with_time(bars if candidates is None else candidates).groupBy(*SERIES).agg(F.max(TS).alias(TS))
        marks.write.option("path", f"{path}{MARKS}").mode("append").saveAsTable(f"{table}{MARKS}")
    return written.get["n"]


def unknown_rows(batch: DataFrame, target: DataFrame) -> DataFrame:
    """JOIN-1: rows of the batch whose key the bucketed target lacks; the target is scanned, not shuffled."""
    return batch.join(target.select(*KEY).hint("merge"), KEY, "left_anti")


def skip_stored_conflicts(batch: DataFrame, target: DataFrame) -> DataFrame:
    """JOIN-2, SNK-6: the first row of each key of the batch, none that is in the target. One exchange, of the batch."""
    return unknown_rows(one_per_key(with_time(batch)), target).select(*BAR_COLUMNS)


def series_marks(spark: SparkSession, table: str) -> DataFrame:
    """(series, latest): the publish mark of each series, from the marks alone."""
    return spark.table(f"{table}{MARKS}").groupBy(*SERIES).agg(F.max(TS).alias("latest"))


def publish_bucketed(bars: DataFrame, table: str, path: str, scope: str = "global", buckets: int = BUCKETS) -> int:
    """Append what is behind the mark and not there yet; returns the number of rows. A repeated publish adds none."""
    spark = bars.sparkSession
    if not spark.catalog.tableExists(table):
        return append_bucketed(one_per_key(with_time(bars)), table, path, buckets)
    newer = newer_than_marks(bars, table, scope)
    return append_bucketed(skip_stored_conflicts(newer, spark.table(table)), table, path, buckets, newer)


def newer_than_marks(bars: DataFrame, table: str, scope: str = "global") -> DataFrame:
    """FLT-5 by the marks of a bucketed table: bars after its latest time, or after that of their series."""
    marks = series_marks(bars.sparkSession, table)
    if scope == "global":
        latest = marks.agg(F.max("latest")).first()[0]
        return bars if latest is None else bars.where(F.col(TS) > F.lit(str(latest)).cast("timestamp_ntz"))
    if scope != "series":
        raise ValueError(f"unknown watermark scope {scope!r}")
    marked = attach(bars, marks.withColumnRenamed("latest", "_latest"), SERIES)
    return marked.where(f"_latest IS NULL OR {TS} > _latest").drop("_latest")
