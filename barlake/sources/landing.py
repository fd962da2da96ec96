"""SRC-5, SRC-6, SRC-9, SRC-10, PRJ-1: landing CSV files, all of them in one scan.

Every file brings its own header: on its first line, or below a line of labels; with the columns in
any order; and its keys only in its name. The header row of each file is found by content and
joined back by file, so one text scan serves every layout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.parsing import cell_text, csv_cells, decoded_file_name, file_stem, ticker_of, timeframe_of
from barlake.operators.lookup import BROADCAST_ROWS, attach
from barlake.schema import DAILY, DAILY_KEY, INTRADAY, INTRADAY_KEY, SEQ, TICKER, TIMEFRAME, VALUES

PLACE, BLOCK_START = "place", "block_start"


def key_name(timeframe: Column) -> Column:
    """Name of the time column of a file: by its bar size."""
    return F.when(timeframe == DAILY, DAILY_KEY).otherwise(INTRADAY_KEY)


def as_landing_lines(text: DataFrame) -> DataFrame:
    """Lines of a text scan (batch or stream) with their file and the byte at which their part of it starts."""
    return text.select(
        F.col("value").alias("line"),
        decoded_file_name(F.col("_metadata.file_name")).alias("source_file"),
        F.col("_metadata.file_block_start").alias(BLOCK_START),
    )


def with_place(lines: DataFrame) -> DataFrame:
    """Lines with a ``place`` that rises along each file, taken where they are scanned.

    Parts of a file are told apart by the byte they start at, whichever tasks read them in whatever order;
    within a part lines count up. From then on the place is a value like any other: a shuffle
    in between does not change it. Lines that were placed before keep their place. Lines that come
    from no scan count up in the order they have.
    """
    if PLACE in lines.columns:
        return lines
    count = F.monotonically_increasing_id()
    if BLOCK_START in lines.columns:
        # Parts are at least 64 KB long; a task reads fewer than 2^33 lines.
        part = F.shiftleft(F.shiftright(BLOCK_START, 16), 33)
        count = part + count.bitwiseAND(F.lit((1 << 33) - 1))
    return lines.withColumn(PLACE, count).drop(BLOCK_START)


def read_landing(spark: SparkSession, path: str | list[str], timeframes: list[str] | None = None) -> DataFrame:
    """SRC-6, SRC-8, SRC-10: all lines of the ``*.csv`` files of the given bar sizes.

    The bar size is matched on the file name before any file is opened.
    """
    sizes = timeframes or [DAILY, *INTRADAY]
    return with_place(
        as_landing_lines(spark.read.option("pathGlobFilter", "*_{" + ",".join(sizes) + "}.csv").text(path))
    )


def files_may_be_broadcast(lines: DataFrame) -> bool:
    """For lines straight from a text scan: the file list of the scan bounds the files, no job needed."""
    return 0 < len(lines.inputFiles()) <= BROADCAST_ROWS


def with_file_keys(lines: DataFrame) -> DataFrame:
    """SRC-9: ticker and timeframe from the file name."""
    stem = file_stem(F.col("source_file"))
    return lines.withColumn(TICKER, ticker_of(stem)).withColumn(TIMEFRAME, timeframe_of(stem))


def cells_by_column(lines: DataFrame, columns: list[str] | None = None, files_fit: bool | None = None) -> DataFrame:
    """PRJ-1, SRC-5: lines to named text cells, header rows removed.

    Adds ``key_text`` and one text column per entry of ``columns``, plus ``cells`` (all cells) and
    ``has_header``. Rows of a file without a usable header keep NULL cells. ``seq`` is the place of the
    line in its file (``with_place``).

    ``files_fit`` says whether a table with one row per file may be broadcast; by default its rows
    are counted first, which scans the text once more (``files_may_be_broadcast`` avoids that).
    """
    columns = columns or [c.capitalize() for c in VALUES]
    rows = (
        with_file_keys(with_place(lines))
        .withColumnRenamed(PLACE, SEQ)
        .withColumn("cells", csv_cells(F.col("line")))
        .withColumn("_is_header", F.array_contains(F.col("cells"), key_name(F.col(TIMEFRAME))))
        .withColumn("_is_header", F.coalesce("_is_header", F.lit(False)))
    )
    headers = (
        rows.where("_is_header")
        .groupBy("source_file", TIMEFRAME)
        .agg(F.min_by("cells", SEQ).alias("_header"), F.min(SEQ).alias("_header_seq"))
    )
    position = lambda name: F.array_position(F.col("_header"), name)
    places = headers.select(
        "source_file",
        "_header_seq",
        position(key_name(F.col(TIMEFRAME))).alias("_at_key"),
        *[position(F.lit(c)).alias(f"_at_{c}") for c in columns],
    )
    placed = attach(rows.where("NOT _is_header"), places, ["source_file"], small_fits=files_fit)
    cell = lambda at: cell_text(F.get(F.col("cells"), (F.col(at) - 1).cast("int")))
    complete = reduce(lambda a, b: a & b, [F.col(f"_at_{c}") > 0 for c in columns])
    return placed.select(
        "source_file",
        TICKER,
        TIMEFRAME,
        SEQ,
        "line",
        "cells",
        F.col("_at_key").isNotNull().alias("has_header"),
        F.coalesce(complete, F.lit(False)).alias("has_columns"),
        F.coalesce(F.col(SEQ) < F.col("_header_seq"), F.lit(False)).alias("before_header"),
        cell("_at_key").alias("key_text"),
        *[cell(f"_at_{c}").alias(c) for c in columns],
    )


def rename_first_column(df: DataFrame, timeframe: str) -> DataFrame:
    """SRC-5: the first column of a fetched table becomes its time key."""
    return df.withColumnRenamed(df.columns[0], DAILY_KEY if timeframe == DAILY else INTRADAY_KEY)
