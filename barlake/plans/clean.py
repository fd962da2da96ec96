"""PIP-1: landing lines to typed bars, with every line accounted for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.parsing import to_bar_date, to_number, to_utc_wall_time
from barlake.operators.filters import line_holds_ticker, rows_with_missing
from barlake.operators.lookup import attach
from barlake.schema import BAR_COLUMNS, DAILY, TICKER, TIMEFRAME, TS, VALUES
from barlake.sources.landing import cells_by_column

# Outcome of a line: stored as a bar, dropped by rule, or rejected as unusable.
BAR, DROPPED, REJECTED = "bar", "dropped", "rejected"
FETCH_ERROR = "fetch_error"


def clean_landing(
    lines: DataFrame,
    banner_mode: str = "literal",
    strict: bool = False,
    files_fit: bool | None = None,
) -> DataFrame:
    """PIP-1: SRC-6, PRJ-1, FLT-1, SCL-1/2, FLT-2, SCL-7 in one pass over the landing text.

    Every non-header line yields one row with its ``outcome`` and ``reason``. An unparsable time
    rejects its line; with ``strict`` it rejects its whole file.
    """
    cells = cells_by_column(lines, files_fit=files_fit)
    when_daily = to_bar_date(F.col("key_text")).cast("timestamp_ntz")
    ts = F.when(F.col(TIMEFRAME) == DAILY, when_daily).otherwise(to_utc_wall_time(F.col("key_text")))
    typed = cells.select(
        "source_file",
        "line",
        TICKER,
        TIMEFRAME,
        ts.alias(TS),
        *[to_number(F.col(c.capitalize())).alias(c) for c in VALUES],
        "seq",
        "has_columns",
        F.when(~F.col("has_header"), "no_header")
        .when(~F.col("has_columns"), "missing_column")
        .when(F.col("before_header"), "before_header")
        .when(line_holds_ticker(F.col("line"), F.col("cells"), F.col(TICKER), banner_mode), "banner")
        .when(F.col("key_text").isNull(), "no_key")
        .when(ts.isNull(), "bad_time")
        .alias("reason"),
    )
    if strict:
        failed = typed.where("reason = 'bad_time'").select("source_file").distinct()
        typed = attach(
            typed, failed.withColumn("_failed", F.lit(True)), ["source_file"], small_fits=files_fit
        ).withColumn("reason", F.coalesce("reason", F.when(F.col("_failed"), "file_failed")))
    outcome = (
        F.when(F.col("reason").isNull(), BAR)
        .when(F.col("reason").isin("banner", "no_key"), DROPPED)
        .otherwise(REJECTED)
    )
    return typed.select(*BAR_COLUMNS, "source_file", "line", "has_columns", "reason", outcome.alias("outcome"))


def bars_of(cleaned: DataFrame) -> DataFrame:
    """The usable bars."""
    return cleaned.where(F.col("outcome") == BAR).select(*BAR_COLUMNS)


def rejects_of(cleaned: DataFrame) -> DataFrame:
    """Lines that could not be used, with the reason."""
    return cleaned.where(F.col("outcome") == REJECTED).select("source_file", "reason", "line")


def cleaned_fetch(answers: DataFrame) -> DataFrame:
    """The answers of a fetch in the form of cleaned lines: bars, and one reject per failed plan row."""
    reason = (
        F.when(F.col("error").isNotNull(), FETCH_ERROR).when(F.col(TS).isNull(), "bad_time").alias("reason")
    )
    outcome = F.when(F.col("reason").isNull(), BAR).otherwise(REJECTED)
    name = F.concat(F.col(TICKER), F.lit("_"), F.col(TIMEFRAME), F.lit(".csv")).alias("source_file")
    rows = answers.select(*BAR_COLUMNS, name, F.col("error").alias("line"), F.lit(True).alias("has_columns"), reason)
    return rows.withColumn("outcome", outcome)


def missing_of(cleaned: DataFrame) -> DataFrame:
    """FLT-3: bars holding a missing value, with their file."""
    return rows_with_missing(cleaned.where(F.col("outcome") == BAR)).select("source_file", *BAR_COLUMNS)


def file_reasons(cleaned: DataFrame) -> DataFrame:
    """(source_file, reason): every file, with why it cannot be used as a whole, or NULL."""
    reason = F.when(F.col("reason").isin("no_header", "file_failed", "missing_column", FETCH_ERROR), F.col("reason"))
    return cleaned.select("source_file", reason.alias("reason")).groupBy("source_file").agg(F.min("reason").alias("reason"))


def file_errors(cleaned: DataFrame) -> DataFrame:
    """DQ-9 input: one row per file that lacks a header or a value column, or failed as a whole."""
    return file_reasons(cleaned).where("reason IS NOT NULL")
