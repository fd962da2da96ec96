"""Row filters and projections that need no shuffle."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.parsing import drop_zone, to_utc_instant
from barlake.operators.lookup import attach
from barlake.schema import DAILY, KEY, PRICES, SERIES, TICKER, TIMEFRAME, TS, VALUES


def holds_ticker(cells: Column, ticker: Column, mode: str = "literal") -> Column:
    """FLT-1, SCL-11: true if any cell contains the ticker (missing cells never do).

    ``mode='regex'`` reads the ticker as an unescaped pattern, as the original rule did.
    """
    if mode not in {"literal", "regex"}:
        raise ValueError(f"unknown banner mode {mode!r}")
    test = (lambda c: c.contains(ticker)) if mode == "literal" else (lambda c: F.regexp_like(c, ticker))
    return F.coalesce(F.exists(cells, lambda c: F.coalesce(test(c), F.lit(False))), F.lit(False))


def line_holds_ticker(line: Column, cells: Column, ticker: Column, mode: str = "literal") -> Column:
    """FLT-1 on a CSV line: a literal ticker without separators is in a cell exactly if it is in the line."""
    in_cells = holds_ticker(cells, ticker, mode)
    if mode != "literal":
        return in_cells
    separated = ticker.contains(",") | ticker.contains('"')
    return F.when(separated, in_cells).otherwise(line.contains(ticker))


def without_banners(rows: DataFrame, columns: list[str], mode: str = "literal") -> DataFrame:
    """FLT-1: drop rows in which any of the text ``columns`` holds the row's ticker."""
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    return rows.where(~holds_ticker(cells, F.col(TICKER), mode))


def rows_with_missing(bars: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """FLT-3: rows holding any missing value."""
    return bars.where(reduce(or_, [F.col(c).isNull() for c in columns or VALUES]))


def daily(bars: DataFrame) -> DataFrame:
    """FLT-6, SRC-10: daily series; on a lake partitioned by timeframe this prunes partitions."""
    return bars.where(F.col(TIMEFRAME) == DAILY)


def intraday(bars: DataFrame) -> DataFrame:
    """FLT-6: everything that is not daily."""
    return bars.where(F.col(TIMEFRAME) != DAILY)


def in_timeframes(bars: DataFrame, timeframes: list[str]) -> DataFrame:
    """SRC-10: whitelist of bar sizes."""
    return bars.where(F.col(TIMEFRAME).isin(*timeframes))


def newer_than(
    bars: DataFrame,
    target: DataFrame,
    scope: str = "global",
    small_fits: bool | None = None,
) -> DataFrame:
    """FLT-5, SRC-12, AGG-2: rows strictly newer than the latest time of the target.

    ``global`` compares with one latest time over the whole target: a scalar subquery whose value
    reaches the file scan as a pushed filter. ``series`` compares per (ticker, timeframe). Where the
    target has no time yet, every row passes.
    """
    if scope == "global":
        latest = target.agg(F.max(TS).alias("latest")).scalar()
        return bars.where((F.col(TS) > latest) | latest.isNull())
    if scope == "series":
        latest = target.groupBy(*SERIES).agg(F.max(TS).alias("_latest"))
        marked = attach(bars, latest, SERIES, small_fits=small_fits)
        return marked.where("_latest IS NULL OR ts > _latest").drop("_latest")
    raise ValueError(f"unknown watermark scope {scope!r}")


def time_column(columns: list[str]) -> str:
    """PRJ-2: ``Date`` if present, else ``Datetime``; an error if neither is."""
    for name in ("Date", "Datetime"):
        if name in columns:
            return name
    raise ValueError("missing Date or Datetime column")


def has_columns(columns: list[str], *wanted: str) -> bool:
    """PRJ-6: presence test on the static schema."""
    return set(wanted) <= set(columns)


def split_publish_form(bars: DataFrame) -> DataFrame:
    """PRJ-3, PRJ-5: capitalised columns of the split tables; volume is a whole number there."""
    return bars.select(
        to_utc_instant(F.col(TS)).alias("Date"),
        F.col(TICKER).alias("Ticker"),
        F.col(TIMEFRAME).alias("Timeframe"),
        *[F.col(c).alias(c.capitalize()) for c in PRICES],
        F.col("volume").try_cast("bigint").alias("Volume"),
    )


def combined_publish_form(bars: DataFrame) -> DataFrame:
    """PRJ-4, PRJ-5: lower-case columns of the combined table, time as an instant."""
    return bars.select(
        TICKER, TIMEFRAME, to_utc_instant(F.col(TS)).alias("timestamp"), *[F.col(c) for c in VALUES]
    )


def keys_of_published(table: DataFrame) -> DataFrame:
    """SCL-5, PRJ-2, PRJ-6: published rows of either form as bar keys with zone-free times."""
    if has_columns(table.columns, "timestamp"):
        return table.select(TICKER, TIMEFRAME, drop_zone(F.col("timestamp")).alias(TS))
    time = F.col(time_column(table.columns))
    return table.select(F.col("Ticker").alias(TICKER), F.col("Timeframe").alias(TIMEFRAME), drop_zone(time).alias(TS)).select(*KEY)
