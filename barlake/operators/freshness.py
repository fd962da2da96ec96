"""FRS-1, FRS-2, FRS-3, JOIN-3, AGG-9: which series are out of date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.timing import age_in_days, age_in_seconds, as_of_literal
from barlake.operators.counters import series_summary
from barlake.operators.filters import daily, in_timeframes
from barlake.operators.lookup import attach
from barlake.schema import (
    DAILY,
    DAILY_MAX_AGE_DAYS,
    INTRADAY,
    INTRADAY_MAX_AGE_SECONDS,
    SERIES,
    TICKER,
    TIMEFRAME,
)

MISSING, EMPTY, NO_TIME, OLD, FRESH, UNREADABLE = "missing", "empty", "no_time", "old", "fresh", "unreadable"


def _states(latest: DataFrame, as_of: Column, too_old: Column, unreadable: DataFrame | None) -> DataFrame:
    """One state per series from (ticker, timeframe, present, records, latest)."""
    if unreadable is not None:
        broken = unreadable.select(*SERIES).distinct().withColumn("_broken", F.lit(True))
        latest = latest.join(broken, SERIES, "left")
    else:
        latest = latest.withColumn("_broken", F.lit(None).cast("boolean"))
    state = (
        F.when(F.col("_broken"), UNREADABLE)
        .when(~F.col("present"), MISSING)
        .when(F.col("records") == 0, EMPTY)
        .when(F.col("latest").isNull(), NO_TIME)
        .when(too_old, OLD)
        .otherwise(FRESH)
    )
    return latest.select(
        *SERIES,
        "latest",
        F.floor(age_in_seconds(as_of, F.col("latest"))).alias("age_seconds"),
        state.alias("state"),
        (state != FRESH).alias("stale"),
    )


def _latest(bars: DataFrame) -> DataFrame:
    """Latest times from bars, or from a table that holds them already (a series state)."""
    summary = bars if "latest_ts" in bars.columns else series_summary(bars)
    return summary.select(*SERIES, F.lit(True).alias("present"), "records", F.col("latest_ts").alias("latest"))


def _against(expected: DataFrame, latest: DataFrame) -> DataFrame:
    """JOIN-3: every expected series with its latest time, absent ones flagged. Both sides have one row per series."""
    joined = expected.select(*SERIES).distinct().join(latest, SERIES, "left")
    return joined.withColumn("present", F.coalesce("present", F.lit(False)))


def daily_freshness(
    bars: DataFrame,
    tickers: DataFrame,
    as_of: str,
    max_age_days: int = DAILY_MAX_AGE_DAYS,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """FRS-1: every configured ticker; stale if missing, empty, without a time, unreadable or older than a week.

    ``bars`` may be a series state (ticker, timeframe, records, latest_ts) instead, which is then all that is read.
    """
    now = as_of_literal(as_of)
    expected = tickers.select(TICKER, F.lit(DAILY).alias(TIMEFRAME))
    known = _against(expected, _latest(daily(bars)))
    return _states(known, now, age_in_days(now, F.col("latest")) > max_age_days, unreadable)


def intraday_freshness(
    bars: DataFrame,
    as_of: str,
    timeframes: list[str] | None = None,
    max_age_seconds: int = INTRADAY_MAX_AGE_SECONDS,
    tickers: DataFrame | None = None,
    expect_all: bool = False,
    existing: DataFrame | None = None,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """FRS-2: every existing intraday series, stale if older than twelve hours.

    An absent series is not stale, so a lake without intraday bars counts as fresh; with
    ``expect_all`` every ticker at every bar size is expected instead. ``existing`` lists series
    known to be stored even when they hold no row. ``bars`` may be a series state, as for daily ones.
    """
    now = as_of_literal(as_of)
    timeframes = timeframes or INTRADAY
    latest = _latest(in_timeframes(bars, timeframes))
    if expect_all:
        if tickers is None:
            raise ValueError("expect_all needs the tickers")
        sizes = F.explode(F.array(*[F.lit(t) for t in timeframes]))
        known = _against(tickers.select(TICKER, sizes.alias(TIMEFRAME)), latest)
    elif existing is not None:
        stored = in_timeframes(existing.select(*SERIES).distinct(), timeframes)
        known = (
            stored.join(latest, SERIES, "full")
            .withColumn("present", F.lit(True))
            .withColumn("records", F.coalesce("records", F.lit(0)))
        )
    else:
        known = latest
    return _states(known, now, age_in_seconds(now, F.col("latest")) > max_age_seconds, unreadable)


def needs_refresh(freshness: DataFrame) -> DataFrame:
    """FRS-3: one row; any stale series asks for a refresh of all of them."""
    return freshness.agg(F.coalesce(F.bool_or("stale"), F.lit(False)).alias("needs_refresh"))


def stale_part_of(plan: DataFrame, freshness: DataFrame) -> DataFrame:
    """Selective variant of FRS-3: the rows of a fetch plan whose series is stale."""
    return attach(plan, freshness.where("stale").select(*SERIES), SERIES, "left_semi")
