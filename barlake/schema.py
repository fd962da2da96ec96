"""Canonical tables of the lake."""

from __future__ import annotations

from pyspark.sql import types as T

TICKER, TIMEFRAME, TS, SEQ = "ticker", "timeframe", "ts", "seq"
SERIES = [TICKER, TIMEFRAME]
KEY = [TICKER, TIMEFRAME, TS]
PRICES = ["open", "high", "low", "close"]
VALUES = [*PRICES, "volume"]

BARS = T.StructType(
    [
        T.StructField(TICKER, T.StringType(), False),
        T.StructField(TIMEFRAME, T.StringType(), False),
        T.StructField(TS, T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in VALUES],
        T.StructField(SEQ, T.LongType()),
    ]
)
BAR_COLUMNS = BARS.fieldNames()
# Folder of a stored bar inside its bar size.
YEAR = "bar_year"

# Bar sizes, look-back per bar size, freshness limits, check thresholds.
DAILY = "1d"
INTRADAY = ["1m", "5m", "15m", "30m", "90m", "1h"]
LOOKBACK = {"1m": "7d", "5m": "60d", "15m": "60d", "30m": "60d", "90m": "60d", "1h": "730d"}
DEFAULT_LOOKBACK = "60d"
DAILY_LOOKBACK = "max"
DAILY_MAX_AGE_DAYS = 7
INTRADAY_MAX_AGE_SECONDS = 12 * 3600
OUTLIER_Z = 3.0
DAILY_GAP_DAYS = 3
GAP_FACTOR = 10

# Time columns of landing files.
DAILY_KEY, INTRADAY_KEY = "Date", "Datetime"
