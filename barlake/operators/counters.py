"""AGG-3, AGG-4, AGG-6, DQ-2, DQ-4, DQ-5: counters that need one row at a time.

One aggregate without any window: map tasks send one partial row per series, bars never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schema import SERIES, TS, VALUES

HIGH_BELOW_LOW = "high < low"
CLOSE_OUTSIDE = "close > high OR close < low"
OPEN_OUTSIDE = "open > high OR open < low"
NO_VOLUME = "volume <= 0"


def row_counter_columns() -> list[Column]:
    """The counters as aggregates: records, missing values, crossed prices, no volume."""
    counts = {
        "records": "TRUE",
        **{f"n_missing_{c}": f"{c} IS NULL" for c in VALUES},
        "n_high_low": HIGH_BELOW_LOW,
        "n_close_out": CLOSE_OUTSIDE,
        "n_open_out": OPEN_OUTSIDE,
        "n_no_volume": NO_VOLUME,
    }
    return [F.expr(f"count_if({test}) AS {name}") for name, test in counts.items()]


def row_counters(bars: DataFrame) -> DataFrame:
    """(series, records, n_missing_*, n_high_low, n_close_out, n_open_out, n_no_volume)."""
    return bars.groupBy(*SERIES).agg(*row_counter_columns())


def series_summary(bars: DataFrame) -> DataFrame:
    """AGG-1, AGG-3: rows and time range of each series."""
    return bars.groupBy(*SERIES).agg(
        F.count("*").alias("records"), F.min(TS).alias("first_ts"), F.max(TS).alias("latest_ts")
    )
