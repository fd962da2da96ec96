"""Time arithmetic on zone-free bar times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.schema import DAILY, INTRADAY, TIMEFRAME, TS

NO_TIME_SLOT = 2**63 - 1
UNIT_SECONDS = {"m": 60, "h": 3600, "d": 86400}
BARS_PER_SLOT = 1 << 12
LONGEST_SLOT_SECONDS = 64 * 86400


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-free UTC time."""
    return F.unix_micros(ts.cast("timestamp"))


def as_of_literal(as_of: datetime | str) -> Column:
    """A fixed zone-free time, given as text so that no local zone of the driver slips in."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def age_in_days(as_of: Column, latest: Column) -> Column:
    """SCL-8: whole calendar days."""
    return F.datediff(as_of.cast("date"), latest.cast("date")).cast("bigint")


def age_in_seconds(as_of: Column, latest: Column) -> Column:
    """SCL-9: elapsed seconds, with the fraction."""
    return (micros(as_of) - micros(latest)) / F.lit(1_000_000)


def bar_seconds_sql(timeframe: str = TIMEFRAME) -> str:
    """Nominal length of one bar, read from labels such as 5m, 1h, 1d; NULL if unreadable.

    The usual labels are compared as text; the patterns run only for others.
    """
    usual = " ".join(
        f"WHEN '{label}' THEN {int(label[:-1]) * UNIT_SECONDS[label[-1]]}" for label in [DAILY, *INTRADAY]
    )
    unit = " ".join(f"WHEN '{unit}' THEN {seconds}" for unit, seconds in UNIT_SECONDS.items())
    other = (
        f"nullif(try_cast(regexp_extract({timeframe}, '^([0-9]+)[mhd]$', 1) AS BIGINT) "
        f"* CASE regexp_extract({timeframe}, '^[0-9]+([mhd])$', 1) {unit} END, 0)"
    )
    return f"CAST(CASE {timeframe} {usual} ELSE {other} END AS BIGINT)"


def time_slot(bars_per_slot: int = BARS_PER_SLOT) -> Column:
    """Consecutive time ranges of one series, ``bars_per_slot`` nominal bars wide.

    A slot is never longer than 64 days, and one day where the label names no bar size. Rows
    without a time share one slot that sorts after all others.
    """
    seconds = f"least(coalesce({bar_seconds_sql()} * {bars_per_slot}, 86400), {LONGEST_SLOT_SECONDS})"
    slot = f"floor(unix_micros(CAST({TS} AS TIMESTAMP)) / ({seconds} * 1000000))"
    return F.expr(f"coalesce({slot}, {NO_TIME_SLOT})")


def run_stamp(as_of: Column) -> Column:
    """SCL-16: run label."""
    return F.date_format(as_of.cast("timestamp"), "yyyyMMdd_HHmmss")
