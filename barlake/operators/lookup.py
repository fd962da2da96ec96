"""Joining a small per-group table to many rows without trusting its size or the group balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.schema import SERIES

# Rows a side may have to be broadcast. A per-series row is well under 200 bytes, so this stays below 20 MB.
BROADCAST_ROWS = 100_000
SALTS = 32


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """True if ``df`` has at most ``limit`` rows. Counted whole: each task sends one number."""
    limit = BROADCAST_ROWS if limit is None else limit
    return df.count() <= limit


def series_fit(bars: DataFrame, limit: int | None = None) -> bool:
    """True if a table with one row per series of ``bars`` may be broadcast.

    Reads the two key columns only; where ``timeframe`` is a partition column, just the tickers.
    """
    return fits_broadcast(bars.select(*SERIES).distinct(), limit)


def attach(
    rows: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    small_fits: bool | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join ``small`` (unique on ``on``) to ``rows``; ``rows`` may be skewed on ``on``.

    A side that was counted and fits is broadcast, so ``rows`` does not move. Beyond that every row
    of ``small`` is repeated once per salt and ``rows`` is spread over the salts, so the hottest
    group is split ``salts`` ways. ``how`` is any type that keeps or filters the left side
    (inner, left, left_semi, left_anti).
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"attach keeps the left side; unsupported join type {how!r}")
    if small_fits is None:
        small_fits = fits_broadcast(small.select(*on))
    if small_fits:
        return rows.join(F.broadcast(small), on, how)
    salts = salts or SALTS
    everything = F.xxhash64(*[F.col(c) for c in rows.columns])
    salted_rows = rows.withColumn("_salt", F.pmod(everything, F.lit(salts)).cast("int"))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(salted_small, [*on, "_salt"], how).drop("_salt")
