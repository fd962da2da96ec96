"""WIN-1, WIN-3, AGG-7, DQ-6: simple returns, their z-scores, and outlier counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.lookup import attach, series_fit
from barlake.operators.ordering import Blocked, CrowdedSlots, in_blocks, last_before_block
from barlake.schema import OUTLIER_Z, SERIES, SEQ


def _with_carry(rows: DataFrame, carry: DataFrame, blocked: Blocked) -> DataFrame:
    """Join the carried value by block; the fine block columns may be NULL."""
    renamed = carry.selectExpr(*[f"{c} AS _r_{c}" for c in blocked.block], "_carry")
    same = [f"{c} <=> _r_{c}" if c in blocked.fine else f"{c} = _r_{c}" for c in blocked.block]
    return rows.join(renamed, F.expr(" AND ".join(same)), "left")


def simple_returns(
    bars: DataFrame,
    value: str = "close",
    order: str = "ts",
    fill: bool = True,
    rows_per_block: int | None = None,
    bars_per_slot: int | None = None,
    crowded: CrowdedSlots | None = None,
) -> DataFrame:
    """WIN-1: (series, seq, ret), one row per bar that has a return.

    ``order`` is the time, or ``seq`` within one delivery: a stored master holds several deliveries,
    each with its own ``seq``. With ``fill`` a missing close repeats the last known one (its return is 0); without it such
    rows, and the row after each, have no return. A zero previous close gives no return.
    """
    blocked = in_blocks(bars, value, order, rows_per_block, bars_per_slot, crowded)
    if not fill:
        # A missing close must stop the previous value from being seen, so it travels as NaN.
        marked = blocked.rows.withColumn(value, F.expr(f"coalesce({value}, double('NaN'))"))
        blocked = Blocked(marked, blocked.coarse, blocked.fine, blocked.order)
    window = f"PARTITION BY {', '.join(blocked.block)} ORDER BY {', '.join(blocked.order)} ROWS BETWEEN UNBOUNDED PRECEDING"
    inside = blocked.rows.selectExpr(
        *blocked.block,
        SEQ,
        value,
        f"last({value}, true) OVER ({window} AND 1 PRECEDING) AS _near",
    )
    filled = _with_carry(inside, last_before_block(blocked, value), blocked).selectExpr(
        *SERIES, SEQ, f"coalesce({value}, _near, _carry) AS _now", "coalesce(_near, _carry) AS _before"
    )
    ret = "nullif(try_divide(_now - _before, _before), double('NaN')) AS ret"
    return filled.selectExpr(*SERIES, SEQ, ret).where("ret IS NOT NULL")


def return_stats(returns: DataFrame) -> DataFrame:
    """AGG-7: number, mean and sample standard deviation of the returns of each series."""
    return returns.groupBy(*SERIES).agg(
        F.expr("count(ret) AS n_returns"), F.expr("avg(ret) AS mean_ret"), F.expr("stddev_samp(ret) AS std_ret")
    )


def _scored(returns: DataFrame, series_small: bool) -> DataFrame:
    scored = attach(returns, return_stats(returns), SERIES, small_fits=series_small)
    return scored.withColumn("z", F.expr("abs(try_divide(ret - mean_ret, std_ret))"))


def z_scores(returns: DataFrame, series_small: bool) -> DataFrame:
    """WIN-3, JOIN-4: absolute z-score of every return within its series."""
    return _scored(returns, series_small).select(*SERIES, SEQ, "ret", "z")


def count_outliers(returns: DataFrame, series_small: bool, limit: float = OUTLIER_Z) -> DataFrame:
    """DQ-6: (series, n_outliers) of returns, whatever they were taken from."""
    return _scored(returns, series_small).groupBy(*SERIES).agg(F.expr(f"count_if(z > {limit}D) AS n_outliers"))


def outlier_counts(
    bars: DataFrame,
    order: str = "ts",
    fill: bool = True,
    limit: float = OUTLIER_Z,
    series_small: bool | None = None,
    crowded: CrowdedSlots | None = None,
) -> DataFrame:
    """DQ-6: (series, n_outliers) for every series with at least one return."""
    if series_small is None:
        series_small = series_fit(bars)
    return count_outliers(simple_returns(bars, order=order, fill=fill, crowded=crowded), series_small, limit)
