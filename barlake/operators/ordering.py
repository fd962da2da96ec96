"""Ordered work inside a series, cut into blocks so that no series has to fit in one task.

A block is a run of neighbouring rows in the chosen order. Window functions run inside blocks; what
a block needs from the rows before it (the last known close) is one value per block, computed from
the block summaries. Two orders exist:

* ``seq`` - stored order. ``seq`` is unique within a series, so ``seq div rows_per_block`` bounds a
  block by construction, whatever the keys look like.
* ``ts``  - time order, ties by ``seq``. A block is a time slot; a slot holding more than
  ``rows_per_block`` rows (dense or repeated times) is cut further into (time, seq range) blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions import timing
from barlake.operators.lookup import BROADCAST_ROWS, attach
from barlake.schema import KEY, SEQ, SERIES, TICKER, TIMEFRAME, TS

ROWS_PER_BLOCK = 1 << 20


@dataclass(frozen=True)
class Blocked:
    """Rows with block columns, already partitioned by series and block."""

    rows: DataFrame
    coarse: list[str]
    fine: list[str]
    order: list[str]

    @property
    def block(self) -> list[str]:
        return [*SERIES, *self.coarse, *self.fine]


def _seq_range(rows_per_block: int) -> Column:
    return F.expr(f"{SEQ} div {rows_per_block}")


def has_series(bars: DataFrame) -> DataFrame:
    """Keys are never NULL by contract; saying so up front lets all branches of a plan share one exchange."""
    return bars.where(f"{TICKER} IS NOT NULL AND {TIMEFRAME} IS NOT NULL")


def with_slot(bars: DataFrame, bars_per_slot: int | None = None) -> DataFrame:
    return has_series(bars).withColumn("_slot", timing.time_slot(bars_per_slot or timing.BARS_PER_SLOT))


@dataclass(frozen=True)
class CrowdedSlots:
    """Time slots holding more rows than a task should take, and whether their list may be broadcast.

    ``few_series``: there are so few slots that a table with one row per series may be broadcast.
    """

    slots: DataFrame | None
    fits: bool = True
    few_series: bool = False

    def mark(self, rows: DataFrame) -> DataFrame:
        """Rows with a ``_crowded`` flag (TRUE or NULL)."""
        flagged = self.slots.withColumn("_crowded", F.lit(True))
        return attach(rows, flagged, [*SERIES, "_slot"], small_fits=self.fits)

    def __bool__(self) -> bool:
        return self.slots is not None


def find_crowded_slots(
    bars: DataFrame, rows_per_block: int | None = None, bars_per_slot: int | None = None
) -> CrowdedSlots:
    """Count the rows of every slot (one narrow scan, combined before its shuffle).

    There is at most one crowded slot per ``rows_per_block`` rows and usually none, in which case
    callers leave the rows alone. The list is counted before anything is broadcast.
    """
    slot = [*SERIES, "_slot"]
    counted = with_slot(bars.select(*KEY), bars_per_slot).groupBy(*slot).agg(F.expr("count(*) AS _n"))
    totals = counted.agg(F.expr("count(*) AS slots"), F.expr("coalesce(max(_n), 0) AS largest")).first()
    few_series = totals["slots"] <= BROADCAST_ROWS
    if totals["largest"] <= (rows_per_block or ROWS_PER_BLOCK):
        return CrowdedSlots(None, few_series=few_series)
    crowded = counted.where(F.col("_n") > (rows_per_block or ROWS_PER_BLOCK)).select(*slot)
    found = crowded.limit(BROADCAST_ROWS + 1).collect()
    if len(found) > BROADCAST_ROWS:
        return CrowdedSlots(crowded, fits=False, few_series=few_series)
    return CrowdedSlots(bars.sparkSession.createDataFrame(found, crowded.schema), few_series=few_series)


def in_blocks(
    bars: DataFrame,
    value: str,
    order: str = "seq",
    rows_per_block: int | None = None,
    bars_per_slot: int | None = None,
    crowded: CrowdedSlots | None = None,
) -> Blocked:
    """Cut ``bars`` (keys, time, seq and ``value`` only) into order blocks with one shuffle."""
    rows_per_block = rows_per_block or ROWS_PER_BLOCK
    fine: list[str] = []
    if order == "seq":
        rows = has_series(bars).select(*SERIES, SEQ, value, _seq_range(rows_per_block).alias("_slot"))
        order_columns = [SEQ]
    elif order == "ts":
        rows = with_slot(bars.select(*KEY, SEQ, value), bars_per_slot)
        if crowded is None:
            crowded = find_crowded_slots(bars, rows_per_block, bars_per_slot)
        if crowded:
            fine = ["_time", "_range"]
            rows = crowded.mark(rows).withColumns(
                {
                    "_time": F.expr(f"CASE WHEN _crowded THEN {TS} END"),
                    "_range": F.when(F.col("_crowded"), _seq_range(rows_per_block)),
                }
            ).drop("_crowded")
        order_columns = [TS, SEQ]
    else:
        raise ValueError(f"unknown order {order!r}")
    # One explicit exchange that every consumer below reuses.
    block = [*SERIES, "_slot", *fine]
    return Blocked(rows.repartition(*[F.col(c) for c in block]), ["_slot"], fine, order_columns)


def last_before_block(blocked: Blocked, value: str) -> DataFrame:
    """Per block: the last non-missing ``value`` of all earlier blocks of the series (``_carry``)."""
    rows, position = blocked.rows, SEQ
    if blocked.order != [SEQ]:
        # One number per row in place of (time, seq) keeps the aggregate below on fixed-width buffers.
        number = f"row_number() OVER (PARTITION BY {', '.join(blocked.block)} ORDER BY {', '.join(blocked.order)})"
        rows, position = rows.selectExpr(*blocked.block, value, f"{number} AS _position"), "_position"
    summary = rows.groupBy(*blocked.block).agg(
        F.expr(f"max_by({value}, CASE WHEN {value} IS NOT NULL THEN {position} END) AS _last")
    )
    across = _last_of_earlier("_last", SERIES, blocked.coarse)
    if not blocked.fine:
        return summary.selectExpr(*blocked.block, f"{across} AS _carry")

    # Two levels: inside a slot over its fine blocks, then across the slots of the series.
    slot = [*SERIES, *blocked.coarse]
    near = summary.selectExpr(*blocked.block, f"{_last_of_earlier('_last', slot, blocked.fine)} AS _near")
    fine_position = f"struct({', '.join(blocked.fine)})"
    slots = summary.groupBy(*slot).agg(
        F.expr(f"max_by(_last, CASE WHEN _last IS NOT NULL THEN {fine_position} END) AS _last")
    )
    far = slots.selectExpr(*slot, f"{across} AS _far")
    return near.join(far, slot, "left").selectExpr(*blocked.block, "coalesce(_near, _far) AS _carry")


def _last_of_earlier(value: str, within: list[str], order: list[str]) -> str:
    """Last non-missing ``value`` of the rows strictly before the current one."""
    return (
        f"last({value}, true) OVER (PARTITION BY {', '.join(within)} ORDER BY {', '.join(order)} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
