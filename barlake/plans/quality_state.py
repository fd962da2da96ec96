"""PIP-5, DQ-2..DQ-8 incrementally: partial results of each time slot, put together into the counters.

A block is a time slot of a series; a slot crowded by repeated times is cut further by time and ``seq``, so
a block is bounded whatever a series holds. The state of a block has all that its rows give by themselves
(row counters, steps and returns between its own rows) and what its neighbours need from it: the first
and last time, the first and last known close, and the rows before its first known close. Between
blocks there is one step and one return each, computed from these when the counters are asked for.

After a delivery only the slots it touches are read again: their blocks are replaced, all others stay.
Rows are taken in time order, ties by ``seq``, and a missing close repeats the last known one, as in the
quality run over all bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.counters import row_counter_columns
from barlake.operators.lookup import attach, fits_broadcast
from barlake.operators.ordering import find_crowded_slots, with_slot
from barlake.operators.returns import count_outliers
from barlake.operators.steps import counts_from
from barlake.schema import BARS, KEY, SEQ, SERIES, TS, VALUES
from barlake.sinks.batches import BATCH, batch_ids, read_batches
from barlake.sources.lake import empty_bars, path_exists

SLOT = [*SERIES, "_slot"]
BLOCK = [*SLOT, "_time", "_range"]
ROWS_PER_BLOCK = 1 << 16
VERSION = "version"
MOST_DELTAS = 1000

_RET = "nullif(try_divide({now} - {before}, {before}), double('NaN'))"
_STEP = "unix_micros(CAST({} AS TIMESTAMP)) - unix_micros(CAST({} AS TIMESTAMP))"


def block_state(bars: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, bars_per_slot: int | None = None) -> DataFrame:
    """One row per block of ``bars``, which holds every row of the slots it touches. One shuffle."""
    crowded = find_crowded_slots(bars, rows_per_block, bars_per_slot)
    rows = with_slot(bars.select(*KEY, *VALUES, SEQ), bars_per_slot)
    rows = crowded.mark(rows) if crowded else rows.withColumn("_crowded", F.lit(None).cast("boolean"))
    cut = rows.withColumns(
        {
            "_time": F.expr(f"CASE WHEN _crowded THEN {TS} END"),
            "_range": F.expr(f"CASE WHEN _crowded THEN {SEQ} div {rows_per_block} END"),
        }
    ).repartition(*[F.col(c) for c in BLOCK])
    ordered = f"PARTITION BY {', '.join(BLOCK)} ORDER BY {TS}, {SEQ}"
    earlier = f"{ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    seen = cut.selectExpr(
        "*",
        f"row_number() OVER ({ordered}) AS _place",
        f"lag({TS}) OVER ({ordered}) AS _ts_before",
        f"last(close, true) OVER ({earlier}) AS _before",
    )
    changes = seen.selectExpr(
        "*",
        f"{_STEP.format(TS, '_ts_before')} AS _step",
        f"{_RET.format(now='(coalesce(close, _before))', before='_before')} AS _ret",
        "CASE WHEN close IS NOT NULL THEN _place END AS _known",
    )
    return changes.groupBy(*BLOCK).agg(
        *row_counter_columns(),
        F.expr(f"count_if({TS} IS NULL) AS untimed"),
        F.expr(f"min({TS}) AS first_ts"),
        F.expr(f"max({TS}) AS last_ts"),
        F.expr("min_by(close, _known) AS first_close"),
        F.expr("max_by(close, _known) AS last_close"),
        F.expr("count_if(close IS NULL AND _before IS NULL) AS leading"),
        F.expr("collect_list(_step) AS steps"),
        F.expr("collect_list(_ret) AS returns"),
    )


def touched_slots(delivery: DataFrame, bars_per_slot: int | None = None) -> DataFrame:
    return with_slot(delivery.select(*KEY), bars_per_slot).select(*SLOT).distinct()


def only_slots(bars: DataFrame, slots: DataFrame, bars_per_slot: int | None = None) -> DataFrame:
    """The bars of the given slots."""
    return attach(with_slot(bars, bars_per_slot), slots, SLOT, "left_semi").drop("_slot")


def updated_state(
    state: DataFrame,
    delivery: DataFrame,
    bars: DataFrame,
    rows_per_block: int = ROWS_PER_BLOCK,
    bars_per_slot: int | None = None,
) -> DataFrame:
    """The state after a delivery; ``bars`` are all stored bars, the delivery included."""
    slots = touched_slots(delivery, bars_per_slot)
    again = block_state(only_slots(bars, slots, bars_per_slot), rows_per_block, bars_per_slot)
    return attach(state, slots, SLOT, "left_anti").unionByName(again)


def _edges(state: DataFrame) -> DataFrame:
    """Blocks with the last time and the last known close before them: one narrow row per block of a series."""
    across = f"PARTITION BY {', '.join(SERIES)} ORDER BY _slot, _time, _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return state.select(*BLOCK, "first_ts", "last_ts", "first_close", "last_close", "leading").selectExpr(
        "*", f"last(last_ts, true) OVER ({across}) AS _ts_before", f"last(last_close, true) OVER ({across}) AS _before"
    )


def steps_of(state: DataFrame) -> DataFrame:
    """(series, step_us, n): how often each step occurs; rows without a time that repeat another under NULL."""
    inside = state.selectExpr(*SERIES, "explode(steps) AS step_us", "1L AS n")
    between = _edges(state).selectExpr(*SERIES, f"{_STEP.format('first_ts', '_ts_before')} AS step_us", "1L AS n")
    untimed = state.groupBy(*SERIES).agg(F.expr("sum(untimed) - 1 AS n")).selectExpr(*SERIES, "CAST(NULL AS BIGINT) AS step_us", "n")
    steps = inside.unionByName(between.where("step_us IS NOT NULL")).unionByName(untimed.where("n > 0"))
    return steps.groupBy(*SERIES, "step_us").agg(F.expr("sum(n) AS n"))


def returns_of(state: DataFrame) -> DataFrame:
    """(series, ret): a block's rows before its first known close repeat the close before the block."""
    inside = state.selectExpr(*SERIES, "explode(returns) AS ret")
    repeated = f"array_repeat({_RET.format(now='_before', before='_before')}, CAST(leading AS INT))"
    first = f"array({_RET.format(now='first_close', before='_before')})"
    between = _edges(state).where("_before IS NOT NULL").selectExpr(*SERIES, f"explode(concat({repeated}, {first})) AS ret")
    return inside.unionByName(between.where("ret IS NOT NULL"))


def counters_of(state: DataFrame, series_small: bool | None = None) -> DataFrame:
    """One row of counters per series, as ``quality_counters`` gives them from the bars in time order.

    Lists of steps and returns stay in their blocks; only their counts and the blocks' edges move.
    """
    if series_small is None:
        series_small = fits_broadcast(state.select(*SERIES).distinct())
    summed = [name for name in state.columns if name == "records" or name.startswith("n_")]
    totals = state.groupBy(*SERIES).agg(*[F.expr(f"sum({c}) AS {c}") for c in summed])
    counters = totals.join(counts_from(steps_of(state), series_small), SERIES, "left").join(
        count_outliers(returns_of(state), series_small), SERIES, "left"
    )
    zero = [f"coalesce({c}, 0L) AS {c}" for c in [*summed, "n_duplicates", "n_outliers", "n_gaps"]]
    return counters.selectExpr(*SERIES, *zero, "median_step_us")


# --- the stored state ---------------------------------------------------------------------------


def _stored_schema(spark: SparkSession) -> T.StructType:
    blocks = block_state(empty_bars(spark)).schema.fields
    return T.StructType([T.StructField(f.name, f.dataType) for f in blocks] + [T.StructField(VERSION, T.LongType())])


def read_quality_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest blocks of every slot; None where no state is kept."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(_stored_schema(spark)).parquet(path)
    latest = rows.groupBy(*SLOT).agg(F.max(VERSION).alias("_latest"))
    return attach(rows, latest, SLOT, "inner").where(f"{VERSION} = _latest").drop("_latest", VERSION)


def append_blocks(blocks: DataFrame, path: str) -> None:
    """Add blocks under the next version: readers take the latest version of each slot, so nothing is rewritten
    and a delivery that is taken in twice leaves the same state."""
    spark = blocks.sparkSession
    last = None
    if path_exists(spark, path):
        last = spark.read.schema(_stored_schema(spark)).parquet(path).agg(F.max(VERSION)).first()[0]
    blocks.withColumn(VERSION, F.lit(0 if last is None else last + 1).cast("long")).write.mode("append").partitionBy(VERSION).parquet(path)


def refresh_quality_state(delivery: DataFrame | None, bars: DataFrame, path: str) -> DataFrame:
    """Take a delivery into the stored state: only the slots it touches are read from ``bars`` (all stored bars).

    The first time, and without a delivery, everything is read. Returns the state.
    """
    spark = bars.sparkSession
    known = delivery is not None and path_exists(spark, path)
    part = only_slots(bars, touched_slots(delivery)) if known else bars
    append_blocks(block_state(part), path)
    return read_quality_state(spark, path)


def take_in_deltas(bars: DataFrame, delta_path: str, path: str) -> DataFrame:
    """Bring the stored state up to date with a store of deltas; ``bars`` are all stored bars.

    Deltas that were taken in are listed beside the state, after it: a failure in between takes them in
    twice, which changes nothing. With more than MOST_DELTAS new ones everything is read instead.
    """
    spark = bars.sparkSession
    blocks, listed = f"{path}/blocks", f"{path}/taken"
    stored = batch_ids(spark, delta_path)
    new = stored.join(spark.read.schema(f"{BATCH} string").parquet(listed), BATCH, "left_anti") if path_exists(spark, listed) else stored
    few = [r[0] for r in new.limit(MOST_DELTAS + 1).collect()]
    if few or not path_exists(spark, blocks):
        whole = len(few) > MOST_DELTAS or not path_exists(spark, blocks)
        delivery = None if whole else read_batches(spark, delta_path, BARS, few)
        new = stored if whole else spark.createDataFrame([(b,) for b in few], f"{BATCH} string")
        refresh_quality_state(delivery, bars, blocks)
        new.write.mode("append").parquet(listed)
    return read_quality_state(spark, blocks)
