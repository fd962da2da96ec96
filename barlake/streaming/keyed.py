"""STR-1, WIN-4, JOIN-1: keep-first as a stateful stream, with the seen times as keyed state.

The state of a (series, time slot) is the sorted times it has stored, as one value. A micro-batch is
decided by its own rows and that state, so the master is not read, and a hot series is spread over its slots.
The state is kept without an end: a bar may come as late as it likes. After a restart it goes on
from the checkpoint; where a master exists when a stream starts for the first time, its keys are taken in first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barlake.operators.keyed import with_time
from barlake.operators.lookup import BROADCAST_ROWS
from barlake.operators.ordering import with_slot
from barlake.plans.clean import BAR, clean_landing
from barlake.plans.merge import delta_of
from barlake.plans.workflow import Lake
from barlake.schema import BAR_COLUMNS, BARS, DAILY, INTRADAY, KEY, SEQ, SERIES, TS
from barlake.sinks.batches import BATCH, read_batches
from barlake.sinks.series_state import add_to_state
from barlake.sinks.store import RAW, append_bars, read_delta, write_delta, write_raw
from barlake.sources.lake import path_exists, read_bars, read_bars_or_empty
from barlake.sources.landing import as_landing_lines

SLOT = [*SERIES, "_slot"]
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class KeepFirst(StatefulProcessor):
    """Rows of one (series, slot) whose time was not stored before, the lowest ``seq`` of each time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "times binary")

    def _times(self) -> np.ndarray:
        held = self.seen.get()
        return np.frombuffer(held[0], np.int64) if held else np.empty(0, np.int64)

    def _keep(self, times: np.ndarray) -> None:
        self.seen.update((np.union1d(self._times(), times).tobytes(),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, best = self._times(), None
        for part in rows:
            part = part[~np.isin(_micros(part[TS]), known)]
            both = part if best is None else pd.concat([best, part])
            best = both.sort_values(SEQ, kind="stable").drop_duplicates(TS)
        if best is not None and len(best):
            self._keep(_micros(best[TS]))
            yield best.sort_values(TS)[BAR_COLUMNS]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._keep(_micros(initialState[TS]))

    def close(self) -> None:
        pass


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype(np.int64)


def first_bars(bars: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The bars of a stream whose key is new, given the keys ``stored`` before its first start."""
    spark = bars.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    initial = None if stored is None else with_slot(with_time(stored).select(*KEY)).groupBy(*SLOT)
    # NULL values stay NULL on the way through pandas: doubles travel as they are, and NaN is no value here.
    grouped = with_slot(with_time(bars).select(*BAR_COLUMNS)).groupBy(*SLOT)
    kept = grouped.transformWithStateInPandas(KeepFirst(), BARS, "Append", "None", initial)
    return kept.select(*[F.expr(f"nullif({f.name}, double('NaN')) AS {f.name}") if f.dataType.simpleString() == "double" else f.name for f in BARS.fields])


def stream_raw(
    spark: SparkSession, landing: str, lake: Lake, checkpoint: str, max_files_per_trigger: int = 10_000, strict: bool = False
) -> StreamingQuery:
    """New landing files, cleaned into the raw store; a replayed batch replaces its own rows."""
    files_fit = max_files_per_trigger <= BROADCAST_ROWS or None
    lines = as_landing_lines(
        spark.readStream.format("text")
        .option("pathGlobFilter", "*_{" + ",".join([DAILY, *INTRADAY]) + "}.csv")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing)
    )

    def clean(batch: DataFrame, number: int) -> None:
        write_raw(clean_landing(batch, strict=strict, files_fit=files_fit), lake.raw, f"stream-{number}")

    return lines.writeStream.foreachBatch(clean).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_master(spark: SparkSession, lake: Lake, checkpoint: str, max_files_per_trigger: int = 1_000) -> StreamingQuery:
    """New rows of the raw store to the master, first value wins; stops when all present files are done.

    Each micro-batch is written as a delta of its own, which a replay replaces, and then appended. Only a
    replay, whose delta is there already, compares it with the master before it appends.
    """
    rows = (
        spark.readStream.schema(T.StructType([*RAW.fields, T.StructField(BATCH, T.StringType())]))
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(lake.raw)
    )
    started = path_exists(spark, checkpoint)
    stored = None if started or not path_exists(spark, lake.master) else read_bars(spark, lake.master)
    new = first_bars(rows.where(F.col("outcome") == BAR), stored)

    def commit(batch: DataFrame, number: int) -> None:
        own, name = batch.sparkSession, f"keyed-{number}"
        replayed = not read_batches(own, lake.delta, BARS, name).isEmpty()
        write_delta(batch, lake.delta, name)
        delta = read_delta(own, lake.delta, name)
        append_bars(delta_of(delta, read_bars_or_empty(own, lake.master)) if replayed else delta, lake.master)
        add_to_state(delta, lake.state, name)

    return new.writeStream.foreachBatch(commit).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
