"""PIP-6, FRS-3: the full run, from fetch to publish, with one outcome row per step."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.parsing import file_stem, ticker_of, timeframe_of
from barlake.functions.timing import as_of_literal, run_stamp
from barlake.operators.filters import daily, intraday
from barlake.operators.freshness import daily_freshness, intraday_freshness, needs_refresh, stale_part_of
from barlake.plans.clean import bars_of, clean_landing, cleaned_fetch, missing_of
from barlake.plans.publish import Target, publish_combined, publish_split
from barlake.plans.quality_state import counters_of, take_in_deltas
from barlake.schema import SERIES, TICKER, TIMEFRAME
from barlake.sinks.batches import read_batches, write_batch
from barlake.sinks.file_states import add_file_states, current_errors, errors_of, read_states
from barlake.sinks.series_state import has_state, read_state
from barlake.sinks.store import merge_into_master, read_raw, write_quality, write_raw
from barlake.sources.fetch import FETCHED, Fetcher, fetch
from barlake.sources.lake import read_bars, read_bars_or_empty
from barlake.sources.landing import files_may_be_broadcast
from barlake.sources.universe import fetch_plan

log = logging.getLogger(__name__)

PLAN = T.StructType([T.StructField(c, T.StringType()) for c in (*SERIES, "period")])
STEPS = ["data_collection", "quality_checks", "split_publish", "combined_publish"]


@dataclass(frozen=True)
class Lake:
    """Folders of one lake, all under one base."""

    base: str

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def plans(self) -> str:
        return f"{self.base}/plans"

    @property
    def fetched(self) -> str:
        return f"{self.base}/fetched"

    @property
    def files(self) -> str:
        return f"{self.base}/file_states"

    @property
    def missing(self) -> str:
        return f"{self.base}/missing_values"

    @property
    def quality(self) -> str:
        return f"{self.base}/quality_state"

    @property
    def delta(self) -> str:
        return f"{self.base}/delta"

    @property
    def master(self) -> str:
        return f"{self.base}/master"

    @property
    def state(self) -> str:
        return f"{self.base}/series_state"

    @property
    def reports(self) -> str:
        return f"{self.base}/quality_reports"


@dataclass(frozen=True)
class Switches:
    quality: bool = True
    split_publish: bool = False
    combined_publish: bool = False


def refresh_plan(
    lake: Lake,
    tickers: DataFrame,
    as_of: str,
    only_stale: bool = False,
    expect_all: bool = False,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """FRS-3: what to fetch now. One stale daily series asks for all daily series, one stale intraday
    series for all intraday ones; with ``only_stale`` just the stale series are fetched. Series in
    ``unreadable`` (ticker, timeframe) are stale whatever is stored."""
    spark = tickers.sparkSession
    tickers = tickers.select(TICKER).distinct()
    # Where a state is kept, no bar is read.
    bars = read_state(spark, lake.state) if has_state(spark, lake.state) else read_bars_or_empty(spark, lake.master)
    plan = fetch_plan(tickers)
    families = [
        (daily(plan), daily_freshness(bars, tickers, as_of, unreadable=unreadable)),
        (intraday(plan), intraday_freshness(bars, as_of, tickers=tickers, expect_all=expect_all, unreadable=unreadable)),
    ]
    chosen = []
    for part, freshness in families:
        if only_stale:
            chosen.append(stale_part_of(part, freshness))
        elif needs_refresh(freshness).first()[0]:
            chosen.append(part)
    if not chosen:
        return plan.limit(0)
    return chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])


def collect_landing(lines: DataFrame, lake: Lake, batch_id: str, strict: bool = False) -> None:
    """Clean the lines of a landing scan into the raw store and merge them into the master."""
    files_fit = files_may_be_broadcast(lines)
    store_and_merge(clean_landing(lines, strict=strict, files_fit=files_fit), lake, batch_id)


def store_and_merge(cleaned: DataFrame, lake: Lake, batch_id: str) -> None:
    """Cleaned lines to the raw store, their files' states, the bars that lack a value (FLT-3), and the master
    with its delta and series state."""
    write_raw(cleaned, lake.raw, batch_id)
    stored = read_raw(cleaned.sparkSession, lake.raw, batch_id)
    add_file_states(stored, lake.files, batch_id)
    write_batch(missing_of(stored), lake.missing, batch_id)
    merge_into_master(bars_of(stored), lake.master, lake.delta, batch_id, lake.state)


def collect_fetch(plan: DataFrame, fetcher: Fetcher, lake: Lake, batch_id: str) -> None:
    """SRC-4, SNK-1: fetch, clean and merge. Each plan row is asked for once: the answers are written
    down first, with their errors, and everything else is derived from what was written."""
    spark = plan.sparkSession
    write_batch(plan.select(*SERIES, "period"), lake.plans, batch_id)
    write_batch(fetch(planned_series(spark, lake, batch_id), fetcher), lake.fetched, batch_id)
    store_and_merge(cleaned_fetch(read_batches(spark, lake.fetched, FETCHED, batch_id)), lake, batch_id)


def planned_series(spark: SparkSession, lake: Lake, batch_id: str) -> DataFrame:
    """The plan rows that a batch asked for."""
    return read_batches(spark, lake.plans, PLAN, batch_id)


def unreadable_series(spark: SparkSession, lake: Lake, batch_id: str) -> DataFrame:
    """FRS-1, FRS-2: series whose file or answer in a batch could not be used as a whole."""
    stem = file_stem(F.col("source_file"))
    errors = errors_of(read_states(spark, lake.files, batch_id), with_fetches=True)
    return errors.select(ticker_of(stem).alias(TICKER), timeframe_of(stem).alias(TIMEFRAME)).distinct()


def check_master(spark: SparkSession, lake: Lake, run_id: str, expected: DataFrame | None = None) -> None:
    """Quality run over the master; time order is the stored order of a merged master.

    The quality state is brought up to date first, for which only the slots that new deltas touch are
    read. ``expected`` names series that should hold bars; the errors are those of files as they last came.
    """
    bars = read_bars_or_empty(spark, lake.master)
    counters = counters_of(take_in_deltas(bars, lake.delta, lake.quality))
    errors = current_errors(spark, lake.files)
    write_quality(bars, lake.reports, run_id, expected=expected, file_errors=errors, counters=counters)


def run_steps(
    spark: SparkSession,
    collect: Callable[[], object],
    check: Callable[[], object],
    split_publish: Callable[[], object],
    combined_publish: Callable[[], object],
    switches: Switches = Switches(),
) -> DataFrame:
    """PIP-6: (step, ok, detail). Only a failing collection stops the run and fails it; a later step
    that fails is reported in ``detail`` and does not count as a failure."""
    planned = [
        (STEPS[0], True, collect),
        (STEPS[1], switches.quality, check),
        (STEPS[2], switches.split_publish, split_publish),
        (STEPS[3], switches.combined_publish, combined_publish),
    ]
    outcomes: list[tuple[str, bool, str]] = []
    aborted = False
    for name, enabled, action in planned:
        if aborted:
            outcomes.append((name, False, "not run"))
            continue
        if not enabled:
            outcomes.append((name, True, "disabled"))
            continue
        try:
            action()
            outcomes.append((name, True, "done"))
        except Exception as problem:  # noqa: BLE001 - the outcome table is the error report
            log.exception("step %s failed", name)
            aborted = name == STEPS[0]
            outcomes.append((name, not aborted, f"failed: {type(problem).__name__}: {problem}"))
    return spark.createDataFrame(outcomes, "step string, ok boolean, detail string")


def run_lake(
    lines: DataFrame,
    lake: Lake,
    batch_id: str,
    daily_target: Target | None = None,
    intraday_target: Target | None = None,
    combined_target: Target | None = None,
    switches: Switches = Switches(),
    expected: DataFrame | None = None,
) -> DataFrame:
    """The standard run over landing lines."""
    collect = lambda: collect_landing(lines, lake, batch_id)
    targets = (daily_target, intraday_target, combined_target)
    return _run(lines.sparkSession, collect, lake, batch_id, *targets, switches=switches, expected=lambda: expected)


def refresh_lake(
    tickers: DataFrame,
    fetcher: Fetcher,
    lake: Lake,
    batch_id: str | None,
    as_of: str,
    daily_target: Target | None = None,
    intraday_target: Target | None = None,
    combined_target: Target | None = None,
    switches: Switches = Switches(),
    only_stale: bool = False,
    expect_all: bool = False,
    previous_batch: str | None = None,
) -> DataFrame:
    """PIP-6 from the start: what is stale, or was unreadable in the previous batch, is fetched, cleaned
    and merged; then the checks and the publishing. Series that were asked for are expected to hold bars.
    Without a ``batch_id`` the run is named by its time (SCL-16)."""
    spark = tickers.sparkSession
    batch_id = batch_id or spark.range(1).select(run_stamp(as_of_literal(as_of))).first()[0]

    def collect() -> None:
        broken = unreadable_series(spark, lake, previous_batch) if previous_batch else None
        plan = refresh_plan(lake, tickers, as_of, only_stale, expect_all, broken)
        collect_fetch(plan, fetcher, lake, batch_id)

    targets = (daily_target, intraday_target, combined_target)
    return _run(spark, collect, lake, batch_id, *targets, switches=switches, expected=lambda: planned_series(spark, lake, batch_id))


def _run(
    spark: SparkSession,
    collect: Callable[[], object],
    lake: Lake,
    batch_id: str,
    daily_target: Target | None,
    intraday_target: Target | None,
    combined_target: Target | None,
    switches: Switches,
    expected: Callable[[], DataFrame | None],
) -> DataFrame:
    master = lambda: read_bars(spark, lake.master)
    return run_steps(
        spark,
        collect=collect,
        check=lambda: check_master(spark, lake, batch_id, expected()),
        split_publish=lambda: publish_split(master(), daily_target, intraday_target),
        combined_publish=lambda: publish_combined(master(), combined_target),
        switches=switches,
    )

