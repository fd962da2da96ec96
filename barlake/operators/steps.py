"""WIN-2, AGG-5, AGG-8, DQ-3, DQ-7, DQ-8: distinct times, time steps, exact median, gaps.

Steps are taken inside time slots, and between slots from the first and last time of each, so no
task sorts a whole series. In crowded slots the rows are first collapsed to distinct times with a
count (combined before the shuffle), so a time repeated millions of times costs one row; a repeat
is a step of zero. Steps are then counted by length; the median is selected from that histogram, and gaps are
counted in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.lookup import attach, series_fit
from barlake.operators.ordering import CrowdedSlots, find_crowded_slots, has_series, with_slot
from barlake.schema import DAILY, DAILY_GAP_DAYS, GAP_FACTOR, KEY, SERIES, TIMEFRAME, TS


#: Binary digits by which steps are counted on the way to their median.
CODE_BITS = 13
_KEYS = ", ".join(SERIES)
_MICROS = "unix_micros(CAST({} AS TIMESTAMP))"


def _step_sql(ts: str, before: str, window: str) -> str:
    return f"{_MICROS.format(ts)} - {_MICROS.format(f'lag({before}) OVER ({window})')} AS step_us"


def distinct_times(bars: DataFrame, bars_per_slot: int | None = None) -> DataFrame:
    """(series, ts, n_rows, _slot): one row per distinct time, a missing time counting as one."""
    times = has_series(bars).groupBy(*KEY).agg(F.expr("count(*) AS n_rows"))
    return with_slot(times, bars_per_slot)


def _steps_in_slots(times: DataFrame) -> DataFrame:
    """Times with the step from the one before in the same slot (NULL for the first)."""
    return times.selectExpr("*", _step_sql(TS, TS, f"PARTITION BY {_KEYS}, _slot ORDER BY {TS}"))


def _steps_between_slots(slots: DataFrame) -> DataFrame:
    """Slots with the step from the last time of the slot before to their first (``_first``, ``_last``)."""
    return slots.selectExpr("*", _step_sql("_first", "_last", f"PARTITION BY {_KEYS} ORDER BY _slot"))


def time_steps(bars: DataFrame, bars_per_slot: int | None = None) -> DataFrame:
    """WIN-2, SRT-2: (series, ts, n_rows, step_us) per distinct time in time order.

    ``step_us`` is the step from the previous distinct time (NULL for the first of the series); the
    other ``n_rows - 1`` rows of the same time have a step of zero.
    """
    times = distinct_times(bars, bars_per_slot).where(f"{TS} IS NOT NULL")
    columns = [*KEY, "n_rows", "step_us"]
    slots = times.groupBy(*SERIES, "_slot").agg(
        F.expr(f"min({TS}) AS _first"), F.expr(f"max({TS}) AS _last"), F.expr(f"min_by(n_rows, {TS}) AS n_rows")
    )
    firsts = _steps_between_slots(slots).withColumnRenamed("_first", TS).select(*columns)
    return _steps_in_slots(times).where("step_us IS NOT NULL").select(*columns).unionByName(firsts)


def step_histogram(
    bars: DataFrame, bars_per_slot: int | None = None, crowded: CrowdedSlots | None = None
) -> DataFrame:
    """(series, step_us, n): how often each step occurs, repeats included as step 0.

    Rows without a time that repeat another such row appear under a NULL step, so the counts of
    the steps 0 and NULL add up to the duplicates (AGG-5).

    Distinct steps of a series add up to at most its time span, so there are fewer than
    sqrt(2 * span in microseconds) of them: 8 million for a year of irregular times, a handful for
    bars on a grid, however many rows the series has.
    """
    if crowded is None:
        crowded = find_crowded_slots(bars, bars_per_slot=bars_per_slot)
    rows = with_slot(bars.select(*KEY), bars_per_slot)
    timed = rows.where(f"{TS} IS NOT NULL")
    columns = [*SERIES, "step_us", "n"]
    parts = []
    if crowded:
        marked = crowded.mark(timed)
        repeated = marked.where("_crowded").groupBy(*KEY, "_slot").agg(F.expr("count(*) AS n_rows"))
        parts.append(repeated.selectExpr(*SERIES, "0L AS step_us", "n_rows - 1 AS n"))
        timed = marked.where("_crowded IS NULL").select(*KEY, "_slot").union(repeated.select(*KEY, "_slot"))
    parts.append(_steps_in_slots(timed).selectExpr(*SERIES, "step_us", "1L AS n").where("step_us IS NOT NULL"))
    # One small row per slot straight from the scan.
    slots = rows.groupBy(*SERIES, "_slot").agg(
        F.expr(f"min({TS}) AS _first"), F.expr(f"max({TS}) AS _last"), F.expr(f"count_if({TS} IS NULL) - 1 AS _untimed")
    )
    between = _steps_between_slots(slots)
    parts.append(between.selectExpr(*SERIES, "step_us", "CASE WHEN step_us IS NULL THEN _untimed ELSE 1L END AS n"))
    steps = reduce(DataFrame.union, [p.select(*columns) for p in parts])
    return steps.where("n > 0").groupBy(*SERIES, "step_us").agg(F.expr("sum(n) AS n"))


def _code(bits: int, step: str = "step_us") -> str:
    """A number that rises with the step: its length in binary digits, then the first ``bits`` of them; -1 for none.

    It is never NULL, so no filter is derived from it that would tell the uses of a histogram apart:
    all of them read one shuffle of it.
    """
    length = f"CAST(length(bin({step})) AS BIGINT)"
    return f"coalesce(shiftleft({length}, {bits}) + shiftright({step}, CAST(greatest({length} - {bits}, 0) AS INT)), -1L)"


def _at_ranks(steps: DataFrame) -> DataFrame:
    """(series, low, high, want_low, want_high): the codes that hold the wanted ranks of each series, and the
    ranks that are wanted among their steps.

    ``steps`` is (series, step_us, n, code) and the ranks wanted among them, or none for the two middle ones.
    A code comes with its least and largest step; per series only its codes are gathered.
    """
    wanted = [c for c in ("want_low", "want_high") if c in steps.columns]
    counts = steps.groupBy(*SERIES, "code").agg(
        F.expr("sum(n) AS n"),
        F.expr("min(step_us) AS least"),
        F.expr("max(step_us) AS most"),
        *[F.expr(f"any_value({c}) AS {c}") for c in wanted],
    )
    entry = "named_struct('code', code, 'n', n, 'least', least, 'most', most)"
    listed = counts.groupBy(*SERIES).agg(
        F.expr(f"filter(array_sort(collect_list({entry})), x -> x.code >= 0) AS codes"),
        *[F.expr(f"any_value({c}) AS {c}") for c in wanted],
    )
    if not wanted:
        total = listed.selectExpr("*", "aggregate(codes, 0L, (a, x) -> a + x.n) AS total")
        listed = total.selectExpr(*SERIES, "codes", "(total + 1) div 2 AS want_low", "total div 2 + 1 AS want_high")
    kind = "STRUCT<code: BIGINT, n: BIGINT, least: BIGINT, most: BIGINT>"
    start = f"named_struct('upto', 0L, 'low', CAST(NULL AS {kind}), 'high', CAST(NULL AS {kind}), 'before', 0L)"
    holds = "a.{0} IS NULL AND a.upto + x.n >= want_{0}"
    found = (
        f"aggregate(codes, {start}, (a, x) -> named_struct('upto', a.upto + x.n, "
        f"'low', CASE WHEN {holds.format('low')} THEN x ELSE a.low END, "
        f"'high', CASE WHEN {holds.format('high')} THEN x ELSE a.high END, "
        f"'before', CASE WHEN {holds.format('low')} THEN a.upto ELSE a.before END))"
    )
    return listed.selectExpr(*SERIES, "want_low", "want_high", f"{found} AS at").selectExpr(
        *SERIES, "at.low", "at.high", "want_low - at.before AS want_low", "want_high - at.before AS want_high"
    )


def median_steps(histogram: DataFrame, series_small: bool | None = None) -> DataFrame:
    """AGG-8: (series, low_us, high_us), the two middle steps of each series; their mean is the exact median.

    Selection instead of sorting: steps are counted by their length and first CODE_BITS digits. Where the codes
    that hold the wanted ranks have one step each, as on any grid, that is all. Else their steps are
    counted one by one; wanted ranks are neighbours, so no other code lies between theirs. Codes are bounded
    by the digits: 2^18 at most, and no more than a series has distinct steps. What is left is bounded by time:
    codes of steps of two to the k microseconds span 2^(k - CODE_BITS) values, and a series of 100 years has at
    most 2^(52 - k) such steps, so fewer than 2^20 distinct ones.
    """
    if series_small is None:
        series_small = series_fit(histogram)
    coded = histogram.select(*SERIES, "step_us", "n", F.expr(_code(CODE_BITS)).alias("code"))
    first = _at_ranks(coded).withColumn("known", F.expr("low.least = low.most AND high.least = high.most"))
    known = first.where("known IS NULL OR known").selectExpr(*SERIES, "low.least AS low_us", "high.least AS high_us")
    open_codes = first.where("NOT known").selectExpr(*SERIES, "low.code AS low", "high.code AS high", "want_low", "want_high")
    near = attach(coded, open_codes, SERIES, "inner", small_fits=series_small).where("code BETWEEN low AND high")
    second = _at_ranks(near.select(*SERIES, "step_us", "n", F.expr("coalesce(step_us, -1L) AS code"), "want_low", "want_high"))
    return known.unionByName(second.selectExpr(*SERIES, "low.code AS low_us", "high.code AS high_us"))


def with_median(histogram: DataFrame, series_small: bool | None = None) -> DataFrame:
    """AGG-8, JOIN-4: the histogram with the two middle steps of its series, ``low_us`` and ``high_us``."""
    if series_small is None:
        series_small = series_fit(histogram)
    return attach(histogram, median_steps(histogram, series_small), SERIES, small_fits=series_small)


def gap_limit_sql() -> str:
    """Steps strictly above this are gaps: 3 days for daily bars, 10 medians for all others.

    Ten times the mean of the two middle steps, kept in whole numbers.
    """
    return (
        f"CASE WHEN {TIMEFRAME} = '{DAILY}' THEN {DAILY_GAP_DAYS * 86_400_000_000}L "
        f"ELSE {GAP_FACTOR // 2} * (low_us + high_us) END"
    )


def step_counts(
    bars: DataFrame,
    bars_per_slot: int | None = None,
    crowded: CrowdedSlots | None = None,
    series_small: bool | None = None,
) -> DataFrame:
    """DQ-3, DQ-7, DQ-8: (series, n_duplicates, n_gaps, median_step_us), all from one histogram."""
    if crowded is None:
        crowded = find_crowded_slots(bars, bars_per_slot=bars_per_slot)
    if series_small is None:
        series_small = crowded.few_series or series_fit(bars)
    return counts_from(step_histogram(bars, bars_per_slot, crowded), series_small)


def counts_from(histogram: DataFrame, series_small: bool | None = None) -> DataFrame:
    """(series, n_duplicates, n_gaps, median_step_us) from the counts of steps, whatever they were taken from."""
    count_where = "coalesce(sum(n) FILTER (WHERE {}), 0L) AS {}"
    return with_median(histogram, series_small).groupBy(*SERIES).agg(
        F.expr(count_where.format("step_us IS NULL OR step_us = 0", "n_duplicates")),
        F.expr(count_where.format(f"step_us > {gap_limit_sql()}", "n_gaps")),
        F.expr("min((low_us + high_us) / 2) AS median_step_us"),
    )


def duplicate_counts(bars: DataFrame) -> DataFrame:
    """DQ-3 alone: rows minus distinct times, a missing time counting as one distinct value."""
    return distinct_times(bars).groupBy(*SERIES).agg(F.expr("sum(n_rows - 1) AS n_duplicates"))
