"""Partial results by time slot give the counters of a whole run, whatever deliveries they came from."""

import numpy as np
import pytest

from barlake.plans import quality, quality_state
from barlake.schema import BAR_COLUMNS
from tests.conftest import as_sorted, bar


def crowded_bars(seed, n=400):
    """Bars with repeated times, one crowded time, missing closes and times, zero and equal closes."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        timeframe = "1d" if rng.random() < 0.3 else "5m"
        ticker = "HOT" if rng.random() < 0.8 else "COLD"
        day, clock = int(rng.choice([1, 2, 3, 9, 20])), "00:00:00"
        if timeframe == "5m" and rng.random() < 0.6:
            clock = f"{int(rng.integers(0, 24)):02d}:{int(rng.integers(0, 12)) * 5:02d}:00"
        close = None if rng.random() < 0.2 else float(rng.choice([0.0, 1.0, 1.0, 1.1, 50.0, rng.random() + 1]))
        ts = None if rng.random() < 0.06 else f"2024-01-{day:02d} {clock}"
        rows.append(bar(ticker, timeframe, ts, close, i, volume=float(rng.integers(0, 3))))
    return rows


def rows_of(counters):
    return as_sorted(counters, *sorted(counters.columns))


@pytest.mark.parametrize("rows_per_block, bars_per_slot", [(1 << 16, None), (3, 4), (2, 1), (7, 4096)])
def test_state_gives_the_counters_of_a_whole_run(bars_of_rows, rows_per_block, bars_per_slot):
    bars = bars_of_rows(crowded_bars(rows_per_block))
    state = quality_state.block_state(bars, rows_per_block, bars_per_slot)
    assert rows_of(quality_state.counters_of(state)) == rows_of(quality.quality_counters(bars))


@pytest.mark.parametrize("rows_per_block, bars_per_slot", [(1 << 16, 4), (3, 4)])
def test_deliveries_one_by_one_give_the_same(bars_of_rows, rows_per_block, bars_per_slot):
    rows = crowded_bars(11)
    parts = [rows[:50], rows[200:], rows[50:60], rows[60:200]]
    state, seen = None, []
    for part in parts:
        seen += part
        if state is None:
            state = quality_state.block_state(bars_of_rows(part), rows_per_block, bars_per_slot)
        else:
            state = quality_state.updated_state(state, bars_of_rows(part), bars_of_rows(seen), rows_per_block, bars_per_slot)
        state = state.sparkSession.createDataFrame(state.collect(), state.schema)
        assert rows_of(quality_state.counters_of(state)) == rows_of(quality.quality_counters(bars_of_rows(seen)))


def test_only_touched_slots_change(bars_of_rows):
    first = [bar("A", "5m", f"2024-01-0{d} 00:0{m}:00", 1.0 + m, 10 * d + m) for d in (1, 2, 3) for m in range(0, 9, 5)]
    late = [bar("A", "5m", "2024-01-02 00:10:00", 9.0, 99)]
    state = quality_state.block_state(bars_of_rows(first), bars_per_slot=288)
    slots = quality_state.touched_slots(bars_of_rows(late), 288)
    assert slots.count() == 1
    assert quality_state.only_slots(bars_of_rows(first), slots, 288).count() == 2
    after = quality_state.updated_state(state, bars_of_rows(late), bars_of_rows(first + late), bars_per_slot=288)
    same = {str(r) for r in state.collect()} & {str(r) for r in after.collect()}
    assert len(same) == 2 and after.count() == 3


def test_stored_state_takes_a_delivery_twice(spark, tmp_path, bars_of_rows):
    path, rows = str(tmp_path / "state"), crowded_bars(5)
    assert quality_state.read_quality_state(spark, path) is None
    quality_state.refresh_quality_state(bars_of_rows(rows[:300]), bars_of_rows(rows[:300]), path)
    for _ in range(2):
        state = quality_state.refresh_quality_state(bars_of_rows(rows[300:]), bars_of_rows(rows), path)
        assert rows_of(quality_state.counters_of(state)) == rows_of(quality.quality_counters(bars_of_rows(rows)))


def test_lists_stay_in_their_blocks(spark, tmp_path, bars_of_rows):
    """No exchange carries the lists of steps or returns."""
    quality_state.append_blocks(quality_state.block_state(bars_of_rows(crowded_bars(2))), str(tmp_path / "s"))
    plan = quality_state.counters_of(quality_state.read_quality_state(spark, str(tmp_path / "s")), series_small=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Window [" in line:
            assert "steps#" not in line and "returns#" not in line


def test_no_bars(spark, bars_of_rows):
    state = quality_state.block_state(bars_of_rows([]))
    assert quality_state.counters_of(state).count() == 0
    assert set(BAR_COLUMNS) & set(state.columns) == {"ticker", "timeframe"}
