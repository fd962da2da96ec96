import numpy as np
import pandas as pd
import pytest

from barlake.operators import steps
from barlake.operators.ordering import find_crowded_slots
from tests.conftest import bar


def expected(rows):
    df = pd.DataFrame(rows, columns=["ticker", "timeframe", "ts", "open", "high", "low", "close", "volume", "seq"])
    out = {}
    for key, part in df.groupby(["ticker", "timeframe"]):
        ts = pd.to_datetime(part["ts"])
        diff = ts.sort_values().diff()
        limit = pd.Timedelta(days=3) if key[1] == "1d" else diff.median() * 10
        gaps = int((diff > limit).sum()) if pd.notna(limit) else 0
        median = None if pd.isna(diff.median()) else diff.median().value / 1000
        out[key] = (int(ts.duplicated().sum()), gaps, median)
    return out


def random_bars(seed, n=300):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        timeframe = "1d" if rng.random() < 0.4 else "5m"
        ticker = "HOT" if rng.random() < 0.8 else "COLD"
        day = int(rng.choice([1, 2, 3, 4, 9, 20]))
        clock = "00:00:00" if timeframe == "1d" else f"{int(rng.integers(0, 24)):02d}:{int(rng.integers(0, 12)) * 5:02d}:00.000{int(rng.integers(0, 3))}"
        rows.append(bar(ticker, timeframe, None if rng.random() < 0.05 else f"2024-01-{day:02d} {clock}", 1.0, i))
    return rows


@pytest.mark.parametrize("rows_per_block", [2, 1 << 20])
@pytest.mark.parametrize("bars_per_slot", [1, 10, 4096])
def test_counts_match_a_direct_computation(bars_of_rows, bars_per_slot, rows_per_block):
    rows = random_bars(bars_per_slot)
    crowded = find_crowded_slots(bars_of_rows(rows), rows_per_block, bars_per_slot)
    assert bool(crowded) == (rows_per_block == 2)
    got = {
        (r["ticker"], r["timeframe"]): (r["n_duplicates"], r["n_gaps"], r["median_step_us"])
        for r in steps.step_counts(bars_of_rows(rows), bars_per_slot, crowded).collect()
    }
    assert got == expected(rows)


def test_missing_times_count_as_one_value(bars_of_rows):
    rows = [bar("A", "5m", t, 1.0, i) for i, t in enumerate([None, None, None, "2024-01-01 00:00:00", "2024-01-01 00:00:00"])]
    assert [r["n_duplicates"] for r in steps.duplicate_counts(bars_of_rows(rows)).collect()] == [3]
    assert [r["n_duplicates"] for r in steps.step_counts(bars_of_rows(rows)).collect()] == [3]


@pytest.mark.parametrize(
    "days, gaps", [(["2024-01-05", "2024-01-08"], 0), (["2024-01-05", "2024-01-09"], 1)]
)
def test_three_days_are_allowed_between_daily_bars(bars_of_rows, days, gaps):
    rows = [bar("A", "1d", d, 1.0, i) for i, d in enumerate(days)]
    assert [r["n_gaps"] for r in steps.step_counts(bars_of_rows(rows)).collect()] == [gaps]


def test_ten_medians_exactly_are_no_gap(bars_of_rows):
    minutes = [0, 1, 2, 3, 13, 24]
    rows = [bar("A", "1m", f"2024-01-01 00:{m:02d}:00", 1.0, m) for m in minutes]
    assert [r["n_gaps"] for r in steps.step_counts(bars_of_rows(rows)).collect()] == [1]


@pytest.mark.parametrize("bars_per_slot", [1, 4096])
def test_time_steps(bars_of_rows, bars_per_slot):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-01 00:05:00", "2024-01-02 00:00:00", None]
    rows = [bar("A", "5m", t, 1.0, i) for i, t in enumerate(times)]
    got = sorted((str(r["ts"]), r["n_rows"], r["step_us"]) for r in steps.time_steps(bars_of_rows(rows), bars_per_slot).collect())
    assert got == [
        ("2024-01-01 00:00:00", 1, None),
        ("2024-01-01 00:05:00", 2, 300_000_000),
        ("2024-01-02 00:00:00", 1, 86_100_000_000),
    ]


def jittered(seed, n):
    """Irregular times down to the microsecond, so that nearly every step is its own."""
    rng = np.random.default_rng(seed)
    rows, at = [], np.datetime64("2024-01-01T00:00:00.000000")
    for i in range(n):
        at = at + np.timedelta64(int(rng.choice([1, 7, 900, 60_000_000, 59_999_000])) + int(rng.integers(0, 2000)), "us")
        rows.append(bar("A" if rng.random() < 0.7 else "B", "1m", str(at).replace("T", " "), 1.0, i))
    return rows


@pytest.mark.parametrize("digits", [1, 3, 13])
@pytest.mark.parametrize("n", [2, 3, 400, 401])
def test_median_of_irregular_steps_is_exact(bars_of_rows, monkeypatch, digits, n):
    monkeypatch.setattr(steps, "CODE_BITS", digits)
    rows = jittered(n, n)
    got = {r["ticker"]: r["median_step_us"] for r in steps.step_counts(bars_of_rows(rows)).collect()}
    assert got == {key[0]: median for key, (_, _, median) in expected(rows).items()}


def test_codes_rise_with_steps(spark):
    edges = sorted({max(0, 2**k + d) for k in range(0, 62, 3) for d in (-1, 0, 1)})
    df = spark.createDataFrame([(x,) for x in edges], "step_us long")
    for bits in (1, 2, 8, steps.CODE_BITS, 21):
        codes = [r[0] for r in df.selectExpr(steps._code(bits), "step_us").orderBy("step_us").collect()]
        assert codes == sorted(codes)


def test_no_window_gathers_a_series(spark):
    histogram = spark.createDataFrame([("A", "1m", s, n) for s, n in [(0, 4), (5, 1), (70, 2), (10**12, 1), (None, 50)]], "ticker string, timeframe string, step_us long, n long")
    found = steps.median_steps(histogram)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("A", "1m", 0, 5)]
