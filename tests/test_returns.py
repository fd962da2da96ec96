import numpy as np
import pandas as pd
import pytest

from barlake.operators import returns
from tests.conftest import bar


def random_bars(seed, n=400):
    """Two series of very different size, gaps in the closes, repeated and missing times."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        ticker = "HOT" if rng.random() < 0.9 else "COLD"
        minute = int(rng.integers(0, 90))
        ts = None if rng.random() < 0.05 else f"2024-01-0{1 + minute // 40} 10:{minute % 40:02d}:00"
        close = None if rng.random() < 0.2 else float(rng.integers(0, 6))
        rows.append(bar(ticker, "1m", ts, close, i))
    rng.shuffle(rows)
    return [tuple(r) for r in rows]


def expected_returns(rows, order, fill=True):
    df = pd.DataFrame(rows, columns=["ticker", "timeframe", "ts", "open", "high", "low", "close", "volume", "seq"])
    by = ["seq"] if order == "seq" else ["ts", "seq"]
    out = {}
    for ticker, part in df.groupby("ticker"):
        part = part.sort_values(by, na_position="last")
        close = part["close"].astype(float)
        close = close.ffill() if fill else close
        ret = close / close.shift(1) - 1
        ret[(close.shift(1) == 0)] = np.nan
        out.update({(ticker, int(s)): r for s, r in zip(part["seq"], ret) if not np.isnan(r)})
    return out


@pytest.mark.parametrize("order", ["seq", "ts"])
@pytest.mark.parametrize("rows_per_block", [1, 7, 1 << 20])
@pytest.mark.parametrize("fill", [True, False])
def test_blocks_do_not_change_the_returns(bars_of_rows, order, rows_per_block, fill):
    rows = random_bars(rows_per_block + fill)
    got = returns.simple_returns(
        bars_of_rows(rows), order=order, fill=fill, rows_per_block=rows_per_block, bars_per_slot=13
    ).collect()
    want = expected_returns(rows, order, fill)
    assert {(r["ticker"], r["seq"]) for r in got} == set(want)
    assert len(got) == len(want)
    for r in got:
        assert r["ret"] == pytest.approx(want[r["ticker"], r["seq"]], abs=1e-12)


def test_outliers_match_a_direct_count(bars_of_rows):
    rng = np.random.default_rng(5)
    closes = np.cumprod(1 + rng.normal(0, 0.01, 500))
    closes[[100, 300]] *= 2
    rows = [bar("A", "1m", None, float(c), i) for i, c in enumerate(closes)]
    ret = pd.Series(closes).pct_change().dropna()
    want = int((abs((ret - ret.mean()) / ret.std()) > 3).sum())
    got = returns.outlier_counts(bars_of_rows(rows))
    assert [r["n_outliers"] for r in got.collect()] == [want]
    salted = returns.outlier_counts(bars_of_rows(rows), series_small=False)
    assert [r["n_outliers"] for r in salted.collect()] == [want]


@pytest.mark.parametrize("closes", [[5.0], [None, None], [0.0, 1.0], []])
def test_series_without_returns_has_no_outliers(bars_of_rows, closes):
    rows = [bar("A", "1m", None, c, i) for i, c in enumerate(closes)]
    assert returns.outlier_counts(bars_of_rows(rows)).collect() == []


def test_constant_series_has_no_outliers(bars_of_rows):
    rows = [bar("A", "1m", None, 2.0, i) for i in range(5)]
    assert [r["n_outliers"] for r in returns.outlier_counts(bars_of_rows(rows)).collect()] == [0]


def test_deliveries_with_their_own_seq_are_ordered_by_time(bars_of_rows):
    days = [("2024-01-01", 1.0, 0), ("2024-01-02", 2.0, 1), ("2024-01-03", 10.0, 0), ("2024-01-04", 20.0, 1)]
    bars = bars_of_rows([bar("A", "1d", day, close, seq) for day, close, seq in days])
    got = sorted(r["ret"] for r in returns.simple_returns(bars).collect())
    assert got == pytest.approx([1.0, 1.0, 4.0])


def test_unknown_order_is_refused(bars_of_rows):
    with pytest.raises(ValueError):
        returns.simple_returns(bars_of_rows([]), order="close")
