import json

import pytest

from barlake.operators import freshness
from barlake.sources import universe
from tests.conftest import as_sorted, bar


def states(df):
    return {(r["ticker"], r["timeframe"]): (r["state"], r["stale"]) for r in df.collect()}


def test_daily_states(spark, bars_of_rows):
    bars = bars_of_rows(
        [
            bar("SEVEN", "1d", "2024-01-03"),
            bar("EIGHT", "1d", "2024-01-02"),
            bar("NOTIME", "1d", None),
            bar("INTRA", "5m", "2024-01-10"),
            bar("BROKEN", "1d", "2024-01-10"),
        ]
    )
    tickers = spark.createDataFrame([(t,) for t in ("SEVEN", "EIGHT", "NOTIME", "INTRA", "BROKEN")], "ticker string")
    broken = spark.createDataFrame([("BROKEN", "1d")], "ticker string, timeframe string")
    got = freshness.daily_freshness(bars, tickers, "2024-01-10 23:59:59", unreadable=broken)
    assert states(got) == {
        ("SEVEN", "1d"): ("fresh", False),
        ("EIGHT", "1d"): ("old", True),
        ("NOTIME", "1d"): ("no_time", True),
        ("INTRA", "1d"): ("missing", True),
        ("BROKEN", "1d"): ("unreadable", True),
    }
    assert freshness.needs_refresh(got).first()[0] is True


def test_intraday_states(spark, bars_of_rows):
    bars = bars_of_rows(
        [
            bar("A", "5m", "2024-01-01 00:00:00"),
            bar("B", "5m", "2023-12-31 23:59:59"),
            bar("C", "1h", None),
            bar("D", "1d", "2020-01-01"),
            bar("E", "2h", "2020-01-01"),
        ]
    )
    as_of = "2024-01-01 12:00:00"
    assert states(freshness.intraday_freshness(bars, as_of)) == {
        ("A", "5m"): ("fresh", False),
        ("B", "5m"): ("old", True),
        ("C", "1h"): ("no_time", True),
    }
    existing = spark.createDataFrame([("Z", "1m"), ("A", "5m")], "ticker string, timeframe string")
    assert states(freshness.intraday_freshness(bars, as_of, existing=existing))[("Z", "1m")] == ("empty", True)


def test_absent_intraday_series_are_fresh_unless_expected(spark, bars_of_rows):
    nothing = bars_of_rows([])
    assert freshness.needs_refresh(freshness.intraday_freshness(nothing, "2024-01-01 00:00:00")).first()[0] is False
    tickers = spark.createDataFrame([("A",)], "ticker string")
    all_sizes = freshness.intraday_freshness(nothing, "2024-01-01 00:00:00", tickers=tickers, expect_all=True)
    assert set(states(all_sizes).values()) == {("missing", True)} and all_sizes.count() == 6
    with pytest.raises(ValueError):
        freshness.intraday_freshness(nothing, "2024-01-01 00:00:00", expect_all=True)


def test_universe_file_and_plan(spark, tmp_path):
    path = tmp_path / "tickers.json"
    path.write_text(json.dumps({"stocks": ["aapl", "BRK.A"], "index": ["^gspc"], "none": []}, indent=1))
    tickers = universe.read_universe(spark, str(path))
    assert as_sorted(tickers, "group", "ticker") == [("index", "^GSPC"), ("stocks", "AAPL"), ("stocks", "BRK.A")]
    plan = universe.fetch_plan(tickers)
    periods = {r["timeframe"]: r["period"] for r in plan.where("ticker = 'AAPL'").collect()}
    assert periods == {"1m": "7d", "5m": "60d", "15m": "60d", "30m": "60d", "90m": "60d", "1h": "730d", "1d": "max"}
    assert plan.count() == 21
    assert universe.fetch_plan(tickers, ["2h"], with_daily=False).first()["period"] == "60d"


def test_selective_refresh(spark, bars_of_rows):
    tickers = spark.createDataFrame([("A",), ("B",)], "ticker string")
    bars = bars_of_rows([bar("A", "1d", "2024-01-10")])
    stale = freshness.daily_freshness(bars, tickers, "2024-01-11 00:00:00")
    part = freshness.stale_part_of(universe.fetch_plan(tickers), stale)
    assert as_sorted(part, "ticker", "timeframe") == [("B", "1d")]
