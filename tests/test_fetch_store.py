from datetime import datetime

import pandas as pd
import pytest

from barlake.plans import clean
from barlake.sinks import store
from barlake.sources import fetch, lake, universe
from tests.conftest import as_sorted, bar


def fetcher(ticker, timeframe, period):
    if ticker == "BAD":
        raise TimeoutError("too slow")
    if ticker == "NONE":
        return pd.DataFrame()
    time = "2024-01-02 00:00:00+02:00" if timeframe == "1d" else "2024-01-02 09:30:00-05:00"
    return pd.DataFrame({"index": [time] * 2, "Close": [1.0, "x"], "High": 2, "Low": 1, "Open": 1, "Volume": 5})


@pytest.fixture()
def fetched(spark):
    tickers = spark.createDataFrame([("BAD",), ("NONE",), ("AAPL",)], "ticker string")
    return fetch.fetch(universe.fetch_plan(tickers, ["5m"]), fetcher, tasks=3)


def test_fetch_isolates_failures(fetched):
    assert as_sorted(fetch.fetched_bars(fetched), "timeframe", "ts", "close", "seq") == [
        ("1d", datetime(2024, 1, 2), 1.0, 0),
        ("1d", datetime(2024, 1, 2), None, 1),
        ("5m", datetime(2024, 1, 2, 14, 30), 1.0, 0),
        ("5m", datetime(2024, 1, 2, 14, 30), None, 1),
    ]
    assert as_sorted(fetch.fetch_errors(fetched), "source_file", "line") == [
        ("BAD_1d", "TimeoutError: too slow"),
        ("BAD_5m", "TimeoutError: too slow"),
    ]


TIMES = {
    "SPACE": (["2024-01-02 09:30:00-05:00", "2024-07-02 09:30:00-04:00"], [(2024, 1, 2, 14, 30), (2024, 7, 2, 13, 30)]),
    "T": (["2024-01-02T09:30:00+02:00"] * 2, [(2024, 1, 2, 7, 30)] * 2),
    "NAIVE": (["2024-01-02 09:30:00"] * 2, [(2024, 1, 2, 9, 30)] * 2),
    "DAYS": (["2024-01-02", "2024-01-03"], [(2024, 1, 2), (2024, 1, 3)]),
    "DAY_FIRST": (["13/02/2024", "01/02/2024"], [(2024, 2, 13), (2024, 2, 1)]),
    "MONTH_FIRST": (["01/02/2024", "01/13/2024"], [(2024, 1, 2), (2024, 1, 13)]),
    "GAP": (["2024-01-02", None], [(2024, 1, 2), None]),
    "MIXED": (["2024-01-02", "2024-01-02 09:30:00"], "ValueError"),
    "NO_DAY": (["2024-01-02", "2024-02-30"], "ValueError"),
    "ZONED": (pd.to_datetime(["2024-01-02 09:30", "2024-07-02 09:30"]).tz_localize("US/Eastern"), [(2024, 1, 2, 14, 30), (2024, 7, 2, 13, 30)]),
}


def times_vendor(ticker, timeframe, period):
    return pd.DataFrame({"index": TIMES[ticker][0], "Open": 1, "High": [True, False], "Low": ["1", "x"], "Close": 1.5, "Volume": 2})


def test_times_of_many_answers_are_read_as_those_of_one():
    rows = [(ticker, "5m", "60d") for ticker in TIMES] * 3
    got = [row for batch in fetch.answered(times_vendor, rows) for row in batch.to_pylist()]
    for ticker, (_, want) in TIMES.items():
        own = [row for row in got if row["ticker"] == ticker]
        if isinstance(want, str):
            assert len(own) == 3 and all(want in row["error"] and row["seq"] is row["ts"] is None for row in own)
            continue
        assert [row["ts"] for row in own] == [when and datetime(*when) for when in want] * 3
        assert [(row["seq"], row["high"], row["low"], row["error"]) for row in own] == [(0, 1.0, 1.0, None), (1, 0.0, None, None)] * 3


def test_daily_bars_keep_their_written_day():
    def vendor(ticker, timeframe, period):
        offsets = {"EAST": ["+02:00"] * 2, "WEST": ["-05:00"] * 2, "BOTH": ["-05:00", "-04:00"]}[ticker]
        return pd.DataFrame({"index": [f"2024-01-02 23:00:00{o}" for o in offsets], **{c: 1.0 for c in ("Open", "High", "Low", "Close", "Volume")}})

    (batch,) = fetch.answered(vendor, [(t, "1d", "max") for t in ("EAST", "WEST", "BOTH", "EAST")])
    rows = [row for row in batch.to_pylist() if not row["error"]]
    assert [row["ticker"] for row in rows] == ["EAST", "EAST", "WEST", "WEST", "EAST", "EAST"]
    assert {row["ts"] for row in rows} == {datetime(2024, 1, 2)}


def test_times_are_read_once_for_many_answers(monkeypatch):
    """Not one call with a form to infer for each of a million small answers."""
    calls = []
    read = pd.to_datetime
    monkeypatch.setattr(fetch.pd, "to_datetime", lambda *a, **b: calls.append(b) or read(*a, **b))
    rows = [(f"T{i}", size, "60d") for i in range(300) for size in ("5m", "1d")]
    fetched = list(fetch.answered(lambda *row: fetcher(*row), rows))
    assert sum(batch.num_rows for batch in fetched) == 1200 and len(calls) == 2


def test_fetched_bars_survive_the_landing_zone(spark, fetched, tmp_path):
    path = str(tmp_path / "landing")
    store.write_fetched(fetch.fetched_bars(fetched), path)
    back = clean.bars_of(clean.clean_landing(store.read_fetched(spark, path)))
    columns = ["ticker", "timeframe", "ts", "open", "high", "low", "close", "volume"]
    assert as_sorted(back, *columns) == as_sorted(fetch.fetched_bars(fetched), *columns)


def test_raw_store_keeps_only_the_last_fetch(spark, tmp_path):
    landing, raw = tmp_path / "in", str(tmp_path / "raw")
    landing.mkdir()
    (landing / "A_1d.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-01,1,1,1,1,1\nbad,1,1,1,1,1\n")
    from barlake.sources.landing import read_landing

    store.write_raw(clean.clean_landing(read_landing(spark, str(landing))), raw, "b")
    assert clean.rejects_of(store.read_raw(spark, raw)).count() == 1
    (landing / "A_1d.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-02,1,1,1,1,1\n")
    store.write_raw(clean.clean_landing(read_landing(spark, str(landing))), raw, "b")
    again = store.read_raw(spark, raw, "b")
    assert clean.rejects_of(again).count() == 0
    assert [str(r["ts"]) for r in clean.bars_of(again).collect()] == ["2024-01-02 00:00:00"]


def test_master_grows_once_per_batch(spark, bars_of_rows, tmp_path):
    master, delta = str(tmp_path / "master"), str(tmp_path / "delta")
    first = bars_of_rows([bar("A", "1d", "2024-01-01", 1.0, 0), bar("A", "1d", "2024-01-01", 2.0, 1)])
    second = bars_of_rows(
        [bar("A", "1d", "2024-01-01", 3.0, 0), bar("A", "1d", "2023-12-31", 4.0, 1), bar("B", "5m", None, 5.0, 2)]
    )
    store.merge_into_master(first, master, delta, "b1")
    store.merge_into_master(second, master, delta, "b2")
    want = [("A", "1d", datetime(2023, 12, 31), 4.0), ("A", "1d", datetime(2024, 1, 1), 1.0)]
    columns = ["ticker", "timeframe", "ts", "close"]
    assert as_sorted(lake.read_bars(spark, master), *columns) == want
    for batch, name in ((second, "b2"), (first, "b1")):
        store.merge_into_master(batch, master, delta, name)
        assert as_sorted(lake.read_bars(spark, master), *columns) == want
    assert [r["close"] for r in store.read_delta(spark, delta, "b2").collect()] == [4.0]
    assert store.read_delta(spark, delta, "b9").count() == 0


@pytest.mark.parametrize("name", ["2024-06-01T10:00:00", "a/b", "x=1%", "né e?"])
def test_any_batch_id_is_read_back(spark, bars_of_rows, tmp_path, name):
    master, delta = str(tmp_path / "master"), str(tmp_path / "delta")
    batch = bars_of_rows([bar("A", "1d", "2024-01-01", 1.0, 0), bar("B", "1d", "2024-01-01", 2.0, 1)])
    store.merge_into_master(batch, master, delta, name)
    assert lake.read_bars(spark, master).count() == 2 == store.read_delta(spark, delta, name).count()
    with pytest.raises(ValueError):
        store.write_delta(batch, delta, "")


def test_append_lost_after_the_delta_is_repeated(spark, bars_of_rows, tmp_path):
    master, delta = str(tmp_path / "master"), str(tmp_path / "delta")
    batch = bars_of_rows([bar("A", "1d", "2024-01-01", 1.0, 0)])
    store.write_delta(batch, delta, "b1")  # the job ended before the append
    store.merge_into_master(batch, master, delta, "b1")
    assert lake.read_bars(spark, master).count() == 1


def test_empty_batch_writes_nothing(spark, bars_of_rows, tmp_path):
    store.merge_into_master(bars_of_rows([]), str(tmp_path / "m"), str(tmp_path / "d"), "b")
    assert lake.read_bars_or_empty(spark, str(tmp_path / "m")).count() == 0


def test_bar_size_is_not_read_as_a_number(spark, bars_of_rows, tmp_path):
    path = str(tmp_path / "daily")
    bars = bars_of_rows([bar("A", "1d", "2024-01-01"), bar("A", "5m", "2024-01-01")])
    store.copy_daily(bars, path)
    store.copy_daily(bars, path)
    assert as_sorted(lake.read_bars(spark, path), "ticker", "timeframe") == [("A", "1d")]


def test_snapshot_needs_a_new_path(spark, bars_of_rows, tmp_path):
    bars = bars_of_rows([bar("A", "1d", "2024-01-02"), bar("A", "1d", "2024-01-01", float("nan"))])
    store.write_snapshot(bars, str(tmp_path / "s"))
    assert [r["close"] for r in lake.read_bars(spark, str(tmp_path / "s")).orderBy("ts").collect()] == [None, 1.0]
    with pytest.raises(Exception, match="(?i)exist"):
        store.write_snapshot(bars, str(tmp_path / "s"))


def test_quality_tables_are_stored(spark, bars_of_rows, tmp_path):
    bars = bars_of_rows([bar("A", "1d", "2024-01-01"), bar("A", "1d", "2024-01-09", volume=0.0, seq=1)])
    tables = store.write_quality(bars, str(tmp_path), "r1")
    table = lambda name: store.read_report(spark, str(tmp_path), name, "r1")
    assert table("issues").count() == 2 == tables.issues.count()
    assert table("results").first()["status"] == "ISSUES"
    assert table("stats").first()["anomalies_detected"] == 2
    # A run that is repeated replaces its tables, also by empty ones.
    store.write_quality(bars.limit(0), str(tmp_path), "r1")
    assert table("issues").count() == 0 == table("stats").count()
