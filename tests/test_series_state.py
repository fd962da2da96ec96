"""Rows and time ranges kept with every append equal those taken from the master."""

from barlake.operators import freshness
from barlake.operators.counters import series_summary
from barlake.plans.workflow import Lake, collect_landing, refresh_plan
from barlake.sinks import series_state, store
from barlake.sources.lake import read_bars
from barlake.sources.landing import read_landing
from tests.conftest import as_sorted, bar

COLUMNS = ["ticker", "timeframe", "records", "first_ts", "latest_ts"]


def batches():
    return {
        "one": [bar("A", "1d", f"2024-01-0{d}", float(d), d) for d in (3, 4, 4)] + [bar("B", "5m", "2024-01-03 00:05:00", 1.0, 9)],
        "t w/o": [bar("A", "1d", f"2024-01-0{d}", float(d), d) for d in (1, 4, 9)] + [bar("C", "5m", "2024-01-03 00:05:00", 1.0, 9)],
        "none new": [bar("A", "1d", "2024-01-09", 5.0, 1)],
        "no time": [bar("Z", "1d", None, 5.0, 1)],
    }


def same(spark, lake):
    rebuilt = as_sorted(series_summary(read_bars(spark, lake.master)), *COLUMNS)
    assert as_sorted(series_state.read_state(spark, lake.state), *COLUMNS) == rebuilt
    return rebuilt


def test_state_follows_every_batch_and_repeats(spark, tmp_path, bars_of_rows):
    lake = Lake(str(tmp_path))
    for name, rows in batches().items():
        for _ in range(2):  # a repeated batch changes nothing
            store.merge_into_master(bars_of_rows(rows), lake.master, lake.delta, name, lake.state)
            found = same(spark, lake)
    assert [(r[0], r[2]) for r in found] == [("A", 4), ("B", 1), ("C", 1)]


def test_master_without_a_state_gets_one(spark, tmp_path, bars_of_rows):
    lake = Lake(str(tmp_path))
    parts = list(batches().items())
    store.merge_into_master(bars_of_rows(parts[0][1]), lake.master, lake.delta, parts[0][0])
    assert not series_state.has_state(spark, lake.state)
    store.merge_into_master(bars_of_rows(parts[1][1]), lake.master, lake.delta, parts[1][0], lake.state)
    same(spark, lake)
    # The same after a failure between the append and the state.
    other = Lake(str(tmp_path / "other"))
    for name, rows in parts[:2]:
        store.merge_into_master(bars_of_rows(rows), other.master, other.delta, name)
    store.merge_into_master(bars_of_rows(parts[1][1]), other.master, other.delta, parts[1][0], other.state)
    same(spark, other)


def test_freshness_reads_the_state_only(spark, tmp_path, bars_of_rows):
    rows = batches()["one"]
    bars, as_of = bars_of_rows(rows), "2024-01-12 00:00:00"
    state = series_summary(bars)
    tickers = spark.createDataFrame([("A",), ("NEW",)], "ticker string")
    for of in (lambda x: freshness.daily_freshness(x, tickers, as_of), lambda x: freshness.intraday_freshness(x, as_of),
               lambda x: freshness.intraday_freshness(x, as_of, tickers=tickers, expect_all=True)):
        assert sorted(map(str, of(state).collect())) == sorted(map(str, of(bars).collect()))
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "A_1d.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-01,1,1,1,1,1\n")
    lake = Lake(str(tmp_path / "lake"))
    collect_landing(read_landing(spark, str(landing)), lake, "b")
    plan = refresh_plan(lake, tickers, as_of, only_stale=True)
    assert lake.master not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryFileIndex" not in plan._jdf.queryExecution().toString() or "/master" not in plan._jdf.queryExecution().toString()
    assert {(r["ticker"], r["timeframe"]) for r in plan.collect()} == {("A", "1d"), ("NEW", "1d")}
