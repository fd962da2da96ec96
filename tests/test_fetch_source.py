"""A fetch plan read through ``spark.read.format``."""

import pandas as pd
import pytest

from barlake.catalog import queries
from barlake.sources import datasource, fetch, universe
from tests.conftest import as_sorted


def logging_vendor(folder, failures=0):
    """Answers after some failures for each ticker, and leaves one file for each call."""

    def fetcher(ticker, timeframe, period):
        import os
        import uuid

        own = f"{ticker}_{timeframe}_{period}"
        before = len([f for f in os.listdir(folder) if f.startswith(own + ".")])
        open(f"{folder}/{own}.{uuid.uuid4().hex}", "w").close()
        if ticker == "NEVER" or before < failures:
            raise TimeoutError("too slow")
        if ticker == "NONE":
            return pd.DataFrame()
        return pd.DataFrame({"index": ["2024-01-02 09:30:00-05:00"] * 2, "Close": [1.0, 2.0], "High": 2, "Low": 1, "Open": 1, "Volume": 5})

    return fetcher


@pytest.fixture()
def plan(spark):
    tickers = spark.createDataFrame([("NEVER",), ("NONE",), ("AAPL",), ("MSFT",)], "ticker string")
    return universe.fetch_plan(tickers, ["5m"], with_daily=False)


def test_one_call_for_each_plan_row(spark, plan, tmp_path):
    datasource.register_fetch_source(spark, plan, logging_vendor(str(tmp_path)), "test_bars")
    read = spark.read.format("test_bars").option("retries", 0).load()
    assert read.rdd.getNumPartitions() == 4
    rows = read.collect()
    assert len(list(tmp_path.iterdir())) == 4
    assert as_sorted(fetch.fetch_errors(spark.createDataFrame(rows, read.schema)), "ticker", "line") == [("NEVER", "TimeoutError: too slow")]
    want = fetch.fetch(plan, logging_vendor(str(tmp_path)), tasks=2).collect()
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_failures_are_asked_again(spark, plan, tmp_path):
    datasource.register_fetch_source(spark, plan, logging_vendor(str(tmp_path), failures=2), "flaky_bars")
    read = spark.read.format("flaky_bars").options(retries=2, wait=0, rowsPerPartition=3).load()
    assert read.rdd.getNumPartitions() == 2
    rows = read.collect()
    assert sorted(r["ticker"] for r in rows if r["error"] is None) == ["AAPL"] * 2 + ["MSFT"] * 2
    assert [r["ticker"] for r in rows if r["error"]] == ["NEVER"]
    assert len(list(tmp_path.iterdir())) == 12


def test_limits(spark, plan, tmp_path, monkeypatch):
    datasource.register_fetch_source(spark, plan.limit(0), logging_vendor(str(tmp_path)), "no_bars")
    assert spark.read.format("no_bars").load().count() == 0
    monkeypatch.setattr(datasource, "MAX_PLAN_ROWS", 2)
    with pytest.raises(ValueError, match="more than 2 rows"):
        datasource.register_fetch_source(spark, plan, logging_vendor(str(tmp_path)))
    datasource.register_fetch_source(spark, plan.limit(2), logging_vendor(str(tmp_path)), "few_bars")
    with pytest.raises(Exception, match="rowsPerPartition"):
        spark.read.format("few_bars").option("rowsPerPartition", 0).load().collect()


def test_a_stored_plan_may_have_any_size(spark, tmp_path, monkeypatch):
    """A plan above the limit goes by way of a folder; every row is asked for once, null ones too."""
    monkeypatch.setattr(datasource, "MAX_PLAN_ROWS", 10)
    monkeypatch.setattr(datasource, "ROWS_PER_FILE", 4)
    calls = tmp_path / "calls"
    calls.mkdir()
    tickers = spark.createDataFrame([(t,) for t in ["NEVER", "NONE", None, "A", "A", *(f"T{i}" for i in range(18))]], "ticker string")
    plan = universe.fetch_plan(tickers, ["5m"], with_daily=False).repartition(2)
    datasource.register_fetch_source(spark, plan, logging_vendor(str(calls)), "many_bars", str(tmp_path / "a plan % é"))
    for options, partitions in (({}, 8), ({"rowsPerPartition": 7}, 4), ({"rowsPerPartition": 1}, 23)):
        read = spark.read.format("many_bars").options(retries=0, **options).load()
        assert read.rdd.getNumPartitions() == partitions
    rows = read.collect()
    assert len(list(calls.iterdir())) == 23
    want = fetch.fetch(plan, logging_vendor(str(calls)), tasks=2).collect()
    assert sorted(map(str, rows)) == sorted(map(str, want)) and len(rows) == 43
    datasource.register_fetch_source(spark, plan.limit(0), logging_vendor(str(calls)), "none_stored", str(tmp_path / "none"))
    assert spark.read.format("none_stored").load().count() == 0


def test_the_registered_query_takes_more_than_the_limit(spark, small_sf, monkeypatch):
    monkeypatch.setattr(datasource, "MAX_PLAN_ROWS", 10)
    rows, want = (queries.REGISTRY[name](spark, small_sf).collect() for name in ("fetch_as_source", "pluggable_fetch"))
    assert sorted(map(str, rows)) == sorted(map(str, want)) and len(rows) > 100
