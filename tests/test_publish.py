from datetime import datetime

import pytest

from barlake.operators import filters
from barlake.plans.publish import Target, publish_combined, publish_split
from tests.conftest import as_sorted, bar


@pytest.fixture()
def bars(bars_of_rows):
    return bars_of_rows(
        [
            bar("A", "1d", "2024-01-01", 1.0, 0, volume=7.9),
            bar("A", "1d", "2024-01-02", 2.0, 1),
            bar("A", "5m", "2024-01-01 10:00:00", 3.0, 2),
            bar("A", "5m", "2024-01-01 10:00:00", 4.0, 3),
        ]
    )


def test_split_publish_appends_only_what_is_newer(spark, bars, bars_of_rows, tmp_path):
    daily, intraday = Target.at(f"{tmp_path}/daily"), Target.at(f"{tmp_path}/intraday")
    assert publish_split(bars, daily, intraday) == {"daily": True, "intraday": True}
    assert publish_split(bars, daily, intraday) == {"daily": False, "intraday": False}
    late_and_new = bars.unionByName(
        bars_of_rows([bar("B", "1d", "2023-12-01", 9.0, 4), bar("B", "1d", "2024-01-03", 8.0, 5)])
    )
    assert publish_split(late_and_new, daily, None) == {"daily": True, "intraday": False}
    published = daily.read(spark)
    assert published.columns == ["Date", "Ticker", "Timeframe", "Open", "High", "Low", "Close", "Volume"]
    assert dict(published.dtypes)["Date"] == "timestamp" and dict(published.dtypes)["Volume"] == "bigint"
    assert sorted((r["Close"], r["Volume"]) for r in published.collect()) == [(1.0, 7), (2.0, 1), (8.0, 1)]
    assert intraday.read(spark).count() == 2


def test_series_scope_publishes_late_series(spark, bars, bars_of_rows, tmp_path):
    target = Target.at(f"{tmp_path}/daily")
    publish_split(bars, target, None)
    more = bars.unionByName(bars_of_rows([bar("B", "1d", "2023-12-01", 9.0, 4), bar("A", "1d", "2023-12-01", 5.0, 5)]))
    publish_split(more, target, None, scope="series")
    assert sorted(r["Close"] for r in target.read(spark).collect()) == [1.0, 2.0, 9.0]


def test_combined_publish_ignores_conflicts_and_is_idempotent(spark, bars, bars_of_rows, tmp_path):
    target = Target.at(f"{tmp_path}/all")
    assert publish_combined(bars, target)
    assert not publish_combined(bars, target)
    rows = target.read(spark)
    assert rows.columns == ["ticker", "timeframe", "timestamp", "open", "high", "low", "close", "volume"]
    assert sorted(r["close"] for r in rows.collect()) == [1.0, 2.0, 3.0]
    # one mark over all bar sizes: an intraday time hides the daily bar of the same day
    publish_combined(bars_of_rows([bar("A", "5m", "2024-01-05 10:00:00", 5.0, 0)]), target)
    assert not publish_combined(bars_of_rows([bar("A", "1d", "2024-01-05", 6.0, 0)]), target)


def test_empty_folder_is_a_target(spark, bars, tmp_path):
    (tmp_path / "all").mkdir()
    target = Target.at(f"{tmp_path}/all")
    assert publish_combined(bars, target) and target.read(spark).count() == 3


def test_orc_target(spark, bars, tmp_path):
    target = Target.at(f"{tmp_path}/orc", "orc")
    assert publish_combined(bars, target) and target.read(spark).count() == 3


def test_watermark_of_an_empty_target_passes_everything(bars, bars_of_rows):
    nothing = bars_of_rows([])
    assert filters.newer_than(bars, nothing).count() == 4
    assert filters.newer_than(bars, nothing, scope="series").count() == 4
    with pytest.raises(ValueError):
        filters.newer_than(bars, nothing, scope="day")


def test_watermark_is_strict_and_global(bars, bars_of_rows):
    target = bars_of_rows([bar("Z", "1d", "2024-01-01 10:00:00")])
    assert as_sorted(filters.newer_than(bars, target), "ts") == [(datetime(2024, 1, 2),)]


def test_column_rules():
    assert filters.time_column(["Date", "Datetime"]) == "Date"
    assert filters.time_column(["Datetime"]) == "Datetime"
    with pytest.raises(ValueError):
        filters.time_column(["Close"])
    assert filters.has_columns(["High", "Low"], "High") and not filters.has_columns(["High"], "Low")
