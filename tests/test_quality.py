import os

import pytest
from pyspark.sql import functions as F

from barlake.catalog import views
from barlake.plans import clean, quality
from barlake.sources.landing import read_landing
from tests.conftest import as_sorted, bar

# rows, missing close, duplicates, high < low, close outside, open outside, no volume, outliers, gaps
# of the dirty bars without the week of 10 to 16 January, at sf0.01
EXPECTED = {
    ("click", "1d"): (741, 17, 717, 13, 27, 21, 26, 6, 1),
    ("click", "5m"): (811, 16, 21, 22, 35, 34, 22, 5, 1),
    ("error", "1d"): (757, 13, 733, 16, 29, 29, 20, 12, 1),
    ("error", "5m"): (771, 22, 14, 27, 45, 42, 22, 7, 1),
    ("purchase", "1d"): (724, 15, 700, 23, 41, 34, 17, 9, 1),
    ("purchase", "5m"): (814, 11, 17, 22, 38, 38, 18, 13, 1),
    ("signup", "1d"): (754, 11, 730, 17, 29, 28, 15, 10, 1),
    ("signup", "5m"): (767, 13, 10, 18, 31, 33, 20, 6, 1),
    ("view", "1d"): (801, 10, 777, 14, 33, 26, 28, 13, 1),
    ("view", "5m"): (717, 17, 13, 15, 30, 28, 20, 3, 2),
}
SHOWN = ["records", "n_missing_close", "n_duplicates", "n_high_low", "n_close_out", "n_open_out", "n_no_volume", "n_outliers", "n_gaps"]


def test_known_counters(spark, oracle_sf):
    week = F.expr("CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'")
    kept = views.table(spark, oracle_sf, "events").where(~week).select(F.col("event_id").alias("seq"))
    bars = views.bars_dirty(spark, oracle_sf).join(kept, "seq", "left_semi")
    got = {(r["ticker"], r["timeframe"]): tuple(r[c] for c in SHOWN) for r in quality.quality_counters(bars).collect()}
    assert got == EXPECTED


@pytest.fixture(scope="module")
def tables(bars_of_rows):
    rows = [
        bar("A", "5m", "2024-01-01 00:00:00", None, 0),
        bar("A", "5m", "2024-01-01 00:00:00", 3.0, 1, high=1.0, low=2.0, volume=0.0),
        bar("A", "5m", "2024-01-01 00:05:00", 3.0, 2, open=3.0),
        bar("OK", "1d", "2024-01-01", 1.0, 3),
        bar("OK", "1d", "2024-01-04", 1.0, 4),
    ]
    spark = bars_of_rows(rows).sparkSession
    expected = spark.createDataFrame([("A", "5m"), ("OK", "1d"), ("GONE", "1h")], "ticker string, timeframe string")
    errors = spark.createDataFrame([("BAD_5m.csv", "no_header")], "source_file string, reason string")
    return quality.quality_run(bars_of_rows(rows), expected, errors)


def test_issue_rows(tables):
    assert as_sorted(tables.issues, "ticker", "timeframe", "type", "message", "n") == sorted(
        [
            ("A", "5m", "duplicate_timestamps", "Found 1 duplicate timestamps", 1),
            ("A", "5m", "missing_values", "Missing values: {'Open': 0, 'High': 0, 'Low': 0, 'Close': 1, 'Volume': 0}", 1),
            (
                "A",
                "5m",
                "price_inconsistency",
                "High < Low: 1 rows; Close outside High/Low range: 1 rows; Open outside High/Low range: 1 rows",
                3,
            ),
            ("A", "5m", "volume_anomaly", "Zero or negative volume: 1 rows", 1),
            ("BAD_5m", None, "processing_error", "no_header", 1),
            ("GONE", "1h", "empty_data", "DataFrame is empty", 1),
        ],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_result_rows_and_statistics(tables):
    results = {r["ticker"]: r for r in tables.results.collect()}
    assert {t: (r["records"], r["issues"], r["status"]) for t, r in results.items()} == {
        "A": (3, 4, "ISSUES"),
        "OK": (2, 0, "OK"),
        "GONE": (0, 1, "ISSUES"),
    }
    assert [d["type"] for d in results["A"]["issue_details"]] == [
        "missing_values",
        "duplicate_timestamps",
        "price_inconsistency",
        "volume_anomaly",
    ]
    assert tables.stats.first().asDict() == {
        "total_files": 4,
        "total_records": 5,
        "files_with_issues": 2,
        "anomalies_detected": 5,
    }


def test_metrics_hold_every_count(tables):
    metrics = {r["type"]: r["metrics"] for r in tables.issues.where("ticker = 'A'").collect()}
    assert metrics["price_inconsistency"] == {"n_high_low": 1, "n_close_out": 1, "n_open_out": 1}
    assert metrics["missing_values"]["n_missing_close"] == 1


def test_no_files_no_report(bars_of_rows):
    assert quality.quality_run(bars_of_rows([])).stats.collect() == []


def test_chart_rows_are_in_time_order_with_the_issue_text(bars_of_rows):
    bars = bars_of_rows(
        [bar("A", "1d", "2024-01-09", 2.0, 0), bar("A", "1d", "2024-01-01", 1.0, 1, volume=0.0), bar("B", "1d", "2024-01-01")]
    )
    rows = quality.chart_data(bars, "A", "1d", quality.quality_run(bars).issues).collect()
    assert [r["close"] for r in rows] == [1.0, 2.0]
    assert rows[0]["issue_text"] == (
        "⚠️ volume_anomaly: Zero or negative volume: 1 rows<br>⚠️ time_gaps: Large time gaps detected: 1 gaps > 3 days"
    )


@pytest.mark.skipif("BARLAKE_SAMPLE_DIR" not in os.environ, reason="no sample folder given")
def test_sample_of_90_minute_bars(spark):
    """A folder with one real 90-minute series of 296 bars: six outliers and 59 gaps, nothing else."""
    bars = clean.bars_of(clean.clean_landing(read_landing(spark, os.environ["BARLAKE_SAMPLE_DIR"])))
    tables = quality.quality_run(bars)
    row = tables.counters.first()
    assert (row["records"], row["n_outliers"], row["n_gaps"], row["median_step_us"]) == (296, 6, 59, 5.4e9)
    assert {r["type"] for r in tables.issues.collect()} == {"outlier_detection", "time_gaps"}
