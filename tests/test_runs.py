"""The full run and the file stream."""

import pytest

from barlake.plans import quality, workflow
from barlake.plans.publish import Target
from barlake.sinks.store import read_report
from barlake.sources.lake import read_bars
from barlake.sources.landing import read_landing
from barlake.streaming.ingest import stream_landing
from tests.conftest import as_sorted


def write_landing(folder, first_day, n_files=3):
    folder.mkdir(exist_ok=True)
    for i in range(n_files):
        daily = "\n".join(f"2024-01-{first_day + d:02d},{d + 1},{d + 2},{d},{d + 1},10" for d in range(5))
        intraday = "\n".join(f"2024-01-{first_day:02d} 10:{m:02d}:00-05:00,{m + 1},{m + 2},{m},{m + 1},10" for m in range(0, 30, 5))
        (folder / f"T{i}_1d.csv").write_text("Date,Close,High,Low,Open,Volume\n" + daily + "\n")
        (folder / f"T{i}_5m.csv").write_text("Datetime,Close,High,Low,Open,Volume\n" + intraday + "\n")


def outcome(df):
    return [(r["step"], r["ok"], r["detail"].split(":")[0]) for r in df.collect()]


def test_full_run(spark, tmp_path):
    write_landing(tmp_path / "in", 1)
    lake = workflow.Lake(f"{tmp_path}/lake")
    targets = [Target.at(f"{tmp_path}/{n}") for n in ("daily", "intraday", "all")]
    switches = workflow.Switches(split_publish=True, combined_publish=True)
    lines = read_landing(spark, f"{tmp_path}/in")
    for batch in ("b1", "b2"):
        steps = workflow.run_lake(lines, lake, batch, *targets, switches=switches)
        assert outcome(steps) == [(s, True, "done") for s in workflow.STEPS]
        assert read_bars(spark, lake.master).count() == 33
        assert [t.read(spark).count() for t in targets] == [15, 18, 33]
        assert read_report(spark, lake.reports, "results", batch).count() == 6
    assert spark.read.parquet(f"{lake.reports}/results").select("run_id").distinct().count() == 2


def fail():
    raise RuntimeError("boom")


def test_failed_collection_stops_the_run(spark):
    ran = []
    steps = workflow.run_steps(spark, fail, lambda: ran.append(1), fail, fail)
    assert outcome(steps) == [
        ("data_collection", False, "failed"),
        ("quality_checks", False, "not run"),
        ("split_publish", False, "not run"),
        ("combined_publish", False, "not run"),
    ]
    assert not ran


def test_later_failures_are_reported_but_tolerated(spark):
    switches = workflow.Switches(quality=True, split_publish=True)
    steps = workflow.run_steps(spark, lambda: None, fail, lambda: None, fail, switches)
    assert outcome(steps) == [
        ("data_collection", True, "done"),
        ("quality_checks", True, "failed"),
        ("split_publish", True, "done"),
        ("combined_publish", True, "disabled"),
    ]


def test_refresh_plan(spark, tmp_path):
    lake = workflow.Lake(f"{tmp_path}/lake")
    tickers = spark.createDataFrame([("T0",), ("T1",), ("T9",)], "ticker string")
    # nothing stored: daily bars are missing, absent intraday bars count as fresh
    assert workflow.refresh_plan(lake, tickers, "2024-01-05 10:00:00").count() == 3
    assert workflow.refresh_plan(lake, tickers, "2024-01-05 10:00:00", expect_all=True).count() == 21
    write_landing(tmp_path / "in", 1)
    workflow.collect_landing(read_landing(spark, f"{tmp_path}/in"), lake, "b1")
    assert workflow.refresh_plan(lake, tickers, "2024-01-01 20:00:00").count() == 3
    assert as_sorted(workflow.refresh_plan(lake, tickers, "2024-01-05 10:00:00", only_stale=True), "ticker", "timeframe") == [
        ("T0", "5m"),
        ("T1", "5m"),
        ("T9", "1d"),
    ]
    two = spark.createDataFrame([("T0",), ("T1",)], "ticker string")
    assert workflow.refresh_plan(lake, two, "2024-01-01 20:00:00").count() == 0


def test_odd_batch_id_and_far_year(spark, tmp_path):
    write_landing(tmp_path / "in", 1)
    (tmp_path / "in" / "FAR_1d.csv").write_text("Date,Close,High,Low,Open,Volume\n20251-10-01,1,1,1,1,1\n2024-01-01,1,1,1,1,1\n")
    (tmp_path / "in" / "LESS_1d.csv").write_text("Date,Close,High,Low,Open\n2024-01-01,1,1,1,1\n")
    lake = workflow.Lake(f"{tmp_path}/lake")
    steps = workflow.run_lake(read_landing(spark, f"{tmp_path}/in"), lake, "2024-06-01T10:00:00")
    assert [r["ok"] for r in steps.collect()] == [True] * 4
    assert read_bars(spark, lake.master).count() == 34
    assert read_bars(spark, lake.master).where("ticker = 'LESS'").count() == 0
    stats = read_report(spark, lake.reports, "stats", "2024-06-01T10:00:00").first()
    assert stats["total_files"] == 8  # seven series, and the file that lacks a column
    errors = read_report(spark, lake.reports, "issues", "2024-06-01T10:00:00").where("type = 'processing_error'").collect()
    assert [(r["ticker"], r["message"]) for r in errors] == [("LESS_1d", "missing_column")]
    # Once the file is mended it is no error any more, though its old lines stay in the raw store.
    (tmp_path / "in" / "LESS_1d.csv").write_text("Date,Close,High,Low,Open,Volume\n2024-01-01,1,1,1,1,1\n")
    workflow.run_lake(read_landing(spark, f"{tmp_path}/in"), lake, "mended/2")
    assert read_report(spark, lake.reports, "issues", "mended/2").where("type = 'processing_error'").count() == 0
    assert read_bars(spark, lake.master).where("ticker = 'LESS'").count() == 1


def test_refresh_asks_once_per_plan_row(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def fetcher(ticker, timeframe, period):
        import uuid

        import pandas as pd

        (calls / f"{ticker}_{timeframe}_{uuid.uuid4().hex}").touch()
        if ticker == "BAD":
            raise TimeoutError("no answer")
        return pd.DataFrame({"t": ["2024-01-02"], "Close": [1.0], "High": 2, "Low": 1, "Open": 1, "Volume": 5})

    lake = workflow.Lake(f"{tmp_path}/lake")
    target = Target.at(f"{tmp_path}/all")
    (tmp_path / "all").mkdir()
    tickers = spark.createDataFrame([("A",), ("BAD",)], "ticker string")
    switches = workflow.Switches(combined_publish=True)
    run = lambda batch, **more: workflow.refresh_lake(
        tickers, fetcher, lake, batch, "2024-01-03 00:00:00", combined_target=target, switches=switches, **more
    )
    assert outcome(run("r/1")) == [
        ("data_collection", True, "done"), ("quality_checks", True, "done"),
        ("split_publish", True, "disabled"), ("combined_publish", True, "done"),
    ]
    assert sorted(p.name.rsplit("_", 1)[0] for p in calls.iterdir()) == ["A_1d", "BAD_1d"]
    assert read_bars(spark, lake.master).count() == 1 == target.read(spark).count()
    issues = read_report(spark, lake.reports, "issues", "r/1").select("ticker", "timeframe", "type").collect()
    assert [tuple(r) for r in issues] == [("BAD", "1d", "empty_data")]  # asked for, but there is no bar and no file
    assert read_report(spark, lake.reports, "stats", "r/1").first()["total_files"] == 2
    assert [r["run_id"] for r in spark.read.parquet(f"{lake.reports}/stats").collect()] == ["r/1"]
    broken = workflow.unreadable_series(spark, lake, "r/1")
    assert [tuple(r) for r in broken.collect()] == [("BAD", "1d")]
    plan = workflow.refresh_plan(lake, tickers, "2024-01-03 00:00:00", only_stale=True, unreadable=broken)
    assert as_sorted(plan, "ticker", "timeframe") == [("BAD", "1d")]


def test_bars_without_a_value_are_listed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "A_1d.csv").write_text("Date,Close,High,Low,Open,Volume\n2024-01-01,1,1,1,1,\n2024-01-02,1,1,1,1,1\n")
    lake = workflow.Lake(f"{tmp_path}/lake")
    workflow.collect_landing(read_landing(spark, f"{tmp_path}/in"), lake, "b")
    listed = spark.read.parquet(lake.missing).collect()
    assert [(r["source_file"], str(r["ts"])[:10], r["volume"], r["batch_id"]) for r in listed] == [("A_1d.csv", "2024-01-01", None, "b")]


def test_ids_that_look_alike_stay_apart(spark, tmp_path):
    import pandas as pd

    lake = workflow.Lake(f"{tmp_path}/lake")
    tickers = spark.createDataFrame([("A",)], "ticker string")
    for day, batch in ((2, "a/b"), (3, "a_2Fb"), (4, "a%2Fb")):
        answer = lambda t, f, p, day=day: pd.DataFrame({"t": [f"2024-01-0{day}"], "Close": [float(day)], "High": 2, "Low": 1, "Open": 1, "Volume": 5})
        workflow.refresh_lake(tickers, answer, lake, batch, "2024-03-01 00:00:00")
    assert sorted(r["close"] for r in read_bars(spark, lake.master).collect()) == [2.0, 3.0, 4.0]
    assert spark.read.parquet(lake.fetched).select("batch_id").distinct().count() == 3
    steps = workflow.refresh_lake(tickers, answer, lake, None, "2024-03-01 10:00:00")
    assert all(r["ok"] for r in steps.collect())
    assert read_report(spark, lake.reports, "results", "20240301_100000").count() == 1


def test_quality_state_takes_in_every_delta(spark, tmp_path):
    """Batches merged without a check, by a stream or again, are in the next report."""
    lake = workflow.Lake(f"{tmp_path}/lake")
    for k, folder in enumerate(("in", "in2", "in3")):
        write_landing(tmp_path / folder, 1 + 8 * k, 2)
        workflow.collect_landing(read_landing(spark, f"{tmp_path}/{folder}"), lake, folder)
        if k != 1:
            workflow.check_master(spark, lake, f"r{k}")
            got = read_report(spark, lake.reports, "counters", f"r{k}").drop("run_id")
            want = quality.quality_counters(read_bars(spark, lake.master)).select(*got.columns)
            assert as_sorted(got, *got.columns) == as_sorted(want, *got.columns)
    query = stream_landing(spark, f"{tmp_path}/in", lake, f"{tmp_path}/check")
    query.awaitTermination(180)
    workflow.check_master(spark, lake, "again")
    assert as_sorted(read_report(spark, lake.reports, "counters", "again").drop("run_id"), *got.columns) == as_sorted(got, *got.columns)


def test_stream_then_batch_then_report(spark, tmp_path):
    write_landing(tmp_path / "in", 1, 1)
    lake = workflow.Lake(f"{tmp_path}/lake")
    query = stream_landing(spark, f"{tmp_path}/in", lake, f"{tmp_path}/check")
    query.awaitTermination(180)
    write_landing(tmp_path / "in2", 10, 1)
    steps = workflow.run_lake(read_landing(spark, f"{tmp_path}/in2"), lake, "b1")
    assert [(r["ok"], r["detail"]) for r in steps.collect()][:2] == [(True, "done")] * 2
    assert read_bars(spark, lake.master).count() == 22
    assert read_report(spark, lake.reports, "results", "b1").count() == 2


@pytest.mark.parametrize("files_per_batch", [2, 100])
def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, files_per_batch):
    streamed, batched = workflow.Lake(f"{tmp_path}/s"), workflow.Lake(f"{tmp_path}/b")
    landing = tmp_path / "in"
    write_landing(landing, 1, 4)

    def run():
        query = stream_landing(spark, str(landing), streamed, f"{tmp_path}/check", max_files_per_trigger=files_per_batch)
        query.awaitTermination(180)
        assert query.exception() is None

    run()
    workflow.collect_landing(read_landing(spark, str(landing)), batched, "b1")
    key = ["ticker", "timeframe", "ts", "close"]
    first = as_sorted(read_bars(spark, streamed.master), *key)
    assert first == as_sorted(read_bars(spark, batched.master), *key) and len(first) == 44
    run()
    assert read_bars(spark, streamed.master).count() == 44
    late = {"T0_late_1d.csv": "2023-12-01,1,1,1,1,1\n2024-01-01,9,9,9,9,9", "NEW_1d.csv": "2024-01-01,1,1,1,1,1"}
    for name, text in late.items():
        (landing / name).write_text("Date,Close,High,Low,Open,Volume\n" + text + "\n")
    run()
    master = read_bars(spark, streamed.master)
    assert master.count() == 46
    assert as_sorted(master.where("ticker = 'NEW' OR ts < '2024-01-01'"), "ticker", "close") == [("NEW", 1.0), ("T0", 1.0)]
