"""Keep-first with keyed state: the stream equals the batch form, after restarts, late and repeated files."""

import pytest

from barlake.plans import workflow
from barlake.sinks import series_state
from barlake.sources.lake import read_bars
from barlake.sources.landing import read_landing
from barlake.streaming.keyed import stream_master, stream_raw
from tests.conftest import as_sorted

COLUMNS = ["ticker", "timeframe", "ts", "open", "high", "low", "close", "volume"]
HEAD = "Datetime,Close,High,Low,Open,Volume\n"


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEAD + "\n".join(lines) + "\n")


def both_streams(spark, folder, lake, tmp_path, files=100):
    for start in (
        lambda: stream_raw(spark, str(folder), lake, f"{tmp_path}/check-raw", files),
        lambda: stream_master(spark, lake, f"{tmp_path}/check-master", files),
    ):
        query = start()
        query.awaitTermination(240)
        assert query.exception() is None


def batch_master(spark, folder, tmp_path, name):
    lake = workflow.Lake(f"{tmp_path}/batch-{name}")
    workflow.collect_landing(read_landing(spark, str(folder)), lake, "b")
    return as_sorted(read_bars(spark, lake.master), *COLUMNS)


@pytest.mark.parametrize("files", [1, 100])
def test_stream_equals_batch_after_restarts(spark, tmp_path, files):
    folder, lake = tmp_path / "in", workflow.Lake(f"{tmp_path}/lake")
    minutes = lambda day, n: [f"2024-01-{day:02d} 10:{m:02d}:00-05:00,{m + day},9,0,{m},10" for m in range(n)]
    put(folder, "A_1m.csv", [*minutes(2, 20), *minutes(2, 5), "2024-01-02 10:30:00-05:00,,,,x,1"])
    put(folder, "B_1m.csv", minutes(3, 10))
    both_streams(spark, folder, lake, tmp_path, files)
    assert as_sorted(read_bars(spark, lake.master), *COLUMNS) == batch_master(spark, folder, tmp_path, "one")
    # A restart without files adds nothing; then repeated, late and new bars in new files.
    both_streams(spark, folder, lake, tmp_path, files)
    put(folder, "A_again_1m.csv", [*minutes(2, 25)])
    put(folder, "A_late_1m.csv", ["2023-06-01 10:00:00,5,9,0,1,1", *minutes(1, 3)])
    put(folder, "C_1m.csv", minutes(9, 4))
    both_streams(spark, folder, lake, tmp_path, files)
    got = as_sorted(read_bars(spark, lake.master), *COLUMNS)
    assert len(got) == 21 + 10 + 5 + 4 + 4
    first = {tuple(r[:3]): r for r in got}
    assert len(first) == len(got)
    assert as_sorted(read_bars(spark, lake.master), *COLUMNS[:3]) == [
        r[:3] for r in batch_master(spark, folder, tmp_path, "two")
    ]
    state = as_sorted(series_state.read_state(spark, lake.state), "ticker", "records")
    assert state == [("A", 30), ("B", 10), ("C", 4)]


def test_stream_goes_on_from_a_stored_master(spark, tmp_path):
    folder, lake = tmp_path / "in", workflow.Lake(f"{tmp_path}/lake")
    put(folder, "A_1m.csv", ["2024-01-02 10:00:00,1,9,0,1,1", "2024-01-02 10:01:00,2,9,0,1,1"])
    workflow.collect_landing(read_landing(spark, str(folder)), lake, "b0")
    put(folder, "A_next_1m.csv", ["2024-01-02 10:01:00,7,9,0,1,1", "2024-01-02 10:02:00,3,9,0,1,1"])
    both_streams(spark, folder, lake, tmp_path)
    assert as_sorted(read_bars(spark, lake.master), "close") == [(1.0,), (2.0,), (3.0,)]
