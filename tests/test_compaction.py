"""Small files of a master are put together; readers see either the old files or the new ones."""

from pathlib import Path

import pytest

from barlake.sinks import compaction, store
from barlake.sources.generations import current_folders
from barlake.sources.lake import read_bars
from tests.conftest import as_sorted, bar

COLUMNS = ["ticker", "timeframe", "ts", "close"]


def files(path):
    return len(list(Path(path).rglob("part-*.parquet")))


@pytest.fixture()
def master(spark, tmp_path, bars_of_rows):
    path = str(tmp_path / "master")
    for k in range(6):
        rows = [bar(t, "1d", f"{2023 + d % 2}-01-0{1 + k}", float(k), k) for t in "AB" for d in range(2)]
        store.append_bars(bars_of_rows(rows + [bar("A", "5m", "2024-01-01 00:05:00", 1.0, 9)] * (k == 0)), path)
    return path


def test_bins():
    assert compaction.packed([], 10) == 0
    assert compaction.packed([5, 5, 5, 5], 10) == 2
    assert compaction.packed([6, 6, 4, 4, 30], 10) == 3
    assert compaction.packed([1] * 25, 10) == 3


def test_rows_stay_and_files_go(spark, master, bars_of_rows):
    before = as_sorted(read_bars(spark, master), *COLUMNS)
    planned = read_bars(spark, master)  # a reader that planned before
    many = sum(len(f.sizes) for f in current_folders(spark, master))
    done = compaction.compact(spark, master).collect()
    assert [(r["timeframe"], r["bar_year"], r["generation"], r["files_after"], r["done"]) for r in done] == [
        ("1d", 2023, 1, 1, True), ("1d", 2024, 1, 1, True)
    ]
    assert as_sorted(read_bars(spark, master), *COLUMNS) == before == as_sorted(planned, *COLUMNS)
    assert sum(len(f.sizes) for f in current_folders(spark, master)) == 3 < many
    assert compaction.compact(spark, master).count() == 0
    # Appends go to the new generation, and the next rewrite starts from there.
    store.append_bars(bars_of_rows([bar("C", "1d", "2024-02-01", 7.0, 1), bar("C", "1h", "2024-02-01", 7.0, 1)]), master)
    assert len(read_bars(spark, master).collect()) == len(before) + 2
    assert {(f.timeframe, f.year, f.generation) for f in current_folders(spark, master)} == {
        ("1d", 2023, 1), ("1d", 2024, 1), ("1h", 2024, 0), ("5m", 2024, 0)
    }
    assert compaction.remove_old_generations(spark, master) == 2
    assert files(master) == sum(len(f.sizes) for f in current_folders(spark, master))
    assert len(read_bars(spark, master).collect()) == len(before) + 2


def test_several_files_where_one_is_too_small(spark, master):
    sizes = {f.year: f.sizes for f in current_folders(spark, master) if f.timeframe == "1d"}
    most = 3 * max(sizes[2023])
    before = as_sorted(read_bars(spark, master), *COLUMNS)
    done = compaction.compact(spark, master, target_bytes=most).collect()
    assert all(r["files_after"] == compaction.packed(list(sizes[r["bar_year"]]), most) > 1 for r in done) and len(done) == 2
    assert as_sorted(read_bars(spark, master), *COLUMNS) == before


def test_folder_that_changed_meanwhile_is_left(spark, master, bars_of_rows):
    plan = compaction.compaction_plan(spark, master)
    store.append_bars(bars_of_rows([bar("Z", "1d", "2023-02-01", 7.0, 1)]), master)
    assert [compaction.rewrite(spark, master, item) for item in plan] == [False, True]
    assert as_sorted(read_bars(spark, master).where("ticker = 'Z'"), "close") == [(7.0,)]
    assert not [p for p in Path(master).iterdir() if p.name.startswith(".compaction")]


def test_failed_rewrite_is_not_read(spark, master):
    before = as_sorted(read_bars(spark, master), *COLUMNS)
    read_bars(spark, master).limit(2).write.parquet(f"{master}/.compaction-lost")
    assert as_sorted(read_bars(spark, master), *COLUMNS) == before
    assert compaction.remove_old_generations(spark, master) == 1


def test_merge_after_compaction(spark, master, bars_of_rows, tmp_path):
    compaction.compact(spark, master)
    rows = [bar("A", "1d", "2023-01-01", 99.0, 0), bar("A", "1d", "2023-03-01", 5.0, 1)]
    for _ in range(2):
        store.merge_into_master(bars_of_rows(rows), master, str(tmp_path / "d"), "b", str(tmp_path / "s"))
        assert as_sorted(read_bars(spark, master).where("ticker = 'A' AND year(ts) = 2023 AND close >= 5"), "close") == [(5.0,), (5.0,)]
