"""Bucketed targets: a batch comes to the stored rows, which are never shuffled."""

import uuid

import pytest

from barlake.operators import keyed
from barlake.sinks import bucketed
from tests.conftest import as_sorted, bar

COLUMNS = ["ticker", "timeframe", "ts", "close"]


@pytest.fixture()
def table(spark, tmp_path):
    name = f"bucketed_{uuid.uuid4().hex}"
    yield name, str(tmp_path / name)
    for one in (name, f"{name}{bucketed.MARKS}"):
        spark.sql(f"DROP TABLE IF EXISTS {one}")


def days(ticker, first, n, close=1.0):
    return [bar(ticker, "1d", f"2024-01-{first + d:02d}", close + d, d) for d in range(n)]


def exchanges_below(plan, scan):
    """Exchanges between a scan of the table and the join above it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and scan in line)
    depth, found = lines[at].index("FileScan"), 0
    for line in reversed(lines[:at]):
        name = line.lstrip(" :+-")
        if line.index(name) < depth:  # the operator above
            depth = line.index(name)
            if "Join" in name.split(" ")[0]:
                return found
            found += name.startswith("Exchange")
    return found


def test_only_the_batch_moves(spark, table, bars_of_rows):
    name, path = table
    bucketed.append_bucketed(bars_of_rows(days("A", 1, 9) + days("B", 1, 4)), name, path, 4)
    batch = bars_of_rows(days("A", 5, 9, 50.0) + days("A", 5, 2, 70.0) + days("C", 1, 2) + [bar("A", "1d", None, 1.0)])
    new = bucketed.skip_stored_conflicts(batch, spark.table(name))
    assert as_sorted(new, *COLUMNS) == as_sorted(keyed.skip_conflicts(batch, spark.table(name)), *COLUMNS)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert exchanges_below(plan, "SelectedBucketsCount") == 0
    assert plan.count("Exchange hashpartitioning") == 1


def test_two_stored_tables_meet_without_an_exchange(spark, table, bars_of_rows):
    name, path = table
    bucketed.append_bucketed(bars_of_rows(days("A", 1, 9)), name, path, 4)
    other = f"{name}_batch"
    bucketed.append_bucketed(bars_of_rows(days("A", 5, 9, 50.0)), other, f"{path}_batch", 4)
    met = bucketed.unknown_rows(spark.table(other), spark.table(name))
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    assert as_sorted(met, "close") == [(50.0 + d,) for d in range(5, 9)]
    spark.sql(f"DROP TABLE {other}")
    spark.sql(f"DROP TABLE {other}{bucketed.MARKS}")


@pytest.mark.parametrize("scope, want", [("global", 5), ("series", 8)])
def test_publish_behind_the_marks(spark, table, bars_of_rows, scope, want):
    name, path = table
    first = bars_of_rows(days("A", 1, 9) + days("B", 1, 4))
    assert bucketed.publish_bucketed(first, name, path, scope, 4) == 13
    batch = bars_of_rows(days("A", 5, 9, 50.0) + days("A", 12, 2, 70.0) + days("B", 3, 5, 9.0) + days("C", 10, 1))
    expected = {(r["ticker"], str(r["ts"])) for r in bucketed.newer_than_marks(batch, name, scope).collect()}
    assert bucketed.publish_bucketed(batch, name, path, scope, 4) == want == len(expected)
    assert bucketed.publish_bucketed(batch, name, path, scope, 4) == 0
    assert spark.table(name).count() == 13 + want
    assert as_sorted(bucketed.series_marks(spark, name), "ticker", "timeframe")[0] == ("A", "1d")


def test_empty_batch_and_unknown_scope(spark, table, bars_of_rows):
    name, path = table
    bucketed.publish_bucketed(bars_of_rows([]), name, path, "global", 2)
    assert spark.table(name).count() == 0
    bucketed.publish_bucketed(bars_of_rows(days("A", 1, 2)), name, path, "series", 2)
    assert spark.table(name).count() == 2
    with pytest.raises(ValueError):
        bucketed.newer_than_marks(bars_of_rows([]), name, "x")
