"""Every registered query against its SQL counterpart, and the shape of the plans."""

import re
from datetime import datetime

import pytest

import __spark_entry__ as driver
from barlake.catalog import oracles
from barlake.catalog import queries as catalog
from barlake.session import use_utc
from tests.oracle import both, connect

QUERIES = dict(catalog.REGISTRY)
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(small_sf):
    return connect(small_sf)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, small_sf, name):
    got, want, columns, sql_columns = both(QUERIES[name](use_utc(spark), small_sf), con, SQL[name])
    assert columns == sql_columns
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).count() == 10


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.__module__ != "barlake.catalog.stored"))
def test_no_query_pairs_all_rows(spark, small_sf, name):
    plan = plan_of(QUERIES[name](spark, small_sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_row_counters_read_only_what_they_need(spark, small_sf):
    plan = plan_of(QUERIES["dq_volume"](spark, small_sf))
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert re.search(r"ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>", plan)


def test_watermark_reaches_the_scan(spark, tmp_path, bars_of_rows):
    from barlake.operators.filters import newer_than
    from barlake.plans.publish import new_for_target
    from barlake.sinks.store import append_bars
    from barlake.sources.lake import read_bars
    from tests.conftest import bar

    path = str(tmp_path / "m")
    append_bars(bars_of_rows([bar("A", "1d", "2024-01-01"), bar("A", "1d", "2024-01-02")]), path)
    bars = read_bars(spark, path)
    assert "GreaterThan(ts," in plan_of(new_for_target(bars, bars, "ts"))
    assert newer_than(bars, bars).count() == 0
    in_year = plan_of(read_bars(spark, path, datetime(2024, 1, 2), datetime(2024, 1, 2)))
    assert "(bar_year#" in in_year and "GreaterThanOrEqual(ts," in in_year
    only_daily = plan_of(bars.where("timeframe = '1d'").select("close"))
    assert "PartitionFilters: [isnotnull(timeframe" in only_daily and "ReadSchema: struct<close:double>" in only_daily


def test_outliers_shuffle_the_bars_once(spark, oracle_sf):
    from barlake.catalog.views import bars_dirty
    from barlake.operators.returns import outlier_counts

    df = outlier_counts(bars_dirty(spark, oracle_sf), series_small=True)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    by_block = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line]
    assert sum("ReusedExchange" not in line for line in by_block) == 1 and len(by_block) == 3
