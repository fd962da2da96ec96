import pytest
from pyspark.sql import functions as F

from barlake.operators import keyed, lookup
from barlake.schema import SERIES
from tests.conftest import as_sorted, bar


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_and_broadcast_lookup_agree(spark, how):
    rows = spark.range(500).select(F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 7) END AS k"), "id")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k9", 3)], "k string, v int")
    wide = lookup.attach(rows, small, ["k"], how, small_fits=True)
    salted = lookup.attach(rows, small, ["k"], how, small_fits=False, salts=5)
    assert wide.columns == salted.columns
    assert as_sorted(wide, *wide.columns) == as_sorted(salted, *salted.columns)
    counted = lookup.attach(rows, small, ["k"], how)
    assert counted.count() == wide.count()


def test_lookup_refuses_joins_that_add_rows(spark):
    with pytest.raises(ValueError):
        lookup.attach(spark.range(1), spark.range(1), ["id"], "full")


def test_size_check(spark, bars_of_rows):
    assert lookup.fits_broadcast(spark.range(10), 10)
    assert not lookup.fits_broadcast(spark.range(11), 10)
    assert lookup.series_fit(bars_of_rows([bar("A", "1d", None), bar("A", "1d", None, seq=1)]), 1)


def columns(df):
    return as_sorted(df, "ticker", "timeframe", "ts", "close", "seq")


def sample(bars_of_rows):
    master = bars_of_rows(
        [
            bar("A", "1d", "2024-01-01", 1.0, 0),
            bar("A", "1d", "2024-01-01", 9.0, 1),
            bar("B", "1d", "2024-01-01", 2.0, 2),
        ]
    )
    batch = bars_of_rows(
        [
            bar("A", "1d", "2024-01-01", 5.0, 0),
            bar("A", "1d", "2024-01-02", 6.0, 5),
            bar("A", "1d", "2024-01-02", None, 3),
            bar("C", "1d", "2024-01-01", 7.0, 4),
            bar("C", "1d", "2024-01-01", 8.0, 6),
        ]
    )
    return master, batch


@pytest.mark.parametrize("small", [True, False, None])
def test_new_rows_keep_copies(bars_of_rows, small):
    master, batch = sample(bars_of_rows)
    got = [(r["ticker"], r["close"]) for r in keyed.new_rows(batch, master, small).collect()]
    assert sorted(got, key=str) == [("A", 6.0), ("A", None), ("C", 7.0), ("C", 8.0)]


@pytest.mark.parametrize("small", [True, False, None])
def test_new_keyed_rows_keep_the_first_even_if_its_close_is_missing(bars_of_rows, small):
    master, batch = sample(bars_of_rows)
    got = [(r["ticker"], r["close"], r["seq"]) for r in keyed.new_keyed_rows(batch, master, batch_small=small).collect()]
    assert sorted(got) == [("A", None, 3), ("C", 7.0, 4)]


@pytest.mark.parametrize("small", [True, False])
def test_known_keys(bars_of_rows, small):
    master, batch = sample(bars_of_rows)
    assert [(r["ticker"], str(r["ts"])) for r in keyed.known_keys(batch, master, small).collect()] == [
        ("A", "2024-01-01 00:00:00")
    ]


def test_one_per_key(bars_of_rows):
    master, _ = sample(bars_of_rows)
    assert sorted(r["close"] for r in keyed.one_per_key(master).collect()) == [1.0, 2.0]
    assert sorted(r["close"] for r in keyed.one_per_key(master, "last").collect()) == [2.0, 9.0]
    with pytest.raises(ValueError):
        keyed.one_per_key(master, "any")


def test_conflicts_and_rows_without_time_are_skipped(bars_of_rows):
    master, batch = sample(bars_of_rows)
    untimed = bars_of_rows([bar("A", "1d", None, 1.0, 9)])
    assert columns(keyed.skip_conflicts(batch.unionByName(untimed), master)) == columns(
        keyed.new_keyed_rows(batch, master)
    )
    assert keyed.series_of(master).columns == SERIES
