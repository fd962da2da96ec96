import pandas as pd
import pytest

from barlake.plans import merge
from barlake.sources.lake import empty_bars
from tests.conftest import as_sorted, bar

COLUMNS = ["ticker", "timeframe", "ts", "open", "high", "low", "close", "volume", "seq"]


def rows_of(df):
    return as_sorted(df, *COLUMNS)


def direct_merge(master, batch):
    """The per-series rules, one series at a time."""
    out = []
    for key in set(map(tuple, master[["ticker", "timeframe"]].values)) | set(map(tuple, batch[["ticker", "timeframe"]].values)):
        m = master[(master.ticker == key[0]) & (master.timeframe == key[1])]
        b = batch[(batch.ticker == key[0]) & (batch.timeframe == key[1])]
        if m.empty:
            out.append(b)
            continue
        new = b[~b.ts.isin(m.ts)].sort_values("seq")
        if new.empty:
            out.append(m)
        else:
            both = pd.concat([m.sort_values("seq"), new])
            out.append(both[~both.ts.duplicated(keep="first")])
    return pd.concat(out)


def deliveries(n=4):
    """Bars in ``n`` batches over few keys, so that every rule of the merge is met."""
    rows = []
    for i in range(240):
        ticker = ["A", "B", "C", "D"][(i * 7) % 4]
        batch = {"C": 2, "D": 0}.get(ticker, (i * 13) % n)
        rows.append((batch, bar(ticker, "1d" if i % 3 else "5m", f"2024-01-{1 + (i * 11) % 25:02d}", float(i), i)))
    return [[r for b, r in rows if b == k] for k in range(n)]


@pytest.mark.parametrize("series_small", [True, False, None])
def test_exact_form_follows_the_per_series_rules(spark, bars_of_rows, series_small):
    master, direct = empty_bars(spark), pd.DataFrame(columns=COLUMNS)
    for batch in deliveries():
        merged = merge.merge_exact(master, bars_of_rows(batch), series_small).master
        got = rows_of(merged)
        stored = set(zip(direct.ticker, direct.timeframe))
        before = set(direct["seq"])
        direct = direct_merge(direct, pd.DataFrame(batch, columns=COLUMNS))
        added = {r.seq for r in direct.itertuples() if r.seq not in before and (r.ticker, r.timeframe) in stored}
        assert {r["seq"] for r in merge.merge_exact(master, bars_of_rows(batch), series_small).delta.collect()} == added
        assert sorted(r[-1] for r in got) == sorted(direct["seq"])
        master = bars_of_rows(merged.collect())


def test_append_form_never_changes_a_row_and_is_idempotent(spark, bars_of_rows):
    master = empty_bars(spark)
    for batch in deliveries():
        before = rows_of(master)
        merged = merge.merge_append(master, bars_of_rows(batch))
        after = rows_of(merged.master)
        assert set(before) <= set(after)
        assert len({r[:3] for r in after}) == len(after)
        assert len(after) == len(before) + merged.delta.count()
        master = bars_of_rows(merged.master.collect())
        assert merge.merge_append(master, bars_of_rows(batch)).delta.count() == 0


def test_both_forms_agree_when_first_loads_have_unique_keys(spark, bars_of_rows):
    first = merge.merge_append(empty_bars(spark), bars_of_rows(deliveries()[0])).master
    first = bars_of_rows(first.collect())
    batch = bars_of_rows([r for r in deliveries()[1] if r[0] in ("A", "B")])
    assert rows_of(merge.merge_exact(first, batch).master) == rows_of(merge.merge_append(first, batch).master)


def test_replace_lets_revisions_win(bars_of_rows):
    master = bars_of_rows([bar("A", "1d", "2024-01-01", 1.0, 0), bar("A", "1d", "2024-01-02", 2.0, 1)])
    batch = bars_of_rows([bar("A", "1d", "2024-01-02", None, 0), bar("A", "1d", "2024-01-03", 4.0, 1)])
    assert sorted((str(r["ts"])[:10], r["close"]) for r in merge.replace_from(master, batch).collect()) == [
        ("2024-01-01", 1.0),
        ("2024-01-02", None),
        ("2024-01-03", 4.0),
    ]


def test_exact_form_reads_each_side_twice(spark, tmp_path, bars_of_rows):
    first, second = deliveries()[:2]
    for name, rows in (("m", first), ("b", second)):
        bars_of_rows(rows).write.parquet(str(tmp_path / name))
    master, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("m", "b"))
    plan = merge.merge_exact(master, batch, series_small=True).master._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 4 and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_rows_without_values_and_empty_sides(spark, bars_of_rows):
    rows = [bar("A", "1d", "2024-01-01", None, 3), bar("A", "1d", "2024-01-01", 5.0, 4), bar("A", "1d", None, 1.0, 5)]
    assert [r["close"] for r in merge.merge_exact(bars_of_rows(rows[:2]), bars_of_rows([bar("A", "1d", "2024-01-02", 7.0, 0)])).master.orderBy("ts").collect()] == [None, 7.0]
    assert rows_of(merge.merge_exact(empty_bars(spark), bars_of_rows(rows)).master) == rows_of(bars_of_rows(rows[:2]))
    assert rows_of(merge.merge_exact(bars_of_rows(rows[:2]), empty_bars(spark)).master) == rows_of(bars_of_rows(rows[:2]))
