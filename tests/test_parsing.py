from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barlake.functions import parsing, timing


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, number",
    [("1.5", 1.5), (" 2 ", 2.0), ("x", None), ("", None), (None, None), ("NaN", None), ("nan", None), ("5d", None), ("1e3", 1000.0), ("-inf", float("-inf")), (" 5D ", None), ("5f", None)],
)
def test_to_number(spark, text, number):
    assert one(spark, parsing.to_number(F.col("t").cast("string")), t=text) == number


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("2025-10-01 09:30:00-04:00", datetime(2025, 10, 1, 13, 30)),
        ("2025-10-01 09:30:00", datetime(2025, 10, 1, 9, 30)),
        ("2025-10-01T09:30:00Z", datetime(2025, 10, 1, 9, 30)),
        ("2025-10-01", datetime(2025, 10, 1)),
        ("10/01/2025 09:30", datetime(2025, 10, 1, 9, 30)),
        ("Oct 1, 2025", datetime(2025, 10, 1)),
        ("20251001", datetime(2025, 10, 1)),
        ("20251-10-01", None),
        ("13/45/2025", None),
        ("nonsense", None),
        ("10:30", None),
        ("", None),
    ],
)
def test_to_utc_wall_time(spark, text, wanted):
    assert one(spark, parsing.to_utc_wall_time(F.col("t")), t=text) == wanted


@pytest.mark.parametrize(
    "text, wanted",
    [("2025-10-01", date(2025, 10, 1)), ("2025-10-01 00:00:00+02:00", date(2025, 10, 1)), ("2025-10-01 foo", None), ("x", None)],
)
def test_to_bar_date_keeps_the_written_day(spark, text, wanted):
    assert one(spark, parsing.to_bar_date(F.col("t")), t=text) == wanted


@pytest.mark.parametrize(
    "encoded, ticker, timeframe",
    [
        ("%5EGSPC_90m.csv", "^GSPC", "90m"),
        ("CL=F_1d.csv", "CL=F", "1d"),
        ("A+B_5m.csv", "A+B", "5m"),
        ("BRK.A_1h.csv", "BRK.A", "1h"),
        ("BTC-USD_x_15m.csv", "BTC-USD", "15m"),
    ],
)
def test_keys_from_file_name(spark, encoded, ticker, timeframe):
    stem = parsing.file_stem(parsing.decoded_file_name(F.col("n")))
    assert one(spark, F.struct(parsing.ticker_of(stem), parsing.timeframe_of(stem)), n=encoded) == (ticker, timeframe)


@pytest.mark.parametrize(
    "line, cells",
    [
        ("a,b,c", ["a", "b", "c"]),
        ("a,, c ", ["a", "", " c "]),
        (",", ["", ""]),
        ('"1,5",x,"say ""hi"""', ["1,5", "x", 'say "hi"']),
        ("", [""]),
    ],
)
def test_csv_cells(spark, line, cells):
    assert one(spark, parsing.csv_cells(F.col("l")), l=line) == cells


def test_cell_text(spark):
    assert one(spark, F.array(*[parsing.cell_text(F.lit(c)) for c in (" a ", " ", "")]), x=1) == ["a", None, None]


@pytest.mark.parametrize("label, seconds", [("1m", 60), ("90m", 5400), ("1h", 3600), ("1d", 86400), ("4h", 14400), ("1wk", None), ("0m", None)])
def test_bar_seconds(spark, label, seconds):
    assert one(spark, F.expr(timing.bar_seconds_sql("t")), t=label) == seconds


def test_run_stamp(spark):
    assert one(spark, timing.run_stamp(timing.as_of_literal("2024-01-02 03:04:05"))) == "20240102_030405"


FORMS = {
    "2025": "2025-01-01 00:00:00",
    "2025-10": "2025-10-01 00:00:00",
    "20251001": "2025-10-01 00:00:00",
    "20251001T093000": "2025-10-01 09:30:00",
    "20251001 093000": "2025-10-01 09:30:00",
    "20251001T093000-0400": "2025-10-01 13:30:00",
    "2025/10/01": "2025-10-01 00:00:00",
    "2025/1/5 9:30": "2025-01-05 09:30:00",
    "10/01/2025": "2025-10-01 00:00:00",
    "10/01/2025 09:30:00-04:00": "2025-10-01 13:30:00",
    "10/1/2025 9:30 AM": "2025-10-01 09:30:00",
    "10/1/2025 12:05:10 am": "2025-10-01 00:05:10",
    "10/1/2025 12:05 PM": "2025-10-01 12:05:00",
    "10/1/2025 4 p.m.": "2025-10-01 16:00:00",
    "2025-10-01 4:30 PM": "2025-10-01 16:30:00",
    "2025-10-01 09:30-04:00": "2025-10-01 13:30:00",
    "2025-10-01T09:30Z": "2025-10-01 09:30:00",
    "1 Oct 2025": "2025-10-01 00:00:00",
    "1-Oct-2025 09:30:15": "2025-10-01 09:30:15",
    "3rd september 2025": "2025-09-03 00:00:00",
    "October 1, 2025": "2025-10-01 00:00:00",
    "Oct 1, 2025 9:30": "2025-10-01 09:30:00",
    "Sept. 30 2025": "2025-09-30 00:00:00",
    "MAY 5, 2025": "2025-05-05 00:00:00",
    " 2025-10-01 09:30:00 ": "2025-10-01 09:30:00",
    "2025-10-01 09:30:00+05:30": "2025-10-01 04:00:00",
}
NO_TIMES = ["", " ", "09:30", "9:30 AM", "Octopus 1, 2025", "13/45/2025", "2025-13-01", "202510", "20251301", "10/1/2025 13:30 PM",
            "2025-02-30", "12345", "May 2025x", "1 2 3", "nonsense", "20251001T99"]


def test_time_forms(spark):
    rows = [*FORMS, *NO_TIMES, None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = df.select("t", parsing.to_utc_wall_time(F.col("t")).cast("string").alias("u"), parsing.to_bar_date(F.col("t")).cast("string").alias("d")).collect()
    assert {r["t"]: r["u"] for r in got} == FORMS | dict.fromkeys([*NO_TIMES, None])
    # The written day stays, whatever offset follows.
    assert {r["t"]: r["d"] for r in got if r["d"]} == {t: u[:10] for t, u in FORMS.items()}
