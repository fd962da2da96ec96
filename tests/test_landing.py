import pytest

from barlake.plans import clean
from barlake.sources.landing import read_landing, rename_first_column
from tests.conftest import as_sorted

AAPL = """Datetime,Close,High,Low,Open,Volume
,AAPL,AAPL,AAPL,AAPL,AAPL
2025-10-01 09:30:00-04:00,1.5,2,1,1.2,10
2025-10-01 09:35:00-04:00,,2,1,1.2,x
,3,3,3,3,3
"""
GSPC = """Price,Close,High,Low,Open,Volume
Date,Close,High,Low,Open,Volume
2025-10-01,4,5,3,3.5,7
"""
CRUDE = """Date,Open,High,Low,Close,Volume
CL=F,CL=F,CL=F,CL=F,CL=F,CL=F
2025-10-02,10,12,9,11,5
nonsense,1,1,1,1,1
"""


@pytest.fixture()
def landing(tmp_path):
    for name, text in {"AAPL_5m.csv": AAPL, "^GSPC_1d.csv": GSPC, "CL=F_1d.csv": CRUDE, "X_1wk.csv": GSPC}.items():
        (tmp_path / name).write_text(text)
    return tmp_path


def good(cleaned):
    return sorted(
        (r["ticker"], r["timeframe"], str(r["ts"]), r["open"], r["close"], r["volume"])
        for r in clean.bars_of(cleaned).collect()
    )


def test_all_layouts_in_one_scan(spark, landing):
    cleaned = clean.clean_landing(read_landing(spark, str(landing)))
    assert good(cleaned) == [
        ("AAPL", "5m", "2025-10-01 13:30:00", 1.2, 1.5, 10.0),
        ("AAPL", "5m", "2025-10-01 13:35:00", 1.2, None, None),
        ("CL=F", "1d", "2025-10-02 00:00:00", 10.0, 11.0, 5.0),
        ("^GSPC", "1d", "2025-10-01 00:00:00", 3.5, 4.0, 7.0),
    ]
    assert as_sorted(clean.rejects_of(cleaned), "source_file", "reason") == [
        ("CL=F_1d.csv", "bad_time"),
        ("^GSPC_1d.csv", "before_header"),
    ]
    missing = clean.missing_of(cleaned).collect()
    assert [(r["source_file"], str(r["ts"])) for r in missing] == [("AAPL_5m.csv", "2025-10-01 13:35:00")]
    assert clean.file_errors(cleaned).count() == 0


def test_strict_rejects_the_whole_file(spark, landing):
    cleaned = clean.clean_landing(read_landing(spark, str(landing)), strict=True)
    assert {r[0] for r in good(cleaned)} == {"AAPL", "^GSPC"}
    assert ("CL=F_1d.csv", "file_failed") in as_sorted(clean.file_errors(cleaned), "source_file", "reason")


def test_files_are_joined_by_salt_when_they_do_not_fit(spark, landing):
    lines = read_landing(spark, str(landing))
    assert good(clean.clean_landing(lines, files_fit=False)) == good(clean.clean_landing(lines, files_fit=True))


def test_whitelist_is_applied_to_file_names(spark, landing):
    lines = read_landing(spark, str(landing), ["5m"])
    assert {r["source_file"] for r in lines.select("source_file").distinct().collect()} == {"AAPL_5m.csv"}


def test_file_without_header_or_column_is_reported(spark, tmp_path):
    (tmp_path / "A_1d.csv").write_text("2025-10-01,1,1,1,1,1\n")
    (tmp_path / "B_1d.csv").write_text("Date,Open,High,Low,Close\n2025-10-01,1,2,0,1\n")
    cleaned = clean.clean_landing(read_landing(spark, str(tmp_path)))
    assert as_sorted(clean.file_errors(cleaned), "source_file", "reason") == [
        ("A_1d.csv", "no_header"),
        ("B_1d.csv", "missing_column"),
    ]
    assert good(cleaned) == []  # a file that lacks a column is rejected whole


def test_regex_banner_mode_reads_the_ticker_as_a_pattern(spark, tmp_path):
    (tmp_path / "B.K_5m.csv").write_text("Datetime,Open,High,Low,Close,Volume,Note\n2025-10-01,1,1,1,1,1,BXK\n")
    lines = read_landing(spark, str(tmp_path))
    assert len(good(clean.clean_landing(lines))) == 1
    assert len(good(clean.clean_landing(lines, banner_mode="regex"))) == 0


def test_seq_follows_line_order_across_splits(spark, tmp_path):
    rows = [f"2025-01-01 00:00:{i % 60:02d},{i},1,1,1,1" for i in range(20_000)]
    (tmp_path / "A_5m.csv").write_text("Datetime,Close,High,Low,Open,Volume\n" + "\n".join(rows) + "\n")
    (tmp_path / "B_5m.csv").write_text("Datetime,Close,High,Low,Open,Volume\n" + "\n".join(rows[:5000]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        bars = clean.bars_of(clean.clean_landing(read_landing(spark, str(tmp_path)))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for ticker, n in (("A", 20_000), ("B", 5000)):
        closes = [r["close"] for r in sorted((r for r in bars if r["ticker"] == ticker), key=lambda r: r["seq"])]
        assert closes == [float(i) for i in range(n)]


def test_rename_first_column(spark):
    df = spark.createDataFrame([(1, 2)], "index int, Close int")
    assert rename_first_column(df, "1d").columns == ["Date", "Close"]
    assert rename_first_column(df, "5m").columns == ["Datetime", "Close"]


def test_displaced_header_and_order_survive_a_shuffle(spark, tmp_path):
    """The header lies below other lines, the file in many parts, and the lines are dealt anew before they are cut."""
    rows = [f"2025-01-01 00:00:{i % 60:02d},{i},1,1,1,1" for i in range(20_000)]
    (tmp_path / "A_5m.csv").write_text("Price,x\n2024-12-31,5,5,5,5,5\nDatetime,Close,High,Low,Open,Volume\n" + "\n".join(rows) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = read_landing(spark, str(tmp_path)).repartition(7, "line")
        cleaned = clean.clean_landing(lines).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    bars = sorted((r for r in cleaned if r["outcome"] == "bar"), key=lambda r: r["seq"])
    assert [r["close"] for r in bars] == [float(i) for i in range(20_000)]
    assert sorted(r["reason"] for r in cleaned if r["outcome"] != "bar") == ["before_header", "before_header"]
    assert len({r["seq"] for r in cleaned}) == len(cleaned)
