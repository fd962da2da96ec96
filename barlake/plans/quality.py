"""PIP-5, DQ-1..DQ-14: the data-quality run.

All checks end in one row of counters per series; issues, results and run statistics are derived
from that small table. Bars are read three times with disjoint columns (values; times; closes), and
only what must be ordered is shuffled: distinct times, and closes in blocks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions import messages
from barlake.functions.parsing import file_stem
from barlake.operators.counters import row_counters
from barlake.operators.lookup import series_fit
from barlake.operators.ordering import find_crowded_slots
from barlake.operators.returns import outlier_counts
from barlake.operators.steps import step_counts
from barlake.schema import SERIES, TICKER, TIMEFRAME, TS, VALUES

# Names of the checks.
ISSUE_TYPES = [
    "empty_data",
    "missing_values",
    "duplicate_timestamps",
    "price_inconsistency",
    "volume_anomaly",
    "outlier_detection",
    "time_gaps",
]
COUNTS = [
    *[f"n_missing_{c}" for c in VALUES],
    "n_duplicates",
    "n_high_low",
    "n_close_out",
    "n_open_out",
    "n_no_volume",
    "n_outliers",
    "n_gaps",
]


class QualityTables(NamedTuple):
    counters: DataFrame
    issues: DataFrame
    results: DataFrame
    stats: DataFrame


def quality_counters(
    bars: DataFrame,
    expected: DataFrame | None = None,
    order: str = "ts",
    fill: bool = True,
    series_small: bool | None = None,
) -> DataFrame:
    """One row of counters per series. ``expected`` adds series that are stored but hold no row (DQ-1)."""
    crowded = find_crowded_slots(bars)
    if series_small is None:
        series_small = crowded.few_series or series_fit(bars)
    outliers = outlier_counts(bars, order=order, fill=fill, series_small=series_small, crowded=crowded)
    counters = (
        row_counters(bars)
        .join(step_counts(bars, crowded=crowded, series_small=series_small), SERIES, "left")
        .join(outliers, SERIES, "left")
    )
    return with_expected(counters, expected)


def with_expected(counters: DataFrame, expected: DataFrame | None) -> DataFrame:
    """Counters with a row of zeros for every expected series without bars, and no missing count."""
    if expected is not None:
        counters = expected.select(*SERIES).distinct().join(counters, SERIES, "full")
    return counters.selectExpr(
        *SERIES, *[f"coalesce({c}, 0L) AS {c}" for c in ["records", *COUNTS]], "median_step_us"
    )


def _checks() -> list[tuple[list[str], str]]:
    """(counter columns, message) of every check but the empty one, in the order they are listed."""
    return [
        ([f"n_missing_{c}" for c in VALUES], messages.missing_values()),
        (["n_duplicates"], messages.duplicate_timestamps()),
        (["n_high_low", "n_close_out", "n_open_out"], messages.price_inconsistency()),
        (["n_no_volume"], messages.volume_anomaly()),
        (["n_outliers"], messages.outliers()),
        (["n_gaps"], messages.time_gaps()),
    ]


def issue_array() -> str:
    """Issues of one row of counters as an array of (type, message, n, metrics), zero counts left out."""
    entry = "named_struct('type', '{}', 'message', {}, 'n', {}, 'metrics', map({}))"
    no_rows = "CASE WHEN records = 0 THEN 1L ELSE 0L END"
    entries = [entry.format(ISSUE_TYPES[0], "'DataFrame is empty'", no_rows, "'records', records")]
    for kind, (counts, message) in zip(ISSUE_TYPES[1:], _checks()):
        metrics = ", ".join(f"'{c}', {c}" for c in counts)
        entries.append(entry.format(kind, message, " + ".join(counts), metrics))
    return f"filter(array({', '.join(entries)}), i -> i.n > 0)"


def issues_of(counters: DataFrame, file_errors: DataFrame | None = None) -> DataFrame:
    """DQ-9, DQ-12: one row per issue; unreadable files appear with their file stem and no timeframe."""
    found = counters.selectExpr(*SERIES, f"inline({issue_array()})")
    if file_errors is None:
        return found
    broken = file_errors.select(
        file_stem(F.col("source_file")).alias(TICKER),
        F.lit(None).cast("string").alias(TIMEFRAME),
        F.lit("processing_error").alias("type"),
        F.col("reason").alias("message"),
        F.lit(1).cast("bigint").alias("n"),
        F.lit(None).cast("map<string,bigint>").alias("metrics"),
    )
    return found.unionByName(broken)


def results_of(counters: DataFrame) -> DataFrame:
    """DQ-10, DQ-11, AGG-11: one row per series, clean ones included."""
    return counters.selectExpr(*SERIES, "records", f"{issue_array()} AS _found").selectExpr(
        *SERIES,
        "records",
        "CAST(size(_found) AS BIGINT) AS issues",
        "CASE WHEN size(_found) > 0 THEN 'ISSUES' ELSE 'OK' END AS status",
        "transform(_found, i -> named_struct('type', i.type, 'message', i.message)) AS issue_details",
    )


def stats_of(results: DataFrame, file_errors: DataFrame | None = None) -> DataFrame:
    """AGG-10, DQ-13: four counters; no row at all when there are no files.

    Files that could not be read count as files, nothing else.
    """
    rows = results.select("records", "issues")
    if file_errors is not None:
        nothing = F.lit(0).cast("bigint")
        rows = rows.unionByName(file_errors.select(nothing.alias("records"), nothing.alias("issues")))
    return rows.agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.count_if(F.col("issues") > 0).alias("files_with_issues"),
        F.coalesce(F.sum("issues"), F.lit(0)).alias("anomalies_detected"),
    ).where("total_files > 0")


def quality_run(
    bars: DataFrame,
    expected: DataFrame | None = None,
    file_errors: DataFrame | None = None,
    order: str = "ts",
    fill: bool = True,
    series_small: bool | None = None,
) -> QualityTables:
    """PIP-5: all tables of one run, lazily. To write them, use ``write_quality``, which runs the checks once."""
    counters = quality_counters(bars, expected, order, fill, series_small)
    return quality_tables(counters, file_errors)


def quality_tables(counters: DataFrame, file_errors: DataFrame | None = None) -> QualityTables:
    results = results_of(counters)
    return QualityTables(counters, issues_of(counters, file_errors), results, stats_of(results, file_errors))


def series_chart(bars: DataFrame, ticker: str, timeframe: str, order: str = "ts") -> DataFrame:
    """DQ-14 from the bars alone: only the one series is read and checked."""
    one = bars.where((F.col(TICKER) == ticker) & (F.col(TIMEFRAME) == timeframe))
    issues = quality_run(one, order=order, series_small=True).issues
    return chart_data(one, ticker, timeframe, issues)


def chart_data(bars: DataFrame, ticker: str, timeframe: str, issues: DataFrame) -> DataFrame:
    """DQ-14, SRT-3: the bars of one series in time order, with its issue text on every row."""
    one = (F.col(TICKER) == ticker) & (F.col(TIMEFRAME) == timeframe)
    line = F.concat(F.lit("⚠️ "), F.col("type"), F.lit(": "), F.col("message"))
    ranked = F.array_position(F.array(*[F.lit(t) for t in ISSUE_TYPES]), F.col("type"))
    text = (
        issues.where(one)
        .agg(F.array_sort(F.collect_list(F.struct(ranked.alias("rank"), line.alias("line")))).alias("_lines"))
        .select(F.concat_ws("<br>", F.transform("_lines", lambda x: x["line"])))
    )
    return (
        bars.where(one)
        .orderBy(F.col(TS).asc_nulls_last(), "seq")
        .select(*SERIES, TS, *VALUES, "seq", text.scalar().alias("issue_text"))
    )
