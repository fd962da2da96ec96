"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.catalog import views
from barlake.functions import timing
from barlake.functions.parsing import to_bar_date, to_number, to_utc_wall_time
from barlake.operators import counters, filters, freshness, keyed, returns, steps
from barlake.operators.lookup import series_fit
from barlake.plans import clean, merge, publish, quality, quality_state
from barlake.schema import BAR_COLUMNS, KEY, SERIES, TS, VALUES
from barlake.session import work_folder
from barlake.sinks.file_states import errors_of
from barlake.sinks.series_state import combined
from barlake.sources import fetch, universe
from barlake.sources.datasource import register_fetch_source
from barlake.sources.lake import latest_time

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF = "2024-02-05 06:00:00"


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _split(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First delivery as stored master, second as new batch; together all rows."""
    return (
        bars.where("delivery = 1").select(*BAR_COLUMNS),
        bars.where("delivery = 2").select(*BAR_COLUMNS),
    )


# --- universe and plan -------------------------------------------------------------------------


@query
def ticker_universe(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1, SRC-2, SCL-15: market segments as groups, customers as tickers, one JSON object per customer."""
    names = F.array(F.lower("c_name"), F.concat(F.lower("c_name"), F.lit("=x")))
    packed = views.table(spark, sf, "customer").select(
        F.to_json(F.map_from_arrays(F.array("c_mktsegment"), F.array(names))).alias("value")
    )
    return universe.explode_universe(packed)


@query
def fetch_plan(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-3, JOIN-5: every customer name at every bar size, with its look-back."""
    tickers = views.table(spark, sf, "customer").select(F.upper("c_name").alias("ticker"))
    return universe.fetch_plan(tickers, timeframes=["1m", "5m", "15m", "30m", "90m", "1h", "2h"])


@query
def refresh_stale_only(spark: SparkSession, sf: str) -> DataFrame:
    """FRS-3, selective: the plan rows of the stale daily series."""
    bars = views.bars_dirty(spark, sf)
    tickers = bars.select("ticker").distinct()
    fresh = freshness.daily_freshness(bars, tickers, "2024-02-07 00:00:00")
    return freshness.stale_part_of(universe.fetch_plan(tickers), fresh)


# --- bars and per-series summaries -------------------------------------------------------------


@query
def bars_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars rolled up from events: the table the engine works on."""
    return views.bars_clean(spark, sf)


@query
def bars_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return views.bars_dirty(spark, sf)


@query
def series_rows(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1, AGG-3."""
    return counters.series_summary(views.bars_dirty(spark, sf))


@query
def series_state(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1, SRC-11: the state kept with every append, from the summaries of two deliveries."""
    first, second = _split(views.bars_dirty(spark, sf, with_delivery=True))
    return combined(counters.series_summary(first).unionByName(counters.series_summary(second)))


@query
def target_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-12, AGG-2."""
    return latest_time(views.ordered_bars(spark, sf))


@query
def series_exist(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-11: which nation and priority series exist."""
    return keyed.series_of(views.ordered_bars(spark, sf))


# --- quality checks ----------------------------------------------------------------------------


@query
def dq_missing(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-2, AGG-4."""
    missing = [f"n_missing_{c}" for c in VALUES]
    return counters.row_counters(views.bars_dirty(spark, sf)).select(*SERIES, *missing)


@query
def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-3, AGG-5."""
    return steps.duplicate_counts(views.bars_dirty(spark, sf))


@query
def dq_price(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-4a, DQ-4b, DQ-4c, AGG-6."""
    return counters.row_counters(views.bars_dirty(spark, sf)).select(
        *SERIES, "n_high_low", "n_close_out", "n_open_out"
    )


@query
def dq_volume(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-5."""
    return counters.row_counters(views.bars_dirty(spark, sf)).select(*SERIES, "records", "n_no_volume")


@query
def simple_returns(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-1 in stored order."""
    return returns.simple_returns(views.bars_dirty(spark, sf), order="seq")


@query
def simple_returns_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-1 in time order, ties in stored order."""
    return returns.simple_returns(views.bars_dirty(spark, sf), order="ts")


@query
def simple_returns_unfilled(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-1 without forward fill."""
    return returns.simple_returns(views.bars_dirty(spark, sf), order="seq", fill=False)


@query
def return_stats(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-7."""
    stats = returns.return_stats(returns.simple_returns(views.bars_dirty(spark, sf), order="seq"))
    return stats.select(
        *SERIES, "n_returns", F.round("mean_ret", 6).alias("mean_ret"), F.round("std_ret", 6).alias("std_ret")
    )


@query
def z_scores(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-3, SCL-12."""
    bars = views.bars_dirty(spark, sf)
    scored = returns.z_scores(returns.simple_returns(bars, order="seq"), series_fit(bars))
    return scored.select(*SERIES, "seq", F.round("z", 6).alias("z"))


@query
def dq_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-6."""
    return returns.outlier_counts(views.bars_dirty(spark, sf), order="seq")


@query
def dq_outliers_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-6 in time order."""
    return returns.outlier_counts(views.bars_dirty(spark, sf), order="ts")


@query
def time_steps(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-2, SRT-2."""
    return steps.time_steps(views.bars_dirty(spark, sf))


@query
def step_medians(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-8."""
    return steps.step_counts(views.bars_dirty(spark, sf)).select(*SERIES, "median_step_us")


@query
def dq_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-7, DQ-8."""
    return steps.step_counts(views.bars_dirty(spark, sf)).select(*SERIES, "n_gaps")


@query
def dq_counters(spark: SparkSession, sf: str) -> DataFrame:
    """All counters of the run in one table."""
    return quality.quality_counters(views.bars_dirty(spark, sf), order="seq")


@query
def dq_counters_by_time(spark: SparkSession, sf: str) -> DataFrame:
    """All counters in time order, the form that production runs."""
    return quality.quality_counters(views.bars_dirty(spark, sf))


@query
def dq_counters_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-5 incrementally: the state of the first delivery, then only the slots that the second touches are read."""
    both = views.bars_dirty(spark, sf, with_delivery=True)
    first, second = _split(both)
    state = quality_state.block_state(first)
    return quality_state.counters_of(quality_state.updated_state(state, second, both.select(*BAR_COLUMNS)))


@query
def dq_counters_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """The same over the rolled-up hourly bars, in time order."""
    return quality.quality_counters(views.bars_clean(spark, sf), order="ts")


@query
def dq_issues(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-1..DQ-8, DQ-12, SCL-14."""
    return quality.quality_run(views.bars_dirty(spark, sf), order="seq").issues.drop("metrics")


@query
def dq_results(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-10, DQ-11, AGG-11; the issue list as text."""
    results = quality.quality_run(views.bars_dirty(spark, sf), order="seq").results
    listed = F.concat_ws(" | ", F.transform("issue_details", lambda i: F.concat_ws(": ", i["type"], i["message"])))
    return results.select(*SERIES, "records", "issues", "status", listed.alias("issue_text"))


@query
def dq_stats(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-13, AGG-10."""
    return quality.quality_run(views.bars_dirty(spark, sf), order="seq").stats


@query
def dq_empty_series(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-1: expected series without any bar. Nations are expected at every bar size of the bars."""
    bars = views.bars_dirty(spark, sf)
    sizes = F.explode(F.array(F.lit("1d"), F.lit("5m")))
    expected = (
        views.table(spark, sf, "nation")
        .select(F.col("n_name").alias("ticker"), sizes.alias("timeframe"))
        .unionByName(keyed.series_of(bars))
    )
    found = quality.quality_run(bars, expected, order="seq").issues
    return found.where("type = 'empty_data'").select(*SERIES, "type", "message")


@query
def dq_processing_errors(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-9: a file for each customer, some without a header or a column; a second batch mends every other one."""
    customers = views.table(spark, sf, "customer")
    head = "CASE WHEN {bad} AND c_custkey % 5 = 0 THEN '' WHEN {bad} AND c_custkey % 7 = 0 THEN 'Date,Open,High,Low,Close' ELSE 'Date,Open,High,Low,Close,Volume' END"

    def batch(bad: str, number: int) -> DataFrame:
        lines = F.expr(f"explode(array({head.format(bad=bad)}, concat('2024-01-02,1,2,0,1,', CAST(c_custkey AS STRING))))").alias("line")
        files = customers.select(F.concat(F.col("c_name"), F.lit("_1d.csv")).alias("source_file"), lines)
        return clean.file_reasons(clean.clean_landing(files)).withColumn("number", F.lit(number).cast("long"))

    states = batch("TRUE", 0).unionByName(batch("c_custkey % 2 = 0", 1))
    return quality.issues_of(_no_counters(spark), errors_of(states)).select("ticker", "type", "message", "n")


def _no_counters(spark: SparkSession) -> DataFrame:
    counts = ", ".join(f"{c} long" for c in ["records", *quality.COUNTS])
    return spark.createDataFrame([], f"ticker string, timeframe string, {counts}, median_step_us double")


@query
def rows_with_missing(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-3."""
    return filters.rows_with_missing(views.bars_dirty(spark, sf))


@query
def chart_data(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-14, SRT-3: one series with its issue text."""
    return quality.series_chart(views.bars_dirty(spark, sf), "click", "5m", order="seq")


# --- cleaning ----------------------------------------------------------------------------------


@query
def clean_cast(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-1, SCL-2, SCL-7, FLT-2: bars written as text with offsets and junk, read back."""
    text = views.table(spark, sf, "events").select(
        "event_id",
        F.expr(
            "CASE WHEN event_id % 89 = 0 THEN 'nonsense' WHEN event_id % 83 = 0 THEN NULL "
            "WHEN event_id % 5 = 0 THEN concat(substring(CAST(ts AS STRING), 1, 19), '-04:00') "
            "ELSE substring(CAST(ts AS STRING), 1, 19) END"
        ).alias("time_text"),
        F.expr(
            "CASE WHEN event_id % 71 = 0 THEN 'x' WHEN event_id % 73 = 0 THEN 'NaN' "
            "WHEN event_id % 79 = 0 THEN '' ELSE CAST(CAST(event_id % 1000 AS DOUBLE) / 4 AS STRING) END"
        ).alias("number_text"),
    )
    return text.select(
        "event_id",
        to_utc_wall_time(F.col("time_text")).alias("utc_ts"),
        to_bar_date(F.col("time_text")).alias("bar_date"),
        to_number(F.col("number_text")).alias("number"),
    ).where("utc_ts IS NOT NULL")


@query
def clean_time_forms(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-1, SCL-2: every event time written in one of many forms, read back."""
    minute = F.date_trunc("minute", "ts")
    written = lambda form: F.date_format(minute, form)
    forms = [
        written("yyyy/MM/dd HH:mm"), written("M/d/yyyy h:mm a"), written("MM/dd/yyyy HH:mm:ssXXX"), written("d MMM yyyy HH:mm:ss"),
        written("MMMM d, yyyy H:mm"), written("yyyyMMdd'T'HHmmss"), F.concat(written("yyyy-MM-dd HH:mm"), F.lit("-04:00")),
        written("yyyyMMdd"), written("MMM d, yyyy"), written("yyyy"), written("HH:mm"),
    ]
    chosen = F.element_at(F.array(*forms), (F.col("event_id") % len(forms) + 1).cast("int"))
    text = views.table(spark, sf, "events").select("event_id", chosen.alias("time_text"))
    return text.select("event_id", to_utc_wall_time(F.col("time_text")).alias("utc_ts"), to_bar_date(F.col("time_text")).alias("bar_date"))


@query
def banner_filter(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-1: rows whose text repeats the ticker are dropped. Here: documents naming their own language."""
    rows = views.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("ticker"), "text", "source")
    return filters.without_banners(rows, ["text", "source"]).select("doc_id", "ticker")


@query
def landing_clean(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-1 over landing lines derived from every event: two header layouts, banners, bad cells."""
    return clean.bars_of(_cleaned(spark, sf)).drop("seq")


@query
def landing_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-1: what could not be used, by file and reason."""
    return clean.rejects_of(_cleaned(spark, sf)).groupBy("source_file", "reason").agg(F.count("*").alias("n"))


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """There is one landing file per series, so counting the series bounds the files."""
    return clean.clean_landing(_landing_lines(spark, sf), files_fit=series_fit(views.bars_dirty(spark, sf)))


def _landing_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One landing file per event type and bar size: header first, then a banner, then a line per event."""
    events = views.table(spark, sf, "events").withColumn("tf", F.expr("CASE WHEN user_id % 2 = 0 THEN '1d' ELSE '5m' END"))
    name = F.concat(F.col("event_type"), F.lit("_"), F.col("tf"), F.lit(".csv")).alias("source_file")
    files = events.select("event_type", "tf").distinct()
    heads = files.select(
        F.explode(
            F.array(
                F.expr("CASE WHEN tf = '1d' THEN 'Date,Open,High,Low,Close,Volume' ELSE 'Datetime,Close,High,Low,Open,Volume' END"),
                F.concat(F.lit(","), F.array_join(F.array_repeat("event_type", 5), ",")),
            )
        ).alias("line"),
        name,
    )
    price = lambda factor: F.expr(f"CAST(value * {factor} AS STRING)")
    key = F.expr(
        "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'nonsense' "
        "WHEN tf = '1d' THEN substring(CAST(ts AS STRING), 1, 10) "
        "ELSE concat(substring(CAST(ts AS STRING), 1, 19), '-04:00') END"
    )
    close = F.expr("CASE WHEN event_id % 53 = 0 THEN 'x' ELSE CAST(value AS STRING) END")
    ordered = F.when(F.col("tf") == "1d", F.concat_ws(",", key, price("1"), price("2"), price("0.5"), close, F.expr("CAST(event_id AS STRING)")))
    ordered = ordered.otherwise(F.concat_ws(",", key, close, price("2"), price("0.5"), price("1"), F.expr("CAST(event_id AS STRING)")))
    return heads.unionByName(events.select(ordered.alias("line"), name))


# --- merge -------------------------------------------------------------------------------------


@query
def new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-1: rows of the second delivery whose key the first lacks, copies included."""
    master, batch = _split(keyed.with_time(views.bars_dirty(spark, sf, with_delivery=True)))
    return keyed.new_rows(batch, master)


@query
def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """SET-3, WIN-4, AGG-12."""
    return keyed.one_per_key(keyed.with_time(views.bars_dirty(spark, sf)))


@query
def keep_last(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.one_per_key(keyed.with_time(views.bars_dirty(spark, sf)), keep="last")


@query
def merge_delta(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-2, SNK-3: the delta of the second delivery."""
    master, batch = _split(views.bars_dirty(spark, sf, with_delivery=True))
    return merge.delta_of(batch, keyed.one_per_key(keyed.with_time(master)))


@query
def merge_append(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-2, SET-2: both deliveries appended to an empty lake."""
    first, second = _split(keyed.with_time(views.bars_dirty(spark, sf, with_delivery=True)))
    return merge.merge_append(keyed.one_per_key(first), second).master


@query
def merge_exact(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-2 with the per-series rules: first load, untouched, and rewritten series all occur."""
    master, batch = _split(keyed.with_time(views.bars_dirty(spark, sf, with_delivery=True)))
    return merge.merge_exact(master, batch).master


@query
def merge_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Revisions win: the second delivery replaces rows of the first."""
    master, batch = _split(keyed.with_time(views.bars_dirty(spark, sf, with_delivery=True)))
    return merge.replace_from(keyed.one_per_key(master), batch)


# --- freshness ---------------------------------------------------------------------------------


@query
def freshness_daily(spark: SparkSession, sf: str) -> DataFrame:
    """FRS-1, JOIN-3, SCL-8: event types and nations are configured; nations have no bars."""
    bars = views.bars_dirty(spark, sf)
    nations = views.table(spark, sf, "nation").select(F.col("n_name").alias("ticker"))
    return freshness.daily_freshness(bars, bars.select("ticker").distinct().unionByName(nations), AS_OF)


@query
def freshness_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """FRS-1 from the series state alone."""
    nations = views.table(spark, sf, "nation").select(F.col("n_name").alias("ticker"))
    state = series_state(spark, sf)
    return freshness.daily_freshness(state, state.select("ticker").distinct().unionByName(nations), AS_OF)


@query
def freshness_intraday(spark: SparkSession, sf: str) -> DataFrame:
    """FRS-2, SCL-9."""
    return freshness.intraday_freshness(views.bars_dirty(spark, sf), "2024-01-31 11:30:00")


@query
def freshness_intraday_all(spark: SparkSession, sf: str) -> DataFrame:
    """FRS-2 with every ticker expected at every bar size."""
    bars = views.bars_dirty(spark, sf)
    tickers = bars.select("ticker").distinct()
    return freshness.intraday_freshness(bars, AS_OF, tickers=tickers, expect_all=True)


@query
def refresh_needed(spark: SparkSession, sf: str) -> DataFrame:
    """FRS-3, AGG-9."""
    return freshness.needs_refresh(freshness_daily(spark, sf))


# --- publish -----------------------------------------------------------------------------------


@query
def publish_global(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-5: shipped bars after the latest ordered bar of the whole target."""
    return filters.newer_than(views.shipped_bars(spark, sf), views.ordered_bars(spark, sf))


@query
def publish_series(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-5 per series."""
    target = views.ordered_bars(spark, sf)
    return filters.newer_than(views.shipped_bars(spark, sf), target, scope="series")


@query
def publish_conflict_skip(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-2, SNK-6."""
    target, batch = _split(views.bars_dirty(spark, sf, with_delivery=True))
    return keyed.skip_conflicts(batch, keyed.with_time(target))


@query
def publish_split_daily(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-3, FLT-6, PIP-3."""
    return _zone_free(filters.split_publish_form(filters.daily(views.bars_dirty(spark, sf))), "Date")


@query
def publish_split_intraday(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-3, FLT-6, PIP-3."""
    return _zone_free(filters.split_publish_form(filters.intraday(views.bars_dirty(spark, sf))), "Date")


@query
def publish_combined(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-4, PIP-4."""
    return _zone_free(filters.combined_publish_form(views.bars_dirty(spark, sf)), "timestamp")


@query
def publish_split_increment(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-3: the daily rows that a publish would append, behind the mark of what is published."""
    bars = filters.daily(views.bars_dirty(spark, sf))
    published = filters.split_publish_form(filters.daily(_published(spark, sf)))
    return _zone_free(publish.split_increment(bars, published), "Date")


@query
def publish_combined_increment(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-4: mark, first row of each key and conflicts in one, per series."""
    published = filters.combined_publish_form(_published(spark, sf))
    return _zone_free(publish.combined_increment(views.bars_dirty(spark, sf), published, "series"), "timestamp")


def _published(spark: SparkSession, sf: str) -> DataFrame:
    """The first delivery's bars up to the middle of the month, as what was published so far."""
    return views.bars_dirty(spark, sf, with_delivery=True).where("delivery = 1 AND ts < '2024-01-16'").drop("delivery")


def _zone_free(published: DataFrame, column: str) -> DataFrame:
    """Both engines are compared on UTC wall times."""
    return published.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query
def daily_subset(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7, SRC-10."""
    return filters.daily(views.bars_dirty(spark, sf))


# --- fetch -------------------------------------------------------------------------------------


@query
def pluggable_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4: every customer is asked for; the fetcher answers from the ticker alone, fails for some."""
    return fetch.fetch(_customer_plan(spark, sf), _vendor())


@query
def fetch_as_source(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4 as a data source: the same plan read through ``spark.read.format``, failures asked again once."""
    register_fetch_source(spark, _customer_plan(spark, sf), _vendor(), "customer_bars", work_folder(spark))
    options = {"rowsPerPartition": 1000, "retries": 1, "wait": 0}
    return spark.read.format("customer_bars").options(**options).load()


def _customer_plan(spark: SparkSession, sf: str) -> DataFrame:
    tickers = views.table(spark, sf, "customer").select(F.col("c_name").alias("ticker"))
    return universe.fetch_plan(tickers, timeframes=["5m"], with_daily=False)


def _vendor() -> fetch.Fetcher:
    import pandas as pd

    def fetcher(ticker: str, timeframe: str, period: str) -> pd.DataFrame:
        number = int(ticker.rsplit("#", 1)[1])
        if number % 11 == 0:
            raise ConnectionError("no answer")
        if number % 7 == 0:
            return pd.DataFrame()
        prices = {c: [number + 0.5] for c in ("Open", "High", "Low", "Close", "Volume")}
        return pd.DataFrame({"index": ["2024-01-02 09:30:00-05:00"], **prices})

    return fetcher


@query
def age_of_bars(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-8, SCL-9: ages of every bar at a fixed time."""
    now = timing.as_of_literal(AS_OF)
    bars = keyed.with_time(views.bars_dirty(spark, sf))
    return bars.select(
        *KEY,
        "seq",
        timing.age_in_days(now, F.col(TS)).alias("age_days"),
        timing.age_in_seconds(now, F.col(TS)).alias("age_seconds"),
    )
