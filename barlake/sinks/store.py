"""SNK-1..SNK-4, SNK-7, SNK-8, SRT-1: the stores of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.operators.filters import daily, in_timeframes, intraday
from barlake.operators.keyed import new_rows, with_time
from barlake.plans.merge import delta_of
from barlake.plans.quality import QualityTables, quality_counters, quality_tables, with_expected
from barlake.schema import BAR_COLUMNS, BARS, DAILY, TICKER, TIMEFRAME, TS, VALUES, YEAR
from barlake.sinks.batches import read_batches, write_batch
from barlake.sinks.compaction import in_generations
from barlake.sinks.series_state import add_to_state, has_state, rebuild_state
from barlake.sources.generations import GENERATION
from barlake.sources.landing import rename_first_column
from barlake.sources.lake import empty_bars, path_exists, read_bars

LANDING_FILE = "landing_file"
RAW = T.StructType(
    [
        *[T.StructField(f.name, f.dataType) for f in BARS.fields],
        *[T.StructField(c, T.StringType()) for c in ("source_file", "line")],
        T.StructField("has_columns", T.BooleanType()),
        *[T.StructField(c, T.StringType()) for c in ("reason", "outcome")],
    ]
)


def write_fetched(bars: DataFrame, path: str) -> None:
    """SNK-1, SRC-5: fetched bars as headed CSV text into a landing zone, one folder per series file name."""
    for part, family in ((daily(bars), DAILY), (intraday(bars), "intraday")):
        columns = part.select(
            TS,
            *[F.col(c).alias(c.capitalize()) for c in VALUES],
            F.concat(F.col(TICKER), F.lit("_"), F.col(TIMEFRAME), F.lit(".csv")).alias(LANDING_FILE),
        )
        named = rename_first_column(columns, family)
        named.write.mode("append").option("header", True).partitionBy(LANDING_FILE).csv(path)


def read_fetched(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a landing zone written by ``write_fetched``; the folder carries the file name."""
    text = spark.read.text(path)
    return text.select(F.col("value").alias("line"), F.col(LANDING_FILE).cast("string").alias("source_file"))


def write_raw(cleaned: DataFrame, path: str, batch_id: str) -> int:
    """SNK-2: the cleaned lines of one fetch, replacing those of the same batch."""
    return write_batch(cleaned, path, batch_id)


def read_raw(spark: SparkSession, path: str, batch_id: str | None = None) -> DataFrame:
    """The raw store: one batch, for which only its folder is read, or all."""
    return read_batches(spark, path, RAW, batch_id)


def write_delta(delta: DataFrame, path: str, batch_id: str) -> int:
    """SNK-3: the delta of one batch. Repeating a batch replaces its own folder, an empty delta writes nothing."""
    return write_batch(delta.select(*BAR_COLUMNS), path, batch_id)


def read_delta(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """Bars of one delta; none if the batch added nothing."""
    return read_batches(spark, path, BARS, batch_id)


def in_storage_order(bars: DataFrame) -> DataFrame:
    """SRT-1: by bar size, year, ticker and time. The time is part of the range key, so a hot series is split."""
    order = [TIMEFRAME, YEAR, TICKER, TS]
    dated = bars.select(*BAR_COLUMNS, F.year(TS).alias(YEAR))
    return dated.repartitionByRange(*order).sortWithinPartitions(*order)


def append_bars(bars: DataFrame, path: str) -> None:
    """SNK-4: add bars to the master; rows already there are never rewritten."""
    rows = in_generations(in_storage_order(bars), path)
    rows.write.mode("append").partitionBy(TIMEFRAME, YEAR, GENERATION).parquet(path)


def write_snapshot(bars: DataFrame, path: str) -> None:
    """SNK-4, exact form: a whole master into a path that does not exist yet."""
    rows = in_storage_order(bars).withColumn(GENERATION, F.lit(0))
    rows.write.mode("errorifexists").partitionBy(TIMEFRAME, YEAR, GENERATION).parquet(path)


def merge_into_master(
    batch: DataFrame, master_path: str, delta_path: str, batch_id: str, state_path: str | None = None
) -> None:
    """PIP-2 against a stored master: write the delta, then append it, then bring the series state up to date.

    Only the part of the master that can hold keys of the batch is read: its bar sizes and years
    (folders) and time range (file statistics). Safe to repeat after a failure at any point: until the append
    commits, the same delta is written again; afterwards nothing is new.
    """
    spark = batch.sparkSession
    batch = with_time(batch)
    span = batch.agg(
        F.min(TS).alias("first"), F.max(TS).alias("last"), F.collect_set(TIMEFRAME).alias("sizes")
    ).first()
    if span["first"] is None:
        return
    if path_exists(spark, master_path):
        master = read_bars(spark, master_path, span["first"], span["last"])
        master = in_timeframes(master, span["sizes"])
    else:
        master = empty_bars(spark)
    written = write_delta(delta_of(batch, master), delta_path, batch_id)
    delta = read_delta(spark, delta_path, batch_id)
    if written and (found := delta.count()) != written:
        raise RuntimeError(f"delta {batch_id!r}: {written} rows were written, {found} are read back")
    # A master that grew before its state was kept gets one now, without the delta, which may be in it already.
    if state_path and path_exists(spark, master_path) and not has_state(spark, state_path):
        rebuild_state(new_rows(read_bars(spark, master_path), delta), state_path)
    # A repeated batch finds its old delta in place; the guard keeps the append idempotent.
    append_bars(delta_of(delta, master), master_path)
    if state_path:
        add_to_state(delta, state_path, batch_id)


def copy_daily(bars: DataFrame, path: str) -> None:
    """SNK-7: all daily bars into a scratch area."""
    out = in_storage_order(daily(bars)).write.mode("overwrite").option("partitionOverwriteMode", "static")
    out.partitionBy(TIMEFRAME, YEAR).parquet(path)


def report_path(spark: SparkSession, path: str, table: str, run_id: str) -> str:
    """Folder of one table of one run; the id is escaped by Spark's own rule, so it reads back as a column."""
    if not run_id:
        raise ValueError("a run needs an id")
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    return f"{path}/{table}/run_id={escaped}"


def read_report(spark: SparkSession, path: str, table: str, run_id: str) -> DataFrame:
    """One table of one run: counters, issues, results or stats."""
    return spark.read.parquet(report_path(spark, path, table, run_id))


def write_quality(
    bars: DataFrame,
    path: str,
    run_id: str,
    expected: DataFrame | None = None,
    file_errors: DataFrame | None = None,
    order: str = "ts",
    counters: DataFrame | None = None,
) -> QualityTables:
    """SNK-8: run the checks once, store the counters, and derive the other tables from them.

    ``counters`` that are known already (from a quality state) take the place of a run over the bars.
    """
    spark = bars.sparkSession
    if counters is None:
        counters = quality_counters(bars, expected, order)
    else:
        counters = with_expected(counters, expected)
    counters.write.mode("overwrite").parquet(report_path(spark, path, "counters", run_id))
    tables = quality_tables(read_report(spark, path, "counters", run_id), file_errors)
    for name in ("issues", "results", "stats"):
        getattr(tables, name).write.mode("overwrite").parquet(report_path(spark, path, name, run_id))
    return tables
