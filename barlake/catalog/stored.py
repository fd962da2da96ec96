"""Registered queries that run the stores themselves: they write the test tables' bars, and return what is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.catalog import views
from barlake.catalog.queries import _landing_lines, _published, _split, _zone_free, query
from barlake.operators.keyed import with_time
from barlake.plans import publish, workflow
from barlake.plans.clean import bars_of, clean_landing
from barlake.plans.publish import Target
from barlake.plans.quality_state import counters_of, take_in_deltas
from barlake.schema import BAR_COLUMNS, VALUES
from barlake.session import work_folder
from barlake.sinks import bucketed, compaction, store
from barlake.sinks.series_state import read_state
from barlake.sources.lake import read_bars


def _merged_lake(spark: SparkSession, sf: str) -> workflow.Lake:
    """A lake into which two deliveries were merged, the second one twice."""
    lake = workflow.Lake(work_folder(spark))
    first, second = _split(views.bars_dirty(spark, sf, with_delivery=True))
    for batch, rows in (("one", first), ("two / again", second), ("two / again", second)):
        store.merge_into_master(rows, lake.master, lake.delta, batch, lake.state)
    return lake


@query
def stored_master(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3, SNK-4, SRT-1, SRC-7, SET-1, PIP-2: two deliveries merged into a stored master, read back."""
    return read_bars(spark, _merged_lake(spark, sf).master)


@query
def stored_delta(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: the second delivery's delta as it was written."""
    return store.read_delta(spark, _merged_lake(spark, sf).delta, "two / again")


@query
def stored_series_state(spark: SparkSession, sf: str) -> DataFrame:
    """FRS-1, FRS-2, AGG-1: the series state that the merges kept."""
    return read_state(spark, _merged_lake(spark, sf).state)


@query
def stored_quality(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-5: counters of the master from a quality state that took in the deltas one by one."""
    lake = workflow.Lake(work_folder(spark))
    for k, rows in enumerate(_split(views.bars_dirty(spark, sf, with_delivery=True))):
        store.merge_into_master(rows, lake.master, lake.delta, f"d{k}")
        state = take_in_deltas(read_bars(spark, lake.master), lake.delta, lake.quality)
    return counters_of(state)


@query
def compacted_master(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4: a master of many small files after compaction, older files removed."""
    path = work_folder(spark)
    bars = with_time(views.bars_dirty(spark, sf))
    for part in range(4):
        store.append_bars(bars.where(F.col("seq") % 4 == part), path)
    compaction.compact(spark, path)
    compaction.remove_old_generations(spark, path)
    return read_bars(spark, path)


@query
def stored_raw(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2, PIP-1: cleaned landing lines through the raw store, usable bars of one batch."""
    path = work_folder(spark)
    cleaned = clean_landing(_landing_lines(spark, sf))
    store.write_raw(cleaned.limit(0), path, "none")
    store.write_raw(cleaned, path, "b / 1")
    return bars_of(store.read_raw(spark, path, "b / 1")).drop("seq")


@query
def landing_files(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1, SRC-5, SRC-6: bars written as headed text files, scanned and cleaned again."""
    path = work_folder(spark)
    bars = with_time(views.bars_dirty(spark, sf))
    store.write_fetched(bars, path)
    back = bars_of(clean_landing(store.read_fetched(spark, path)))
    return back.select("ticker", "timeframe", "ts", *VALUES)


@query
def daily_copy(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7: the daily bars in their scratch area."""
    path = work_folder(spark)
    store.copy_daily(with_time(views.bars_dirty(spark, sf)), path)
    return read_bars(spark, path)


@query
def stored_report(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-8: the results table of a stored quality report."""
    path = work_folder(spark)
    store.write_quality(views.bars_dirty(spark, sf), path, "run / 1", order="seq")
    results = store.read_report(spark, path, "results", "run / 1")
    listed = F.concat_ws(" | ", F.transform("issue_details", lambda i: F.concat_ws(": ", i["type"], i["message"])))
    return results.select("ticker", "timeframe", "records", "issues", "status", listed.alias("issue_text"))


@query
def published_table(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-4, SNK-6: what a target holds after a combined publish per series, and the same publish again."""
    target = Target.at(work_folder(spark))
    target.append(publish.combined_publish_form(_published(spark, sf)))
    for _ in range(2):
        publish.publish_combined(views.bars_dirty(spark, sf), target, "series")
    return _zone_free(target.read(spark), "timestamp")


@query
def published_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6, JOIN-2: a bucketed target after a publish of the second delivery, and the same publish again."""
    path = work_folder(spark)
    table = f"published_{uuid.uuid4().hex}"
    first, second = _split(views.bars_dirty(spark, sf, with_delivery=True))
    bucketed.append_bucketed(first, table, path, 8)
    for _ in range(2):
        bucketed.publish_bucketed(second, table, path, "series", 8)
    return spark.table(table).select(*BAR_COLUMNS)


@query
def full_run(spark: SparkSession, sf: str) -> DataFrame:
    """PIP-6: landing lines to master, report and published table; the steps, and the rows each of them left."""
    lake = workflow.Lake(work_folder(spark))
    target = Target.at(f"{lake.base}/published")
    switches = workflow.Switches(combined_publish=True)
    steps = workflow.run_lake(_landing_lines(spark, sf), lake, "run", combined_target=target, switches=switches)
    rows = {
        workflow.STEPS[0]: read_bars(spark, lake.master).count(),
        workflow.STEPS[1]: store.read_report(spark, lake.reports, "results", "run").count(),
        workflow.STEPS[3]: target.read(spark).count(),
    }
    counts = F.create_map(*[F.lit(x) for pair in rows.items() for x in pair])
    return steps.select("step", "ok", "detail", F.try_element_at(counts, F.col("step")).cast("long").alias("rows"))
