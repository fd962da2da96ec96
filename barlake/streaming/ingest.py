"""STR-1: landing files to master as an incremental file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.lookup import BROADCAST_ROWS
from barlake.plans.clean import clean_landing
from barlake.plans.workflow import Lake, store_and_merge
from barlake.schema import DAILY, INTRADAY
from barlake.sources.landing import as_landing_lines


def stream_landing(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    timeframes: list[str] | None = None,
    max_files_per_trigger: int = 10_000,
    strict: bool = False,
) -> StreamingQuery:
    """Every new landing file is cleaned and merged once; stops when all present files are done.

    A file is never split over two batches, so its header is always seen with its rows. A batch
    that is replayed after a failure finds its keys in the master and adds nothing, so no state is
    kept and late bars are accepted at any time. A later file of the same series needs a new name,
    such as ``AAPL_20240109_5m.csv``: the first and the last part of the name are the keys.
    """
    files_fit = max_files_per_trigger <= BROADCAST_ROWS or None
    sizes = timeframes or [DAILY, *INTRADAY]
    lines = as_landing_lines(
        spark.readStream.format("text")
        .option("pathGlobFilter", "*_{" + ",".join(sizes) + "}.csv")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing)
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        store_and_merge(clean_landing(batch, strict=strict, files_fit=files_fit), lake, f"stream-{batch_id}")

    return (
        lines.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
