"""SNK-4, SRT-1: small files of a master put together, folder by folder, without a gap for readers.

Every append adds files; after many small batches a folder (bar size and year) holds many of them. A folder
with enough small files is rewritten into a new generation: first into a hidden folder, then by one rename
to ``generation=<n>`` beside the old one. Readers take the highest generation they see, so they read either
all old files or all new ones; those that planned before the rename go on with the old files, which stay
until ``remove_old_generations``. Appends go to the highest generation.

One writer at a time: a folder that got files while it was rewritten is left as it was and said so. Renaming a
folder has to be atomic, as it is on HDFS and local disks; object stores need a table format instead.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import TICKER, TIMEFRAME, TS, YEAR
from barlake.sources.generations import GENERATION, Folder, current_folders, file_system, old_folders

TARGET_BYTES = 128 << 20
LEAST_FILES = 4


@dataclass(frozen=True)
class Rewrite:
    """A folder to rewrite, and into how many files."""

    folder: Folder
    files: int


def packed(sizes: list[int], most: int) -> int:
    """How many bins of ``most`` bytes hold files of these sizes, largest first, each in the first bin with room."""
    bins: list[int] = []
    for size in sorted(sizes, reverse=True):
        for i, used in enumerate(bins):
            if used + size <= most:
                bins[i] += size
                break
        else:
            bins.append(size)
    return len(bins)


def compaction_plan(
    spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, least_files: int = LEAST_FILES
) -> list[Rewrite]:
    """Folders with at least ``least_files`` files under half the target that would come down to fewer files.

    Only names and sizes of files are looked at.
    """
    plan = []
    for folder in current_folders(spark, path):
        small = [size for size in folder.sizes if 2 * size < target_bytes]
        files = packed(list(folder.sizes), target_bytes)
        if len(small) >= least_files and files < len(folder.sizes):
            plan.append(Rewrite(folder, files))
    return plan


def rewrite(spark: SparkSession, path: str, item: Rewrite) -> bool:
    """One folder into its next generation; False if it changed meanwhile and was left alone."""
    folder, files, fs = item.folder, item.files, file_system(spark, path)
    staged = f"{path}/.compaction-{uuid.uuid4().hex}"
    rows = spark.read.parquet(folder.path)
    laid = rows.repartitionByRange(files, TICKER, TS) if files > 1 else rows.coalesce(1)
    laid.sortWithinPartitions(TICKER, TS).write.parquet(staged)
    now = [f for f in current_folders(spark, path) if (f.timeframe, f.year) == (folder.timeframe, folder.year)]
    if now != [folder]:
        fs.delete(fs.path(staged))
        return False
    return fs.rename(fs.path(staged), fs.path(folder.next_path))


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, least_files: int = LEAST_FILES) -> DataFrame:
    """Rewrite what ``compaction_plan`` names: (timeframe, bar_year, generation, files_before, files_after, done)."""
    outcomes = []
    for item in compaction_plan(spark, path, target_bytes, least_files):
        done = rewrite(spark, path, item)
        f = item.folder
        outcomes.append((f.timeframe, f.year, f.generation + done, len(f.sizes), item.files, done))
    columns = f"{TIMEFRAME} string, {YEAR} int, {GENERATION} int, files_before int, files_after int, done boolean"
    return spark.createDataFrame(outcomes, columns)


def remove_old_generations(spark: SparkSession, path: str) -> int:
    """Delete what no new reader takes: older generations, and what a rewrite that failed left behind.

    To be run when readers that planned before the last rewrite are done.
    """
    fs = file_system(spark, path)
    left = [f.path for f in old_folders(spark, path)] + fs.listed(f"{path}/.compaction-*")
    for one in left:
        fs.delete(fs.path(one))
    return len(left)


def in_generations(bars: DataFrame, path: str) -> DataFrame:
    """Rows with the generation that their folder is at; new folders start at 0."""
    generation = F.lit(0)
    for f in current_folders(bars.sparkSession, path, with_sizes=False):
        if f.generation:
            generation = F.when((F.col(TIMEFRAME) == f.timeframe) & (F.col(YEAR) == f.year), f.generation).otherwise(generation)
    return bars.withColumn(GENERATION, generation)
