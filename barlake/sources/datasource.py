"""SRC-4: a fetch plan as a Spark data source, one partition per plan row.

    register_fetch_source(spark, plan, fetcher)
    spark.read.format("bar_fetch").option("retries", 2).load()

Options: ``rowsPerPartition`` (1), ``retries`` after a failed call (2), ``wait`` seconds before the first of
them, doubled each time (0.5). A row whose last try fails becomes one row with its ``error``; the others
go on. A partition that Spark runs again asks again, for its own rows only.

A plan without a ``folder`` travels with the source by way of the driver, so one of more than MAX_PLAN_ROWS
rows is refused. With a new ``folder`` that driver and executors share, the plan may have any size: it is
written there as Parquet, the driver sees its files' names and row counts, and each partition reads its own
rows. There ``rowsPerPartition`` is by default the least that gives at most MAX_PLAN_ROWS partitions.
"""

from __future__ import annotations

import re
import string
import time
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from barlake.schema import SERIES
from barlake.sources.fetch import FETCHED, Fetcher, answered

NAME = "bar_fetch"
MAX_PLAN_ROWS = 100_000
ROWS_PER_FILE = 100_000
PLAN = [*SERIES, "period"]

Row = tuple[str, str, str]


def with_retries(fetcher: Fetcher, retries: int, wait: float) -> Fetcher:
    """The same fetcher, asked again after a failure, each time after twice the wait."""

    def ask(ticker: str, timeframe: str, period: str):
        for left in range(retries, -1, -1):
            try:
                return fetcher(ticker, timeframe, period)
            except Exception:
                if not left:
                    raise
                time.sleep(wait * 2 ** (retries - left))

    return ask


class PlanRows(InputPartition):
    """Plan rows, or where they are stored: (file, first row, number of rows) of each piece."""

    def __init__(self, rows: list[Row] | None = None, pieces: list[tuple[str, int, int]] | None = None):
        super().__init__(rows)
        self.rows = rows or []
        self.pieces = pieces or []

    def all_rows(self) -> Iterator[Row]:
        yield from self.rows
        for path, first, n in self.pieces:
            files, inside = pyarrow.fs.FileSystem.from_uri(path)
            with files.open_input_file(inside) as file:
                stored = pyarrow.parquet.ParquetFile(file).read(PLAN, use_threads=False)
            yield from zip(*(column.to_pylist() for column in stored.slice(first, n).columns))


def pieces_of(files: list[tuple[str, int]], rows: int) -> list[PlanRows]:
    """Partitions of ``rows`` rows of these files, (path, number of rows), one after the other."""
    out: list[PlanRows] = []
    left = 0
    for path, n in files:
        at = 0
        while at < n:
            if not left:
                out.append(PlanRows())
                left = rows
            took = min(left, n - at)
            out[-1].pieces.append((path, at, took))
            at, left = at + took, left - took
    return out


class FetchReader(DataSourceReader):
    def __init__(self, partitions: Callable[[int | None], list[PlanRows]], fetcher: Fetcher, options: dict[str, str]):
        options = {name.lower(): value for name, value in options.items()}
        self.rows = int(options["rowsperpartition"]) if "rowsperpartition" in options else None
        if self.rows is not None and self.rows < 1:
            raise ValueError("rowsPerPartition has to be 1 or more")
        self.parts = partitions
        self.fetcher = with_retries(fetcher, int(options.get("retries", 2)), float(options.get("wait", 0.5)))

    def partitions(self) -> list[PlanRows]:
        return self.parts(self.rows) or [PlanRows()]

    def read(self, partition: PlanRows) -> Iterator[pa.RecordBatch]:
        yield from answered(self.fetcher, partition.all_rows())


def in_source(plan: list[Row]) -> Callable[[int | None], list[PlanRows]]:
    """Partitions of a plan that the source holds."""
    return lambda rows: [PlanRows(plan[at : at + (rows or 1)]) for at in range(0, len(plan), rows or 1)]


def in_files(files: list[tuple[str, int]]) -> Callable[[int | None], list[PlanRows]]:
    """Partitions of a plan in files, (path, number of rows)."""
    least = max(1, -(-sum(n for _, n in files) // MAX_PLAN_ROWS))
    return lambda rows: pieces_of(files, rows or least)


def fetch_source(partitions: Callable[[int | None], list[PlanRows]], fetcher: Fetcher, name: str = NAME) -> type[DataSource]:
    """A data source that holds the partitions of a plan, by rows per partition, and its fetcher."""

    class FetchSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return FETCHED

        def reader(self, schema) -> FetchReader:
            return FetchReader(partitions, fetcher, dict(self.options))

    return FetchSource


def for_arrow(path: str) -> str:
    """Spark's name of a file as Arrow reads it: all but ASCII quoted, one name for what Hadoop calls s3a and s3n."""
    return quote(re.sub("^s3[an]:", "s3:", path), safe=string.punctuation)


def written(plan: DataFrame, folder: str) -> list[tuple[str, int]]:
    """Write a plan into a new folder; its files and their row counts."""
    plan.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(folder)
    stored = plan.sparkSession.read.schema(plan.schema).parquet(folder)
    counts = stored.groupBy(F.input_file_name().alias("path")).count().collect()
    return sorted((for_arrow(row["path"]), row["count"]) for row in counts)


def register_fetch_source(
    spark: SparkSession, plan: DataFrame, fetcher: Fetcher, name: str = NAME, folder: str | None = None
) -> None:
    """Make ``spark.read.format(name)`` fetch this plan; a ``folder`` holds a plan of any size."""
    plan = plan.select(*PLAN)
    if folder:
        partitions = in_files(written(plan, folder))
    else:
        rows = plan.limit(MAX_PLAN_ROWS + 1).collect()
        if len(rows) > MAX_PLAN_ROWS:
            raise ValueError(f"a plan of more than {MAX_PLAN_ROWS} rows: give a folder, or use fetch()")
        partitions = in_source([tuple(r) for r in rows])
    spark.dataSource.register(fetch_source(partitions, fetcher, name))
