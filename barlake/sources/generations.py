"""Folders of a stored master: one for each bar size and year, with generations of which the highest counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import TIMEFRAME, YEAR

GENERATION = "generation"


@dataclass(frozen=True)
class Folder:
    path: str
    timeframe: str
    year: int | None
    generation: int
    sizes: tuple[int, ...] = ()

    @property
    def next_path(self) -> str:
        return f"{self.path.rsplit('/', 1)[0]}/{GENERATION}={self.generation + 1}"


class FileSystem:
    """The few calls on whatever file system a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def listed(self, pattern: str) -> list[str]:
        return [s.getPath().toString() for s in self._fs.globStatus(self.path(pattern)) or []]

    def sizes(self, folder: str) -> tuple[int, ...]:
        """Sizes of the folder's data files; names with a dot or underscore in front are none."""
        found = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self.path(folder))]
        return tuple(sorted(n for name, n in found if name[0] not in "._"))

    def rename(self, old, new) -> bool:
        return self._fs.rename(old, new)

    def delete(self, path) -> None:
        self._fs.delete(path, True)


def file_system(spark: SparkSession, path: str) -> FileSystem:
    return FileSystem(spark, path)


def _folders(spark: SparkSession, path: str) -> list[Folder]:
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = []
    for one in file_system(spark, path).listed(f"{path}/{TIMEFRAME}=*/{YEAR}=*/{GENERATION}=*"):
        timeframe, year, generation = (unescape(part.split("=", 1)[1]) for part in one.rsplit("/", 3)[1:])
        found.append(Folder(one, timeframe, int(year) if year.lstrip("-").isdigit() else None, int(generation)))
    return found


def _highest(folders: list[Folder]) -> dict[tuple[str, int | None], int]:
    highest: dict[tuple[str, int | None], int] = {}
    for f in folders:
        highest[f.timeframe, f.year] = max(f.generation, highest.get((f.timeframe, f.year), 0))
    return highest


def current_folders(spark: SparkSession, path: str, with_sizes: bool = True) -> list[Folder]:
    """The folders that readers take, in order. There is one for each bar size and year."""
    folders = _folders(spark, path)
    highest, fs = _highest(folders), file_system(spark, path)
    now = [f for f in folders if f.generation == highest[f.timeframe, f.year]]
    now = [Folder(f.path, f.timeframe, f.year, f.generation, fs.sizes(f.path)) for f in now] if with_sizes else now
    return sorted(now, key=lambda f: f.path)


def old_folders(spark: SparkSession, path: str) -> list[Folder]:
    folders = _folders(spark, path)
    highest = _highest(folders)
    return [f for f in folders if f.generation < highest[f.timeframe, f.year]]


def without_old_generations(stored: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Rows of a master's scan without those of older generations: a filter on folders, no file of them is opened."""
    for f in old_folders(spark, path):
        old = (F.col(TIMEFRAME) == f.timeframe) & (F.col(YEAR) == F.lit(f.year)) & (F.col(GENERATION) == f.generation)
        stored = stored.where(~old)
    return stored
