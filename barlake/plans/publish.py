"""PIP-3, PIP-4, SNK-5, SNK-6: publishing new rows to target tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.functions.parsing import drop_zone
from barlake.functions.timing import as_of_literal
from barlake.operators.filters import (
    combined_publish_form,
    daily,
    intraday,
    keys_of_published,
    newer_than,
    split_publish_form,
)
from barlake.operators.keyed import one_per_key, skip_conflicts, with_time
from barlake.schema import TS
from barlake.sources.lake import latest_time, path_exists


@dataclass(frozen=True)
class Target:
    """A table to publish to: any DataFrame format with its options (a path, a JDBC table, ...)."""

    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def at(cls, path: str, format: str = "parquet") -> Target:
        return cls(format, {"path": path})

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame | None:
        """The published rows, or None while a file target does not exist yet.

        With ``schema`` nothing is inferred, so a file target may be an empty folder.
        """
        path = self.options.get("path")
        if path and not path_exists(spark, path):
            return None
        reader = spark.read.schema(schema) if path and schema is not None else spark.read
        return reader.format(self.format).options(**self.options).load()

    def append(self, rows: DataFrame) -> int:
        """Add the rows, counting them on the way."""
        written = Observation()
        counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
        counted.write.format(self.format).options(**self.options).mode("append").save()
        return written.get["n"]


def new_for_target(
    bars: DataFrame,
    published: DataFrame | None,
    time_column: str,
    scope: str = "global",
) -> DataFrame:
    """FLT-5 for a stored target. The global high-water mark is read first, so it becomes a literal
    that prunes files of the lake."""
    if published is None:
        return bars
    if scope == "global":
        latest = latest_time(published, time_column).select(drop_zone(F.col("latest"))).first()[0]
        return bars if latest is None else bars.where(F.col(TS) > as_of_literal(latest))
    return newer_than(bars, keys_of_published(published), scope)


def _publish(
    bars: DataFrame,
    target: Target | None,
    time_column: str,
    form: Callable[[DataFrame], DataFrame],
    scope: str,
    skip_known: bool,
) -> bool:
    """Append the new rows; False if there was no target or nothing new (FLT-4)."""
    if target is None:
        return False
    published = target.read(bars.sparkSession, form(bars).schema)
    rows = new_for_target(bars, published, time_column, scope)
    if skip_known:
        rows = unpublished(rows, published, scope)
    return target.append(form(rows)) > 0


def unpublished(rows: DataFrame, published: DataFrame | None, scope: str) -> DataFrame:
    """First row of each key, none that is published.

    Behind the mark of the whole table nothing can be published yet, so its keys are not read.
    """
    if published is None or scope == "global":
        return one_per_key(with_time(rows))
    return skip_conflicts(rows, keys_of_published(published))


def split_increment(bars: DataFrame, published: DataFrame) -> DataFrame:
    """PIP-3, lazily: what one half of a split publish would append to a table of its form."""
    return split_publish_form(newer_than(bars, keys_of_published(published)))


def combined_increment(bars: DataFrame, published: DataFrame, scope: str = "global") -> DataFrame:
    """PIP-4, lazily: what a combined publish would append."""
    fresh = newer_than(bars, keys_of_published(published), scope)
    return combined_publish_form(unpublished(fresh, published, scope))


def publish_split(
    bars: DataFrame, daily_target: Target | None, intraday_target: Target | None, scope: str = "global"
) -> dict[str, bool]:
    """PIP-3, SNK-5: daily rows to one table, all others to another, each behind its own mark."""
    return {
        "daily": _publish(daily(bars), daily_target, "Date", split_publish_form, scope, False),
        "intraday": _publish(intraday(bars), intraday_target, "Date", split_publish_form, scope, False),
    }


def publish_combined(bars: DataFrame, target: Target, scope: str = "global") -> bool:
    """PIP-4, SNK-6: one table for all bar sizes, one mark over all of them, rows with a known key ignored."""
    return _publish(bars, target, "timestamp", combined_publish_form, scope, True)
