"""Operators on the bar key (ticker, timeframe, ts): keep-first, new rows, conflict skip.

``seq`` must be unique among the rows of one key; the readers of this package guarantee it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators.lookup import fits_broadcast
from barlake.schema import BAR_COLUMNS, KEY, SEQ, SERIES, TS, VALUES


def with_time(bars: DataFrame) -> DataFrame:
    """FLT-2: rows without a time key cannot be stored."""
    return bars.where(F.col(TS).isNotNull())


def one_per_key(bars: DataFrame, keep: str = "first") -> DataFrame:
    """SET-3, WIN-4, AGG-12: the row with the lowest (``first``) or highest (``last``) seq of each key.

    An aggregate over fixed-width buffers instead of a ranking window: copies of a key are combined
    before the shuffle, so a key holding a third of all rows costs one row per input task.
    """
    if keep not in {"first", "last"}:
        raise ValueError(f"keep must be first or last, not {keep!r}")
    return bars.groupBy(*KEY).agg(*_picked(keep)).select(*BAR_COLUMNS)


def _picked(keep: str) -> list[Column]:
    """Values of the row with the lowest or highest seq of a group."""
    end = "min" if keep == "first" else "max"
    return [*[F.expr(f"{end}_by({c}, {SEQ}) AS {c}") for c in VALUES], F.expr(f"{end}({SEQ}) AS {SEQ}")]


def batch_fits(batch: DataFrame) -> bool:
    """True if the keys of the batch may be broadcast: a counted bound."""
    return fits_broadcast(batch.select(*KEY))


def known_keys(batch: DataFrame, master: DataFrame, batch_small: bool | None = None) -> DataFrame:
    """Keys of the batch that the master already holds, each once.

    A small batch is broadcast: the master is scanned for three columns and nothing of it is
    shuffled. Beyond that one aggregate over both key sets finds the common keys; copies of a key are
    combined before its shuffle on either side.
    """
    if batch_small is None:
        batch_small = batch_fits(batch)
    if batch_small:
        wanted = F.broadcast(batch.select(*KEY))
        return master.select(*KEY).join(wanted, KEY, "left_semi").distinct()
    sides = batch.select(*KEY, F.lit(False).alias("_known")).unionByName(
        master.select(*KEY, F.lit(True).alias("_known"))
    )
    flags = sides.groupBy(*KEY).agg(F.expr("bool_or(_known) AS _in_master"), F.expr("bool_and(_known) AS _only_master"))
    return flags.where("_in_master AND NOT _only_master").select(*KEY)


def new_keyed_rows(
    batch: DataFrame, master: DataFrame, keep: str = "first", batch_small: bool | None = None
) -> DataFrame:
    """JOIN-1 with keep-first: one row per key that the master lacks.

    A small batch is compared with its few known keys. A large one meets the master's keys in the
    same aggregate that keeps the first row, so there is one shuffle and no join.
    """
    if batch_small is None:
        batch_small = batch_fits(batch)
    if batch_small:
        known = F.broadcast(known_keys(batch, master, True))
        return one_per_key(batch, keep).join(known, KEY, "left_anti")
    both = batch.select(*BAR_COLUMNS, F.lit(False).alias("_known")).unionByName(
        master.select(*KEY, F.lit(True).alias("_known")), allowMissingColumns=True
    )
    return (
        both.groupBy(*KEY)
        .agg(*_picked(keep), F.expr("bool_or(_known) AS _known"))
        .where("NOT _known")
        .select(*BAR_COLUMNS)
    )


def new_rows(batch: DataFrame, master: DataFrame, batch_small: bool | None = None) -> DataFrame:
    """JOIN-1: every batch row, copies included, whose key is absent from the master.

    Known keys are unique, so a large batch meets them in a plain join, and a key with many copies is
    left to the adaptive splitting of its side.
    """
    if batch_small is None:
        batch_small = batch_fits(batch)
    known = known_keys(batch, master, batch_small)
    return batch.join(F.broadcast(known) if batch_small else known, KEY, "left_anti")


def skip_conflicts(batch: DataFrame, target: DataFrame) -> DataFrame:
    """JOIN-2: insert-or-ignore on the key: first row of each key within the batch, none already in the target."""
    return new_keyed_rows(with_time(batch), target)


def series_of(bars: DataFrame) -> DataFrame:
    """SRC-11: the series that exist."""
    return bars.select(*SERIES).distinct()
