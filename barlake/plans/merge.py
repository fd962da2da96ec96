"""PIP-2: adding a cleaned batch to the master, first value wins."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.keyed import new_keyed_rows, one_per_key, with_time
from barlake.operators.lookup import attach, series_fit
from barlake.schema import BAR_COLUMNS, KEY, SEQ, SERIES, VALUES


class Merged(NamedTuple):
    master: DataFrame
    delta: DataFrame


def delta_of(batch: DataFrame, master: DataFrame, batch_small: bool | None = None) -> DataFrame:
    """JOIN-1, SET-3: the rows the append form adds, one per new key. Running it again adds nothing."""
    return new_keyed_rows(with_time(batch), master, batch_small=batch_small)


def merge_append(master: DataFrame, batch: DataFrame, batch_small: bool | None = None) -> Merged:
    """Production form: the master only ever grows by its delta.

    Equals the exact form wherever first loads carry no repeated keys; repeated keys of a first load
    are reduced to their first row here, while the exact form stores them.
    """
    delta = delta_of(batch, master, batch_small)
    return Merged(master.select(*BAR_COLUMNS).unionByName(delta), delta)


def _sides(batch: DataFrame, master: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of both sides, those of the batch marked ``_new``."""
    return batch.select(*columns, F.lit(True).alias("_new")).unionByName(master.select(*columns, F.lit(False).alias("_new")))


def series_rules(batch: DataFrame, master: DataFrame) -> DataFrame:
    """(series, _stored, _grows): whether the master has the series, and whether the batch brings it a new key.

    Keys of both sides meet in one aggregate, where copies are combined before the shuffle.
    """
    keys = _sides(batch, master, KEY).groupBy(*KEY).agg(F.expr("bool_and(_new) AS _absent"))
    return keys.groupBy(*SERIES).agg(F.expr("bool_or(NOT _absent) AS _stored"), F.expr("bool_or(_absent) AS _grows"))


def merge_exact(master: DataFrame, batch: DataFrame, series_small: bool | None = None) -> Merged:
    """Whole new master with the per-series rules of a file-by-file merge.

    * a series without a master takes the batch as it is, repeated keys included;
    * a series for which the batch has no new key keeps its master untouched;
    * any other series becomes keep-first over master and new rows.

    Each side is read twice: once for the keys, which give the rule of each series, and once for the rows.
    Rows of growing series meet in one aggregate by key; the others join it as groups of one, apart by
    their ``seq``, so nothing is read or decided a third time. The result is a full snapshot and belongs
    in a new path.
    """
    batch, master = with_time(batch).select(*BAR_COLUMNS), master.select(*BAR_COLUMNS)
    rules = series_rules(batch, master)
    if series_small is None:
        series_small = series_fit(batch.unionByName(master))
    ruled = attach(_sides(batch, master, BAR_COLUMNS), rules, SERIES, "inner", small_fits=series_small)
    merging = "_stored AND _grows"
    # First loads keep the batch's rows, untouched series the master's.
    taken = ruled.where(f"({merging}) OR _new <> _stored").withColumn("_own", F.expr(f"CASE WHEN NOT ({merging}) THEN {SEQ} END"))
    first = [
        F.expr(f"min_by({c}, {SEQ}) FILTER (WHERE {side}) AS {c}{name}")
        for side, name in (("NOT _new", "_old"), ("_new", "_new"))
        for c in [*VALUES, SEQ]
    ]
    grouped = taken.groupBy(*KEY, "_own").agg(F.expr("bool_and(_new) AS _added"), F.expr("any_value(_stored) AS _stored"), *first)
    picked = [F.expr(f"CASE WHEN _added THEN {c}_new ELSE {c}_old END AS {c}") for c in [*VALUES, SEQ]]
    rows = grouped.select(*KEY, *picked, "_added", "_stored").select(*BAR_COLUMNS, "_added", "_stored")
    return Merged(rows.select(*BAR_COLUMNS), rows.where("_added AND _stored").select(*BAR_COLUMNS))


def replace_from(master: DataFrame, batch: DataFrame) -> DataFrame:
    """``keep='last'`` variant: rows of the batch replace stored rows of the same key (new snapshot)."""
    tagged = master.select(*BAR_COLUMNS, F.lit(0).alias("_side")).unionByName(
        one_per_key(with_time(batch), "last").withColumn("_side", F.lit(1))
    )
    values = [c for c in BAR_COLUMNS if c not in ("ticker", "timeframe", "ts")]
    return (
        tagged.groupBy("ticker", "timeframe", "ts")
        .agg(*[F.max_by(c, "_side").alias(c) for c in values])
        .select(*BAR_COLUMNS)
    )
