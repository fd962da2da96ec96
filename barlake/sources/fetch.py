"""SRC-4: run a fetch plan on the executors with a fetcher supplied by the caller."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.schema import BAR_COLUMNS, BARS, DAILY, SEQ, SERIES, TICKER, TIMEFRAME, TS, VALUES

Fetcher = Callable[[str, str, str], pd.DataFrame]

ROWS_PER_BATCH = 20_000
FETCHED = T.StructType([*[T.StructField(f.name, f.dataType) for f in BARS.fields], T.StructField("error", T.StringType())])
CLOCK = "(?:[01][0-9]|2[0-3]):[0-5][0-9]"
ISO = re.compile(f"[0-9]{{4}}-(?:0[1-9]|1[0-2])-[0-9]{{2}}(?:([ T]){CLOCK}:[0-5][0-9]([+-]{CLOCK})?)?")


@dataclass
class Answer:
    """One plan row's bars, or its error and one row without values; ``times`` are texts while they have a ``form``."""

    ticker: str
    timeframe: str
    values: list[np.ndarray]
    times: np.ndarray
    form: tuple[str, str | None] | None = None
    error: str | None = None


def _bar_times(column: pd.Series, timeframe: str) -> pd.Series:
    """Time keys of one answer: the written day for daily bars, UTC wall time for the others."""
    if timeframe == DAILY:
        return pd.to_datetime(column).dt.tz_localize(None).dt.normalize()
    return pd.to_datetime(column, utc=True).dt.tz_localize(None)


def _form(texts: np.ndarray, timeframe: str) -> tuple[str, str | None] | None:
    """The form that ``_bar_times`` infers from the first text if it is an ISO time, else None.

    Daily bars keep their written day, so their form goes with the offset, and all texts have to end with it.
    """
    if set(map(type, texts)) != {str}:
        return None
    found = ISO.fullmatch(texts[0])
    if not found:
        return None
    split, offset = found.groups()
    kept = offset if timeframe == DAILY else None
    if kept and not all(text.endswith(kept) for text in texts):
        return None
    return "%Y-%m-%d" + (f"{split}%H:%M:%S" if split else "") + ("%z" if offset else ""), kept


def _numbers(column: pd.Series) -> np.ndarray:
    plain = column.values if isinstance(column, pd.Series) else None
    if isinstance(plain, np.ndarray) and plain.dtype.kind in "fiu":
        return plain.astype("float64")
    return pd.to_numeric(column, errors="coerce").to_numpy("float64", copy=True)


def _failed(ticker: str, timeframe: str, problem: Exception) -> Answer:
    nothing = [np.array([np.nan])] * len(VALUES)
    error = f"{type(problem).__name__}: {problem}"
    return Answer(ticker, timeframe, nothing, np.array(["NaT"], "datetime64[us]"), error=error)


def answer(fetcher: Fetcher, ticker: str, timeframe: str, period: str) -> Answer | None:
    """One plan row's answer; none if it is empty, one with an error if it failed."""
    try:
        found = fetcher(ticker, timeframe, period)
        if found is None or found.empty:
            return None
        values = [_numbers(found[c.capitalize()]) for c in VALUES]
        _, column = next(found.items())
        if column.dtype == object or isinstance(column.dtype, pd.StringDtype):
            texts = column.to_numpy(object, copy=True)
            if form := _form(texts, timeframe):
                return Answer(ticker, timeframe, values, texts, form)
        return Answer(ticker, timeframe, values, _bar_times(column, timeframe).to_numpy())
    except Exception as problem:  # noqa: BLE001 - one bad answer must not stop the others
        return _failed(ticker, timeframe, problem)


def with_times(answers: list[Answer]) -> list[Answer]:
    """The answers with their texts read as times, in one call for all texts of one form.

    An answer with a text that doesn't fit its form is read on its own, and may fail.
    """
    out = list(answers)
    forms = defaultdict(list)
    for at, one in enumerate(answers):
        if one.form:
            forms[one.form, one.timeframe == DAILY].append(at)
    for ((form, _), daily), places in forms.items():
        texts = np.concatenate([answers[at].times for at in places])
        read = pd.to_datetime(texts, format=form, utc=not daily, errors="coerce").tz_localize(None)
        read = (read.normalize() if daily else read).to_numpy()
        end = 0
        for at in places:
            one = answers[at]
            start, end = end, end + len(one.times)
            times = read[start:end]
            try:
                if np.isnat(times).any():
                    times = _bar_times(pd.Series(one.times, dtype=object), one.timeframe).to_numpy()
                out[at] = Answer(one.ticker, one.timeframe, one.values, times)
            except Exception as problem:  # noqa: BLE001 - as above
                out[at] = _failed(one.ticker, one.timeframe, problem)
    return out


def as_batch(answers: list[Answer]) -> pa.RecordBatch:
    """The rows of some answers, in their order."""
    answers = with_times(answers)
    counts = np.array([len(a.times) for a in answers])
    of = np.repeat(np.arange(len(answers)), counts)
    failed = np.array([a.error is not None for a in answers])[of]
    seq = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    texts = lambda each: pa.array(each, pa.string()).take(pa.array(of))
    columns = {
        TICKER: texts([a.ticker for a in answers]),
        TIMEFRAME: texts([a.timeframe for a in answers]),
        TS: pa.concat_arrays([pa.array(a.times, pa.timestamp("us"), from_pandas=True, safe=False) for a in answers]),
        SEQ: pa.array(seq, pa.int64(), mask=failed),
        "error": texts([a.error for a in answers]),
    }
    for k, name in enumerate(VALUES):
        columns[name] = pa.array(np.concatenate([a.values[k] for a in answers]), pa.float64(), from_pandas=True)
    names = [f.name for f in FETCHED]
    return pa.RecordBatch.from_arrays([columns[name] for name in names], names=names)


def answered(fetcher: Fetcher, rows: Iterable[tuple[str, str, str]]) -> Iterator[pa.RecordBatch]:
    """One call per plan row; answers are put together up to ROWS_PER_BATCH rows."""
    waiting: list[Answer] = []
    n = 0
    for row in rows:
        found = answer(fetcher, *row)
        if found:
            waiting.append(found)
            n += len(found.times)
        if n >= ROWS_PER_BATCH:
            yield as_batch(waiting)
            waiting, n = [], 0
    if waiting:
        yield as_batch(waiting)


def fetch(plan: DataFrame, fetcher: Fetcher, tasks: int | None = None) -> DataFrame:
    """One fetcher call per plan row, spread over ``tasks`` tasks (by default one per core).

    ``fetcher(ticker, timeframe, period)`` returns a table whose first column is the time and which
    has Open, High, Low, Close and Volume columns; an empty answer yields no row, an exception one
    row holding its text in ``error``. Calls of other rows go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return answered(fetcher, (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))))

    tasks = tasks or plan.sparkSession.sparkContext.defaultParallelism
    return plan.select(*SERIES, "period").repartition(tasks).mapInArrow(run, FETCHED)


def fetched_bars(fetched: DataFrame) -> DataFrame:
    """The bars of a fetch."""
    return fetched.where("error IS NULL").select(*BAR_COLUMNS)


def fetch_errors(fetched: DataFrame) -> DataFrame:
    """The failed plan rows of a fetch, as rejects."""
    return fetched.where("error IS NOT NULL").select(
        F.concat_ws("_", *SERIES).alias("source_file"),
        F.lit("fetch_error").alias("reason"),
        F.col("error").alias("line"),
        *SERIES,
    )
