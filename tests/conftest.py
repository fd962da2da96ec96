from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.schema import BAR_COLUMNS, BARS  # noqa: E402
from barlake.session import build_session  # noqa: E402

TESTDATA = os.environ.get("BARLAKE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "barlake-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_sf():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def oracle_sf():
    return f"{TESTDATA}/sf0.01"


def bar(ticker, timeframe, ts, close=1.0, seq=0, open=1.0, high=None, low=None, volume=1.0):
    """One bar as a tuple; ``ts`` as ISO text or None."""
    when = datetime.fromisoformat(ts) if ts else None
    high = max(x for x in (open, close, 1.0) if x is not None) if high is None else high
    low = min(x for x in (open, close, 1.0) if x is not None) if low is None else low
    return (ticker, timeframe, when, open, high, low, close, volume, seq)


@pytest.fixture(scope="session")
def bars_of_rows(spark):
    def build(rows):
        return spark.createDataFrame(rows, BARS).select(*BAR_COLUMNS)

    return build


def as_sorted(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
