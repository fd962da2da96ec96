"""SRC-1, SRC-2, SRC-3, JOIN-5, SCL-15: tickers and what to fetch for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import DAILY, DAILY_LOOKBACK, DEFAULT_LOOKBACK, INTRADAY, LOOKBACK, TICKER, TIMEFRAME


def explode_universe(json_text: DataFrame, column: str = "value") -> DataFrame:
    """SRC-1: JSON objects (group to list of tickers) to rows (group, ticker), tickers in upper case."""
    groups = F.explode(F.from_json(F.col(column), "map<string,array<string>>")).alias("group", "_tickers")
    listed = json_text.select(groups).select("group", F.explode("_tickers").alias(TICKER))
    return listed.withColumn(TICKER, F.upper(TICKER))


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: the configured tickers of a JSON file."""
    return explode_universe(spark.read.text(path, wholetext=True))


def look_back(timeframe: Column) -> Column:
    """Look-back period of a bar size, the default where the fixed table has none."""
    table = F.create_map(*[F.lit(x) for pair in LOOKBACK.items() for x in pair])
    return F.coalesce(F.try_element_at(table, timeframe), F.lit(DEFAULT_LOOKBACK))


def fetch_plan(tickers: DataFrame, timeframes: list[str] | None = None, with_daily: bool = True) -> DataFrame:
    """SRC-3: (ticker, timeframe, period) for every ticker at every bar size.

    The few bar sizes are exploded on each ticker row, so the product needs neither join nor shuffle.
    """
    sizes = list(timeframes or INTRADAY) + ([DAILY] if with_daily else [])
    plan = tickers.select(TICKER, F.explode(F.array(*[F.lit(s) for s in sizes])).alias(TIMEFRAME))
    period = look_back(F.col(TIMEFRAME))
    if with_daily:
        period = F.when(F.col(TIMEFRAME) == DAILY, DAILY_LOOKBACK).otherwise(period)
    return plan.withColumn("period", period)
