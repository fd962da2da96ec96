"""Bar tables derived from the driver's tables, in Spark and in SQL.

Every view uses all rows of its tables. ``bars_dirty`` plants each defect the checks look for:
missing times and closes, crossed prices, zero volume, repeated times, and one week without bars
(its rows are moved into the week before).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schema import BAR_COLUMNS, BARS
from barlake.session import use_utc

NTZ = "timestamp_ntz"

# The expressions below are valid in both engines.
MOVED_TS = (
    "CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' "
    "THEN ts - INTERVAL '7' DAY ELSE ts END"
)
DIRTY_COLUMNS = {
    "seq": "event_id",
    "ticker": "event_type",
    "timeframe": "CASE WHEN user_id % 2 = 0 THEN '1d' ELSE '5m' END",
    "ts": (
        "CASE WHEN event_id % 97 = 0 THEN NULL WHEN user_id % 2 = 0 THEN date_trunc('day', moved) "
        "ELSE date_trunc('minute', moved) END"
    ),
    "open": "CASE WHEN event_id % 59 = 0 THEN value * 1.5 ELSE value END",
    "high": "CASE WHEN event_id % 41 = 0 THEN value * 0.9 ELSE value * 1.02 END",
    "low": "value * 0.98",
    "close": (
        "CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 47 = 0 THEN value * 1.05 ELSE value * 1.01 END"
    ),
    "volume": "CASE WHEN event_id % 37 = 0 THEN 0 ELSE CAST(event_id % 1000 + 1 AS DOUBLE) END",
}
# Which of two deliveries brings a bar: one series is new in the second, one is complete in the
# first, the others are split by the number in their properties.
DELIVERY = (
    "CASE WHEN event_type = 'purchase' THEN 2 WHEN event_type = 'signup' THEN 1 "
    "WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) < 50 THEN 1 ELSE 2 END"
)

DIRTY_SQL = (
    "SELECT "
    + ", ".join(f"{expression} AS {name}" for name, expression in DIRTY_COLUMNS.items())
    + f", {DELIVERY} AS delivery FROM (SELECT *, {MOVED_TS} AS moved FROM events) AS e"
)
CLEAN_SQL = (
    "SELECT event_type AS ticker, '1h' AS timeframe, date_trunc('hour', ts) AS ts, "
    "min_by(value, event_id) AS open, max(value) AS high, min(value) AS low, "
    "max_by(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume, min(event_id) AS seq "
    "FROM events GROUP BY event_type, date_trunc('hour', ts)"
)
ORDERED_SQL = (
    "SELECT n_name AS ticker, o_orderpriority AS timeframe, o_orderdate AS ts, o_totalprice AS close, "
    "o_orderkey AS seq FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
)
SHIPPED_SQL = (
    "SELECT n_name AS ticker, o_orderpriority AS timeframe, l_shipdate AS ts, l_extendedprice AS close, "
    "l_orderkey AS seq FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def bars_dirty(spark: SparkSession, sf_dir: str, with_delivery: bool = False) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in BARS}
    events = table(spark, sf_dir, "events").selectExpr("*", f"{MOVED_TS} AS moved")
    columns = [f"CAST({DIRTY_COLUMNS[name]} AS {types[name]}) AS {name}" for name in BAR_COLUMNS]
    return events.selectExpr(*columns, *([f"{DELIVERY} AS delivery"] if with_delivery else []))


def bars_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars rolled up from events."""
    hour = F.date_trunc("hour", "ts").cast(NTZ).alias("ts")
    rolled = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("ticker"), hour).agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        F.count("*").cast("double").alias("volume"),
        F.min("event_id").alias("seq"),
    )
    return rolled.withColumn("timeframe", F.lit("1h")).select(*BAR_COLUMNS)


def _orders_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .withColumnsRenamed({"n_name": "ticker", "o_orderpriority": "timeframe"})
    )


def ordered_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was published so far: one bar per order, a series per nation and priority."""
    orders = _orders_of_nations(spark, sf_dir)
    return orders.selectExpr("ticker", "timeframe", "o_orderdate AS ts", "o_totalprice AS close", "o_orderkey AS seq")


def shipped_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What comes next: one bar per line item of the same series, partly at earlier times."""
    lines = table(spark, sf_dir, "lineitem").join(_orders_of_nations(spark, sf_dir), F.expr("l_orderkey = o_orderkey"))
    return lines.selectExpr("ticker", "timeframe", "l_shipdate AS ts", "l_extendedprice AS close", "l_orderkey AS seq")
