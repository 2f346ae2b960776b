"""Price data derived from the TPC-H-style test tables.

F1  order ticks: orders x customer x nation; ticker = nation name,
    tick time = o_orderdate, price = o_totalprice, tick order = o_orderkey.
F3  event ticks: events; ticker = user_id, time = ts, price = value.
F4  priced volume: lineitem; ticker = l_suppkey, time = l_shipdate,
    price = l_extendedprice / l_quantity, volume = l_quantity.
F4b order book: lineitem keyed by order (ticker = l_orderkey); the symbol
    list is every order, so orders without line items are symbols that
    return no data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.operators.bars import daily, resample_bars, ticks_in_range

# Order keys that make the first / last tick unique (fixed values).
LINEITEM_TICK_ORDER = ["ts", "l_orderkey", "l_linenumber", "l_partkey",
                       "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_ticks(spark: SparkSession, sf_dir: str, dates=None) -> DataFrame:
    """F1 ticks: (ticker, ts, price, seq)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    orders = ticks_in_range(orders, dates, ts="o_orderdate")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey") \
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_name").alias("ticker"))
    return orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        "ticker", F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("seq"))


def order_bars(spark: SparkSession, sf_dir: str, dates=None) -> DataFrame:
    """F1 day bars with ``bar_start``."""
    return resample_bars(order_ticks(spark, sf_dir, dates), order_by="seq")


def daily_prices(spark: SparkSession, sf_dir: str, dates=None) -> DataFrame:
    """F1 daily series: ticker, date, open, high, low, close, trades, ..."""
    return daily(order_bars(spark, sf_dir, dates))


def company_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company map for F1 tickers: nation name -> region name."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_name").alias("symbol"), F.col("r_name").alias("company_name"))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 ticks: (ticker, ts, price)."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ticker"), "ts", F.col("value").alias("price"))


def lineitem_ticks(spark: SparkSession, sf_dir: str, key: str = "l_suppkey") -> DataFrame:
    """F4 ticks: (ticker, ts, price, volume, tie-break keys...)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col(key).cast("string").alias("ticker"), F.col("l_shipdate").alias("ts"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("volume"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")


def lineitem_bars(spark: SparkSession, sf_dir: str, key: str = "l_suppkey") -> DataFrame:
    return resample_bars(lineitem_ticks(spark, sf_dir, key), volume="volume",
                         order_by=LINEITEM_TICK_ORDER)


def order_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4b symbol list: every order (symbol, company_name = priority)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("symbol"),
        F.col("o_orderpriority").alias("company_name"))
