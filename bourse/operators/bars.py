"""Ticks -> OHLCV bars (S7) and bars -> bronze documents (K1 shape).

``resample_bars`` computes, on Spark, the eight fields a market-data
provider returns for ``multiplier`` x ``timespan`` aggregates: open, high,
low, close, trades, volume, vwap and bar start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.functions import (MARKET_ZONE, bucket_key, bucket_key_start, in_time_range,
                              local_to_epoch_ms, order_key, safe_div)

BAR_COLUMNS = ["ticker", "bar_start", "open", "high", "low", "close",
               "trades", "volume", "vwap"]


def ticks_in_range(ticks: DataFrame, dates, ts: str = "ts", zone: str | None = None) -> DataFrame:
    """Ticks whose time falls in the inclusive date range; the predicate is
    on the raw column, so it is pushed to the Parquet scan."""
    cond = in_time_range(F.col(ts), ticks.schema[ts].dataType, dates, zone)
    return ticks if cond is None else ticks.filter(cond)


def resample_bars(ticks: DataFrame, ticker: str = "ticker", ts: str = "ts",
                  price: str = "price", volume: str | None = None,
                  multiplier: int = 1, timespan: str = "day",
                  order_by=None, zone: str | None = None) -> DataFrame:
    """One bar per (ticker, bucket).

    open/close are the price of the first/last tick by ``order_by`` (default
    the timestamp; pass extra columns to break ties deterministically),
    high/low the extremes, trades the tick count, volume the summed volume,
    vwap = sum(price * volume) / sum(volume). Without ``volume`` both are
    NULL. ``order_by`` is the complete tick order (default the timestamp;
    put the timestamp first and add columns to break ties). TIMESTAMP tick
    times are bucketed on the wall clock of ``zone`` (session zone if None);
    TIMESTAMP_NTZ times are wall clocks already. All aggregates have a
    partial step, so hot tickers are combined
    map-side before the shuffle. They are hash aggregates if the order is one
    column, or columns that fit one number (``order_key``: a time and a whole
    number, say); by any other order each task sorts its ticks. Ticks are grouped on an integer bucket key;
    the bar's timestamp is built once per bar, after aggregation.
    """
    order_by = [ts] if order_by is None else ([order_by] if isinstance(order_by, str)
                                               else list(order_by))
    dtype = ticks.schema[ts].dataType
    bucketed = ticks.select(
        F.col(ticker).alias("ticker"),
        bucket_key(F.col(ts), multiplier, timespan, dtype, zone).alias("_k"),
        F.col(price).alias("_p"),
        (F.col(volume).cast("double") if volume else F.lit(None).cast("double")).alias("_v"),
        order_key(order_by, ticks.schema).alias("_o"),
    )
    bars = bucketed.groupBy("ticker", "_k").agg(*bar_aggregates())
    return bars.select("ticker", bucket_key_start(F.col("_k"), timespan).alias("bar_start"),
                       *BAR_COLUMNS[2:])


def bar_aggregates(price: str = "_p", volume: str = "_v", order: str = "_o") -> list[Column]:
    """The OHLCV aggregates of a bar, shared by batch and streaming bars."""
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.count(F.lit(1)).alias("trades"),
        F.sum(volume).alias("volume"),
        safe_div(F.sum(F.col(price) * F.col(volume)), F.sum(volume)).alias("vwap"),
    ]


def daily(bars: DataFrame) -> DataFrame:
    """Day bars as a price series keyed by (ticker, date)."""
    return bars.withColumn("date", F.to_date("bar_start")).drop("bar_start")


# Document period per bar width, so one document holds at most about
# 86,400 second bars, 1,440 minute bars, 744 hour bars or 31 day bars
# (fixed values).
DOCUMENT_PERIOD = {"second": "day", "minute": "day", "hour": "month", "day": "month",
                   "week": "year", "month": "year", "quarter": "year", "year": "year"}


def document_period(timespan: str) -> str:
    """The bronze document period that keeps arrays bounded for ``timespan`` bars."""
    return DOCUMENT_PERIOD[timespan.lower().rstrip("s")]


_PERIOD_UNITS = {"week": "week", "month": "month", "quarter": "quarter", "year": "year"}


def bronze_documents(bars: DataFrame, zone: str = MARKET_ZONE, period: str = "month",
                     symbols: DataFrame | None = None) -> DataFrame:
    """Nest bars into provider-style documents: (ticker, period, resultsCount,
    results array<struct<c,h,l,n,o,t,v,vw>> sorted by t).

    One document per ticker and ``period`` (month by default) keeps every
    array bounded by the bars of one period, so a hot ticker is split into
    many documents instead of one unbounded array; ``document_period`` names
    the period that suits a bar width. A period is required.

    ``t`` is the bar start read as wall-clock time in ``zone``, in epoch ms.
    With ``symbols`` (column ``symbol``), requested symbols without bars get
    a document whose ``results`` is missing, as a provider answers for an
    unknown or silent ticker.
    """
    t = local_to_epoch_ms(F.col("bar_start"), zone)
    if period not in ("day", *_PERIOD_UNITS):
        raise ValueError(f"period must be day, week, month, quarter or year, not {period!r}")
    if period == "day":
        per = F.to_date("bar_start")
    else:
        per = F.trunc(F.to_date("bar_start"), _PERIOD_UNITS[period])
    keyed = bars.select(
        "ticker", per.alias("period"),
        F.struct(t.alias("t"), F.col("close").alias("c"), F.col("high").alias("h"),
                 F.col("low").alias("l"), F.col("trades").cast("bigint").alias("n"),
                 F.col("open").alias("o"), F.col("volume").alias("v"),
                 F.col("vwap").alias("vw")).alias("bar"))
    docs = keyed.groupBy("ticker", "period").agg(
        F.sort_array(F.collect_list("bar")).alias("_bars"))
    # sorted by t (first struct field); then put fields in provider order
    docs = docs.select(
        "ticker", "period", F.size("_bars").cast("bigint").alias("resultsCount"),
        F.transform("_bars", lambda b: F.struct(
            b["c"].alias("c"), b["h"].alias("h"), b["l"].alias("l"), b["n"].alias("n"),
            b["o"].alias("o"), b["t"].alias("t"), b["v"].alias("v"), b["vw"].alias("vw"),
        )).alias("results"))
    if symbols is None:
        return docs
    # Catalyst drops the bar aggregation here: this reads only the ticker
    # column and de-duplicates it map-side.
    landed = bars.select("ticker").distinct()
    silent = symbols.select(F.col("symbol").alias("ticker")).distinct() \
                    .join(landed, "ticker", "left_anti")
    empty = silent.select("ticker", F.lit(None).cast("date").alias("period"),
                          F.lit(0).cast("bigint").alias("resultsCount"),
                          F.lit(None).cast(docs.schema["results"].dataType).alias("results"))
    return docs.unionByName(empty)
