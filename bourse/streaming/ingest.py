"""Structured Streaming ingestion.

``silver_stream``: bronze documents landed in a folder are picked up as
they arrive and appended to the silver table through the file sink, which
commits each micro-batch exactly once (its ``_spark_metadata`` log lists
only committed files), so a restarted query neither loses nor repeats
documents. The transform is the batch ``to_silver``.

``bars_stream``: ticks -> bars with an event-time watermark; a bar is
emitted once, when the watermark passes its end, and its state is dropped.
``open_bars`` reads those not emitted yet from the state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from bourse.functions import (FIXED_SPAN_SECONDS, MARKET_ZONE, MONDAY_OFFSET_SECONDS,
                              ingest_epoch_from_path, normalise_span, order_key, safe_div, wall_clock)
from bourse.operators.bars import BAR_COLUMNS, bar_aggregates
from bourse.operators.silver import keep_latest, to_silver
from bourse.schemas import BRONZE_READ, CORRUPT
from bourse.sinks import versions


def read_bronze_stream(spark: SparkSession, folder: str, multi_line: bool = False,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming counterpart of ``read_bronze``: of a versioned folder, the
    documents of every landing as it is completed."""
    if versions.current(spark, folder) is not None:
        folder = f"{folder.rstrip('/')}/_versions/*"
    r = spark.readStream.schema(BRONZE_READ).option("multiLine", multi_line) \
             .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.json(folder)
    src = F.col("_metadata.file_path")
    return raw.select("ticker", "results",
                      F.timestamp_seconds(ingest_epoch_from_path(src)).alias("ingested_at"),
                      src.alias("source_file"), F.col("resultsCount").alias("results_count"),
                      F.col(CORRUPT).alias("corrupt"))


def latest_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The table that ``silver_stream`` appends to, one row for each (date,
    ticker): that of the latest ingest, however often a range was landed."""
    return keep_latest(spark.read.parquet(silver_path))


# The state of a bar, in the order in which Spark keeps ``bar_aggregates``
# (fixed values; tests hold them against batch bars).
_STATE = ["open", "_first", "high", "low", "close", "_last", "trades", "volume", "_money"]


def open_bars(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The bars that a stopped ``bars_stream`` has not emitted yet, as far as
    its ticks go: read from the state that its last batch left in
    ``checkpoint``. No tick is read again. A query that was not made by
    ``bars_stream`` is refused."""
    state = spark.read.format("statestore").load(checkpoint)
    kept = state.schema["value"].dataType.fields
    if len(kept) != len(_STATE):
        raise ValueError(f"{checkpoint} holds no state of bars: {[f.name for f in kept]}")
    # Spark calls two of the values alike; a cast of the whole renames by place.
    bar = F.col("value").cast(StructType([StructField(n, f.dataType) for n, f in zip(_STATE, kept)]))
    return state.select("key.ticker", F.col("key.window.start").alias("_start"), bar.alias("bar")).select("*", "bar.*").select(
        "ticker", _wall_clock_of(F.col("_start")).alias("bar_start"), "open", "high", "low", "close", "trades",
        "volume", safe_div(F.col("_money"), F.col("volume")).alias("vwap"))


def complete_bars(emitted: DataFrame, checkpoint: str) -> DataFrame:
    """All bars of a stopped ``bars_stream``: those it ``emitted``, as they
    are, and those still open. A closed bar that the sink lacks is missing
    here too, and ticks that came too late for theirs stay out of it."""
    return emitted.unionByName(open_bars(emitted.sparkSession, checkpoint))


def _wall_clock_of(start: Column) -> Column:
    """The wall clock of a window's start (its UTC clock, see ``bars_stream``)."""
    return F.timestamp_add("SECOND", F.unix_seconds(start), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def silver_stream(spark: SparkSession, bronze_folder: str, company_map: DataFrame,
                  silver_path: str, checkpoint: str, zone: str = MARKET_ZONE,
                  available_now: bool = True, multi_line: bool = False,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the bronze -> silver stream. ``company_map`` is a static
    DataFrame (stream-static left join). The table keeps every landing;
    ``latest_silver`` reads one row for each key. A corrupt document stops
    the stream, so that nothing of it is lost.
    ``max_files_per_trigger`` bounds each micro-batch when a backlog of
    landed files is caught up."""
    source = read_bronze_stream(spark, bronze_folder, multi_line, max_files_per_trigger)
    checked = source.withColumn("results", F.when(F.col("corrupt").isNull(), F.col("results")).otherwise(
        F.raise_error(F.concat(F.lit("corrupt document in "), F.col("source_file")))))
    silver = to_silver(checked, company_map, zone)
    w = silver.writeStream.format("parquet").option("path", silver_path) \
              .option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def bars_stream(ticks: DataFrame, ticker: str = "ticker", ts: str = "ts", price: str = "price",
                volume: str | None = None, multiplier: int = 1, timespan: str = "minute",
                delay: str = "10 minutes", order_by=None, zone: str | None = None) -> DataFrame:
    """Streaming ``resample_bars`` for fixed spans (second .. week).

    The watermark is on the tick time; a bar is emitted once the watermark
    passes its end (ticks up to ``delay`` late still count) and its state is
    then dropped. Bars are epoch-aligned tumbling windows (weeks from
    Monday), the same buckets as the batch operator; ``order_by`` and
    ``zone`` work as there. Use with ``outputMode("append")``.
    """
    span = normalise_span(timespan, multiplier)
    if span not in FIXED_SPAN_SECONDS:
        raise ValueError(f"streaming bars need a fixed span {tuple(FIXED_SPAN_SECONDS)}")
    width = FIXED_SPAN_SECONDS[span] * multiplier
    order_by = [ts] if order_by is None else ([order_by] if isinstance(order_by, str)
                                               else list(order_by))
    local = wall_clock(F.col(ts), ticks.schema[ts].dataType, zone)
    # Event time as the instant whose UTC wall clock is the tick's wall clock
    # (watermarks need TIMESTAMP); second precision is enough for lateness.
    keyed = ticks.select(
        F.col(ticker).alias("ticker"),
        F.timestamp_seconds(F.unix_timestamp(local)).alias("_evt"),
        F.col(price).alias("_p"),
        (F.col(volume).cast("double") if volume else F.lit(None).cast("double")).alias("_v"),
        order_key(order_by, ticks.schema).alias("_o"),
    ).withWatermark("_evt", delay)
    start = f"{MONDAY_OFFSET_SECONDS if span == 'week' else 0} seconds"
    window = F.window("_evt", f"{width} seconds", f"{width} seconds", start).alias("_w")
    bars = keyed.groupBy("ticker", window).agg(*bar_aggregates())
    return bars.withColumn("bar_start", _wall_clock_of(F.col("_w.start"))).select(*BAR_COLUMNS)
