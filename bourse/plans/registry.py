"""Registered queries: one per operator of the inventory, each built from
the given tables with ``(spark, sf_dir) -> DataFrame``.

Queries that land bronze documents or write CSV first write to a fresh
folder below the session's shared checkpoint folder, then read it back.
Computed columns carry the same names as the DuckDB oracle SQL
(``bourse.plans.oracle``); sums, vwap and CAGR are rounded through DECIMAL
on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.functions import round_half
from bourse.operators import gold, quality
from bourse.operators.bars import bronze_documents, daily, resample_bars, ticks_in_range
from bourse.operators.prices import attach_week, first_last_close, in_range, ticker_count
from bourse.operators.silver import attach_company, explode_results, to_silver
from bourse.schemas import BRONZE
from bourse.session import shared_dir
from bourse.sinks import land_bronze, land_provider_documents, versions, write_calendar
from bourse.sources import fixtures as fx
from bourse.sources.calendar import calendar_spanning
from bourse.sources.readers import read_bronze, read_calendar, read_symbols

# Standard ranges of the fixtures (fixed values).
YEAR_1997 = ("1997-01-01", "1997-12-31")
H1_1997 = ("1997-01-01", "1997-06-30")
# Ingest time stamped on landed test documents, epoch seconds (fixed value).
TEST_INGEST_EPOCH = 1_700_000_000

Query = Callable[[SparkSession, str], DataFrame]


def _prices(spark, d):
    return fx.daily_prices(spark, d)


def _event_prices(spark, d):
    return daily(resample_bars(fx.event_ticks(spark, d)))


# ---- sources ---------------------------------------------------------------

def q_symbols_distinct(spark, d):
    orders = fx.table(spark, d, "orders").select("o_custkey")
    cust = fx.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    listing = orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("symbol"), F.col("c_mktsegment").alias("company_name"))
    path = shared_dir(spark, "bourse", "symbols")
    listing.write.option("header", True).csv(path)
    return read_symbols(spark, path)


def q_calendar_iso(spark, d):
    return calendar_spanning(fx.table(spark, d, "orders"), "o_orderdate")


# ---- bars ------------------------------------------------------------------

def q_bars_daily(spark, d):
    return fx.order_bars(spark, d)


def q_bars_hourly(spark, d):
    return resample_bars(fx.event_ticks(spark, d), multiplier=1, timespan="hour")


def _event_bars(spark, d):
    return resample_bars(fx.event_ticks(spark, d), timespan="hour")


def q_bars_15min(spark, d):
    return resample_bars(fx.event_ticks(spark, d), multiplier=15, timespan="minute")


def q_bars_weekly(spark, d):
    return resample_bars(fx.order_ticks(spark, d), timespan="week", order_by="seq")


def q_bars_monthly(spark, d):
    bars = resample_bars(fx.lineitem_ticks(spark, d), volume="volume", timespan="month",
                         order_by=fx.LINEITEM_TICK_ORDER)
    return bars.withColumn("vwap", round_half(F.col("vwap"), 6))


def q_bars_vwap(spark, d):
    return fx.lineitem_bars(spark, d).withColumn("vwap", round_half(F.col("vwap"), 6))


# ---- bronze / silver -------------------------------------------------------

def _landed_f1(spark, d, zone="UTC"):
    root = shared_dir(spark, "bourse", "bronze")
    return land_bronze(fx.order_bars(spark, d), root, zone=zone,
                       ingest_epoch=TEST_INGEST_EPOCH)


def q_bronze_documents(spark, d):
    docs = bronze_documents(fx.order_bars(spark, d), zone="UTC", period="month")
    return docs.select(
        "ticker", "period", F.col("resultsCount").alias("n_results"),
        F.col("results")[0]["t"].alias("first_t"),
        F.element_at("results", -1)["t"].alias("last_t"))


def q_bronze_explode(spark, d):
    bronze = read_bronze(spark, _landed_f1(spark, d))
    return explode_results(bronze).select(
        "ticker", F.col("bar.c").alias("close"), F.col("bar.h").alias("high"),
        F.col("bar.l").alias("low"), F.col("bar.n").alias("trades"),
        F.col("bar.o").alias("open"), F.col("bar.t").alias("t"),
        F.col("bar.v").alias("volume"), F.col("bar.vw").alias("vwap"))


def q_silver_from_bronze(spark, d):
    bronze = read_bronze(spark, _landed_f1(spark, d))
    silver = to_silver(bronze, fx.company_map(spark, d), zone="UTC")
    cols = [c for c in silver.columns if c != "ingested_at"]
    return silver.select(*cols, F.unix_seconds("ingested_at").alias("ingest_epoch"))


def q_silver_build(spark, d):
    """B1 end to end: company map CSV, schema + key validation, Parquet."""
    from bourse.plans.job import build_silver
    from bourse.sources.readers import read_company_map
    folder = _landed_f1(spark, d)
    map_csv = shared_dir(spark, "bourse", "company_map")
    fx.company_map(spark, d).write.option("header", True).csv(map_csv)
    silver = build_silver(spark, folder, read_company_map(spark, map_csv),
                          shared_dir(spark, "bourse", "silver"), zone="UTC")
    cols = [c for c in silver.columns if c != "ingested_at"]
    return silver.select(*cols, F.unix_seconds("ingested_at").alias("ingest_epoch"))


def q_silver_stream(spark, d):
    """B1 on Structured Streaming: landed documents -> exactly-once file sink."""
    from bourse.streaming.ingest import latest_silver, silver_stream
    root = shared_dir(spark, "bourse", "stream")
    q = silver_stream(spark, _landed_f1(spark, d), fx.company_map(spark, d),
                      f"{root}/silver", f"{root}/checkpoint", zone="UTC")
    q.awaitTermination()
    silver = latest_silver(spark, f"{root}/silver")
    cols = [c for c in silver.columns if c != "ingested_at"]
    return silver.select(*cols, F.unix_seconds("ingested_at").alias("ingest_epoch"))


def q_bars_stream_hourly(spark, d):
    """S7 on Structured Streaming: a bar is emitted once its hour has passed;
    bars still open when the stream stops come from its state."""
    from bourse.streaming.ingest import bars_stream, complete_bars
    # The star takes a table in one file and one in a folder of files alike.
    src = spark.readStream.schema(fx.table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    ticks = src.select(F.col("user_id").cast("string").alias("ticker"), "ts",
                       F.col("value").alias("price"))
    root = shared_dir(spark, "bourse", "stream")
    q = bars_stream(ticks, timespan="hour", delay="0 seconds").writeStream \
        .format("parquet").option("path", f"{root}/bars") \
        .option("checkpointLocation", f"{root}/checkpoint").outputMode("append") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return complete_bars(spark.read.schema(_event_bars(spark, d).schema).parquet(f"{root}/bars"), f"{root}/checkpoint")


def q_company_left_join(spark, d):
    """Parts' bars against the suppliers' names: most part numbers are no
    supplier's number and keep a NULL name."""
    bars = daily(fx.lineitem_bars(spark, d, key="l_partkey")).select("ticker", "date", "close")
    names = fx.table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("symbol"), F.col("s_name").alias("company_name"))
    return attach_company(bars, names)


def q_corrupt_documents(spark, d):
    """Documents made from orders, as landed by hand: those of urgent orders
    are cut off, those of high-priority orders hold a price that is a word."""
    orders = fx.table(spark, d, "orders")
    price = F.when(F.col("o_orderpriority") == "2-HIGH", F.lit('"high"')) \
             .otherwise(F.col("o_totalprice").cast("string"))
    whole = F.format_string('{"ticker":"%s","resultsCount":1,"results":[{"c":%s,"t":0}]}',
                            F.col("o_orderkey").cast("string"), price)
    text = F.when(F.col("o_orderpriority") == "1-URGENT", F.substring(whole, 1, 24)).otherwise(whole)
    folder = f"{shared_dir(spark, 'bourse', 'bronze')}/ingest={TEST_INGEST_EPOCH}"
    orders.select(text.alias("value")).write.text(folder)
    return quality.corrupt_documents(read_bronze(spark, folder)).select("document")


def q_silver_from_provider_docs(spark, d):
    """The provider's own layout: a pretty-printed document for each ticker,
    the ingest time in its file name, bar starts at midnight in New York."""
    folder = land_provider_documents(fx.order_bars(spark, d), shared_dir(spark, "bourse", "provider"),
                                     ingest_epoch=TEST_INGEST_EPOCH)
    silver = to_silver(read_bronze(spark, folder, multi_line=True), fx.company_map(spark, d))
    return _with_epoch(silver)


def _with_epoch(silver):
    cols = [c for c in silver.columns if c != "ingested_at"]
    return silver.select(*cols, F.unix_seconds("ingested_at").alias("ingest_epoch"))


def q_silver_incremental(spark, d):
    """B1 over a landing for each year, then again after one year has landed
    anew: only that year is built the second time."""
    from bourse.plans.job import build_silver
    root = shared_dir(spark, "bourse", "incremental")
    ticks, company = fx.order_ticks(spark, d), fx.company_map(spark, d)

    def land(year):
        dates = (f"{year}-01-01", f"{year}-12-31")
        bars = resample_bars(ticks_in_range(ticks, dates), order_by="seq")
        return land_bronze(bars, f"{root}/bronze", dates=dates, zone="UTC", ingest_epoch=TEST_INGEST_EPOCH)

    years = [r.y for r in ticks.select(F.year("ts").alias("y")).distinct().orderBy("y").collect()]
    folders = [land(y) for y in years]
    build_silver(spark, folders, company, f"{root}/silver", zone="UTC", incremental=True)
    land(years[0])
    return _with_epoch(build_silver(spark, folders, company, f"{root}/silver", zone="UTC", incremental=True))


def q_schema_drift(spark, d):
    """Q1: the schema that landed documents show by themselves, against the
    bronze schema. Bars without a volume have no such field."""
    inferred = spark.read.json(versions.folders(spark, _landed_f1(spark, d)))
    return quality.schema_diff(spark, inferred, BRONZE)


def _job_gold(spark, d, years, calendar_csv=None):
    """The whole job over orders (bronze, silver, the gold files of
    ``years``), its files read back."""
    from bourse.plans.job import GOLD_OUTPUTS, run
    root = shared_dir(spark, "bourse", "job")
    fx.company_map(spark, d).write.option("header", True).csv(f"{root}/symbols")
    run(spark, ticks=fx.order_ticks(spark, d), symbols_csv=f"{root}/symbols", bronze_root=f"{root}/bronze",
        silver_path=f"{root}/silver", gold_root=f"{root}/gold", years=years, do_bronze=True,
        do_silver=True, do_gold=True, zone="UTC", order_by="seq", ingest_epoch=TEST_INGEST_EPOCH, calendar_csv=calendar_csv)

    def rows(year, key, ticker, label, value):
        df = spark.read.option("header", True).csv(f"{root}/gold/{GOLD_OUTPUTS[key].format(year=year)}")
        return df.select(F.lit(year).alias("job_year"), F.lit(key).alias("output"), ticker.cast("string").alias("ticker"),
                         label.cast("string").alias("label"),
                         round_half(F.col(value).cast("double"), 4).alias("value"))

    none, out = F.lit(None), None
    for y in years:
        for part in (rows(y, "a", F.col("ticker"), none, "net_change"),
                     rows(y, "b", none, F.col("year"), "investment_value"),
                     rows(y, "c", F.col("ticker"), F.col("year"), "CAGR"),
                     rows(y, "d", F.col("ticker"), F.col("date"), "net_change"),
                     rows(y, "summary", F.col("max_relative_increase_ticker"), F.concat_ws(
                         " ", "max_CAGR_ticker_jan_june", "max_decrease_by_week_ticker", "max_decrease_by_week_weeknum"),
                         "investment_return_by_end_of_year")):
            out = part if out is None else out.unionByName(part)
    return out


def q_job_gold(spark, d):
    """M1 and K3: the five gold files of the job for 1997, read back."""
    return _job_gold(spark, d, [1997]).drop("job_year")


def q_job_gold_two_years(spark, d):
    """M1 for two years, as it is run: ISO weeks across the turn of the year,
    and each year's pass over silver opens its own part only."""
    return _job_gold(spark, d, [1996, 1997])


def q_job_gold_calendar(spark, d):
    """M1 with the weeks of d. from a calendar file: that of the ship days,
    which begins after the first order days."""
    path = shared_dir(spark, "bourse", "calendar")
    write_calendar(calendar_spanning(fx.table(spark, d, "lineitem"), "l_shipdate"), csv_path=path)
    return _job_gold(spark, d, [1997], calendar_csv=path).drop("job_year")


def q_keep_latest(spark, d):
    """Two landings of the same tickers; the later one wins for every (date,
    ticker) it holds. A second landing must differ from the first to show
    that, so it is made of the finished orders; all rows of both are read."""
    root = shared_dir(spark, "bourse", "bronze")
    folder = land_bronze(fx.order_bars(spark, d), root, zone="UTC",
                         ingest_epoch=TEST_INGEST_EPOCH)
    ticks = fx.order_ticks(spark, d)
    finished = fx.table(spark, d, "orders").filter(F.col("o_orderstatus") == "F") \
                 .select(F.col("o_orderkey").alias("seq"))
    later = resample_bars(ticks.join(finished, "seq", "left_semi"), order_by="seq")
    land_bronze(later, root, zone="UTC", ingest_epoch=TEST_INGEST_EPOCH + 86400, mode="append")
    bronze = read_bronze(spark, folder)
    silver = to_silver(bronze, fx.company_map(spark, d), zone="UTC", keep="latest")
    cols = [c for c in silver.columns if c != "ingested_at"]
    return silver.select(*cols, F.unix_seconds("ingested_at").alias("ingest_epoch"))


# ---- range / aggregates ----------------------------------------------------

def q_date_range_filter(spark, d):
    return in_range(_prices(spark, d), YEAR_1997).select("ticker", "date", "close")


def q_first_last_close(spark, d):
    return first_last_close(_prices(spark, d), "ticker")


def q_ticker_count(spark, d):
    return ticker_count(_prices(spark, d))


# ---- gold ------------------------------------------------------------------

def q_relative_change(spark, d):
    return gold.relative_change(_prices(spark, d))


def q_relative_change_by_year(spark, d):
    """The rank states the order, which rows compared as a set don't show."""
    return gold.relative_change_by_year(_prices(spark, d), ranked=True)


def q_max_relative_increase(spark, d):
    return gold.max_relative_increase(_prices(spark, d))


def q_max_relative_increase_1997(spark, d):
    return gold.max_relative_increase(fx.daily_prices(spark, d, YEAR_1997), YEAR_1997)


def q_position_values(spark, d):
    return gold.position_values(_prices(spark, d))


def q_investment_return(spark, d):
    r = gold.investment_return(_prices(spark, d))
    return r.withColumn("investment_value", round_half(F.col("investment_value"), 4))


def q_investment_return_1997(spark, d):
    r = gold.investment_return(fx.daily_prices(spark, d, YEAR_1997), YEAR_1997)
    return r.withColumn("investment_value", round_half(F.col("investment_value"), 4))


def q_growth_rate(spark, d):
    r = gold.growth_rate(_prices(spark, d))
    return r.withColumn("CAGR", round_half(F.col("CAGR"), 6))


def q_max_cagr(spark, d):
    r = gold.max_cagr(fx.daily_prices(spark, d, H1_1997), H1_1997)
    return r.withColumn("CAGR", round_half(F.col("CAGR"), 6))


def q_max_cagr_all(spark, d):
    r = gold.max_cagr(_prices(spark, d))
    return r.withColumn("CAGR", round_half(F.col("CAGR"), 6))


def q_day_values(spark, d):
    return gold.day_values(_prices(spark, d))


def q_weekly_change(spark, d):
    return gold.weekly_change(_prices(spark, d))


def q_weekly_change_events(spark, d):
    return gold.weekly_change(_event_prices(spark, d))


def q_max_weekly_decrease(spark, d):
    return gold.max_weekly_decrease(_prices(spark, d))


def q_weekly_change_by_day(spark, d):
    return gold.weekly_change_by_day(_prices(spark, d))


def q_weekly_change_by_day_1997(spark, d):
    return gold.weekly_change_by_day(fx.daily_prices(spark, d, YEAR_1997), YEAR_1997)


def q_week_join_calendar(spark, d):
    """Order days against the calendar of the ship days: days before the first
    and after the last ship day are not on it."""
    path = shared_dir(spark, "bourse", "calendar")
    write_calendar(calendar_spanning(fx.table(spark, d, "lineitem"), "l_shipdate"), csv_path=path)
    return attach_week(_prices(spark, d).select("ticker", "date", "close"), read_calendar(spark, path))


def q_week_join_calendar_parquet(spark, d):
    path = shared_dir(spark, "bourse", "calendar")
    write_calendar(calendar_spanning(fx.table(spark, d, "lineitem"), "l_shipdate"), parquet_path=path)
    return attach_week(_prices(spark, d).select("ticker", "date", "close"), read_calendar(spark, path, fmt="parquet"))


def _rounded_summary(df):
    return df.withColumn("investment_return_by_end_of_year",
                         round_half(F.col("investment_return_by_end_of_year"), 4))


def q_consolidate(spark, d):
    p = fx.daily_prices(spark, d, YEAR_1997)
    return _rounded_summary(gold.consolidate(p, YEAR_1997, growth_dates=H1_1997))


def q_consolidate_all(spark, d):
    return _rounded_summary(gold.consolidate(_prices(spark, d)))


# ---- quality ---------------------------------------------------------------

def q_duplicate_keys(spark, d):
    return quality.duplicate_keys(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _order_book_bars(spark, d):
    return fx.lineitem_bars(spark, d, key="l_orderkey")


def q_landed_completeness(spark, d):
    root = shared_dir(spark, "bourse", "bronze")
    folder = land_bronze(_order_book_bars(spark, d), root, ingest_epoch=TEST_INGEST_EPOCH)
    return quality.landed_completeness(read_bronze(spark, folder), fx.order_symbols(spark, d))


def q_missing_results(spark, d):
    root = shared_dir(spark, "bourse", "bronze")
    folder = land_bronze(_order_book_bars(spark, d), root, symbols=fx.order_symbols(spark, d),
                         ingest_epoch=TEST_INGEST_EPOCH)
    return quality.missing_results(read_bronze(spark, folder))


QUERIES: dict[str, Query] = {
    "symbols_distinct": q_symbols_distinct,
    "calendar_iso": q_calendar_iso,
    "bars_daily": q_bars_daily,
    "bars_hourly": q_bars_hourly,
    "bars_15min": q_bars_15min,
    "bars_vwap": q_bars_vwap,
    "bars_weekly": q_bars_weekly,
    "bars_monthly": q_bars_monthly,
    "bronze_documents": q_bronze_documents,
    "bronze_explode": q_bronze_explode,
    "silver_from_bronze": q_silver_from_bronze,
    "silver_build": q_silver_build,
    "silver_stream": q_silver_stream,
    "bars_stream_hourly": q_bars_stream_hourly,
    "company_left_join": q_company_left_join,
    "keep_latest": q_keep_latest,
    "date_range_filter": q_date_range_filter,
    "first_last_close": q_first_last_close,
    "ticker_count": q_ticker_count,
    "relative_change": q_relative_change,
    "relative_change_by_year": q_relative_change_by_year,
    "max_relative_increase": q_max_relative_increase,
    "max_relative_increase_1997": q_max_relative_increase_1997,
    "position_values": q_position_values,
    "investment_return": q_investment_return,
    "investment_return_1997": q_investment_return_1997,
    "growth_rate": q_growth_rate,
    "max_cagr": q_max_cagr,
    "max_cagr_all": q_max_cagr_all,
    "day_values": q_day_values,
    "weekly_change": q_weekly_change,
    "weekly_change_events": q_weekly_change_events,
    "max_weekly_decrease": q_max_weekly_decrease,
    "weekly_change_by_day": q_weekly_change_by_day,
    "weekly_change_by_day_1997": q_weekly_change_by_day_1997,
    "week_join_calendar": q_week_join_calendar,
    "consolidate": q_consolidate,
    "consolidate_all": q_consolidate_all,
    "duplicate_keys": q_duplicate_keys,
    "landed_completeness": q_landed_completeness,
    "missing_results": q_missing_results,
    "corrupt_documents": q_corrupt_documents,
    "week_join_calendar_parquet": q_week_join_calendar_parquet,
    "job_gold": q_job_gold,
    "job_gold_two_years": q_job_gold_two_years,
    "job_gold_calendar": q_job_gold_calendar,
    "silver_from_provider_docs": q_silver_from_provider_docs,
    "silver_incremental": q_silver_incremental,
    "schema_drift": q_schema_drift,
}
