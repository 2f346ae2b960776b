"""Bars, bronze documents and the bronze -> silver transform."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from bourse.operators import quality
from bourse.operators.bars import bronze_documents, daily, resample_bars
from bourse.operators.silver import explode_results, to_silver
from bourse.schemas import SILVER
from bourse.session import local_path, shared_dir
from bourse.sinks import land_bronze, versions
from bourse.sources import fixtures as fx
from bourse.sources.readers import bronze_files, read_bronze, read_company_map, read_symbols
from tests.conftest import SF0001, rows

TS = dt.datetime


def ticks(spark):
    data = [("A", TS(2024, 1, 1, 9, 30), 10.0, 100.0, 1),
            ("A", TS(2024, 1, 1, 9, 45), 12.0, 50.0, 2),
            ("A", TS(2024, 1, 1, 9, 45), 11.0, 50.0, 3),   # same ts: seq breaks the tie
            ("A", TS(2024, 1, 1, 15, 0), 9.0, 200.0, 4),
            ("A", TS(2024, 1, 2, 10, 0), 13.0, 10.0, 5),
            ("B", TS(2024, 1, 1, 11, 0), 5.0, 1.0, 6)]
    df = spark.createDataFrame(data, "ticker string, ts timestamp_ntz, price double, qty double, seq long")
    return df.repartition(3)


def test_resample_day_bars(spark):
    b = resample_bars(ticks(spark), volume="qty", order_by=["ts", "seq"])
    got = {(r.ticker, r.bar_start): r for r in b.collect()}
    a1 = got[("A", TS(2024, 1, 1))]
    assert (a1.open, a1.high, a1.low, a1.close, a1.trades) == (10.0, 12.0, 9.0, 9.0, 4)
    assert a1.volume == 400.0
    assert a1.vwap == pytest.approx((10 * 100 + 12 * 50 + 11 * 50 + 9 * 200) / 400)
    assert got[("A", TS(2024, 1, 2))].close == 13.0
    assert got[("B", TS(2024, 1, 1))].vwap == 5.0


def test_resample_minute_bars_and_tie_order(spark):
    b = resample_bars(ticks(spark), multiplier=15, timespan="minute", order_by=["ts", "seq"])
    got = {(r.ticker, r.bar_start): r for r in b.collect()}
    bar = got[("A", TS(2024, 1, 1, 9, 45))]
    assert (bar.open, bar.close, bar.trades) == (12.0, 11.0, 2)
    assert bar.volume is None and bar.vwap is None


def test_resample_rejects_bad_span(spark):
    with pytest.raises(ValueError):
        resample_bars(ticks(spark), timespan="fortnight")


def test_bronze_documents_shape(spark):
    bars = resample_bars(ticks(spark), volume="qty", order_by=["ts", "seq"])
    docs = bronze_documents(bars, zone="UTC", period="month")
    a = docs.filter(F.col("ticker") == "A").first()
    assert a.resultsCount == 2
    assert [r.t for r in a.results] == sorted(r.t for r in a.results)
    assert a.results[0].t == 1704067200000  # 2024-01-01 00:00 UTC
    assert list(a.results[0].asDict()) == ["c", "h", "l", "n", "o", "t", "v", "vw"]
    # default: bar start read as market time (midnight in New York)
    a_ny = bronze_documents(bars).filter(F.col("ticker") == "A").first()
    assert a_ny.results[0].t == 1704085200000


def test_bronze_documents_split_by_period(spark):
    bars = fx.order_bars(spark, SF0001)
    per_month = bronze_documents(bars, period="month")
    assert per_month.agg(F.sum("resultsCount")).first()[0] == bars.count()
    assert per_month.groupBy("ticker", "period").count().filter("count > 1").count() == 0


def test_round_trip_bars_bronze_silver(spark):
    bars = fx.order_bars(spark, SF0001)
    folder = land_bronze(bars, shared_dir(spark, "t", "bronze"), zone="America/New_York",
                         ingest_epoch=1_700_000_000)
    bronze = read_bronze(spark, folder)
    cmap = fx.company_map(spark, SF0001)
    silver = to_silver(bronze, cmap, zone="America/New_York")
    assert silver.schema == SILVER
    quality.assert_schema(silver, SILVER)
    quality.assert_primary_key(silver, ["date", "ticker"])
    want = rows(daily(bars), "ticker", "date", "open", "high", "low", "close", "trades")
    got = rows(silver, "ticker", "date", "open", "high", "low", "close", "trades")
    assert got == want
    assert silver.filter(F.col("ingested_at").isNull()).count() == 0


def _write_docs(folder, docs, one_per_file):
    os.makedirs(folder, exist_ok=True)
    if one_per_file:
        for name, doc in docs:
            with open(os.path.join(folder, name), "w") as f:
                json.dump(doc, f, indent=2)
    else:
        with open(os.path.join(folder, "all_1700000000.json"), "w") as f:
            for _, doc in docs:
                f.write(json.dumps(doc) + "\n")


def _provider_docs():
    bar = {"c": 10.5, "h": 11.0, "l": 10.0, "n": 3, "o": 10.2, "t": 1672722000000, "v": 100,
           "vw": 10.4}
    return [
        ("NVDA_1741000000.json", {"ticker": "NVDA", "status": "OK", "adjusted": True,
                                  "results": [bar, dict(bar, t=1672808400000, c=11.0)]}),
        ("EMPTY_1741000000.json", {"ticker": "EMPTY", "results": []}),
        ("NORES_1741000000.json", {"ticker": "NORES", "status": "OK"}),
        ("ZZZ_1741000000.json", {"ticker": "ZZZ", "results": [bar]}),
    ]


def test_provider_documents_to_silver(spark):
    root = local_path(shared_dir(spark, "t", "provider"))
    _write_docs(root, _provider_docs(), one_per_file=True)
    cmap_path = os.path.join(root + "_map", "stocks.csv")
    os.makedirs(os.path.dirname(cmap_path))
    with open(cmap_path, "w") as f:
        f.write("symbol,company_name\nNVDA,NVIDIA Corp\nEMPTY,Empty Inc\nNORES,No Results\n")
    bronze = read_bronze(spark, root, multi_line=True)
    missing = sorted(r.ticker for r in quality.missing_results(bronze).collect())
    assert missing == ["EMPTY", "NORES"]
    silver = to_silver(bronze, read_company_map(spark, cmap_path))
    got = {(r.ticker, r.date): r for r in silver.collect()}
    # whole-number volumes still land as DOUBLE (explicit schema, no inference)
    assert silver.schema == SILVER
    nv = got[("NVDA", dt.date(2023, 1, 3))]
    assert (nv.company_name, nv.close, nv.trades, nv.volume) == ("NVIDIA Corp", 10.5, 3, 100.0)
    assert nv.ingested_at is not None
    assert got[("ZZZ", dt.date(2023, 1, 3))].company_name is None
    assert ("NVDA", dt.date(2023, 1, 4)) in got
    symbols = read_symbols(spark, cmap_path)
    assert rows(quality.landed_completeness(bronze, symbols)) == []


def test_multiline_on_json_lines_keeps_first_record_only(spark):
    root = local_path(shared_dir(spark, "t", "jsonl"))
    _write_docs(root, _provider_docs(), one_per_file=False)
    assert read_bronze(spark, root, multi_line=False).count() == 4
    assert read_bronze(spark, root, multi_line=True).count() == 1


def test_time_zone_of_bar_date(spark):
    root = local_path(shared_dir(spark, "t", "tz"))
    _write_docs(root, _provider_docs()[:1], one_per_file=True)
    bronze = read_bronze(spark, root, multi_line=True)
    cmap = spark.createDataFrame([], "symbol string, company_name string")
    ny = {r.date for r in to_silver(bronze, cmap, zone="America/New_York").collect()}
    la = {r.date for r in to_silver(bronze, cmap, zone="America/Los_Angeles").collect()}
    assert dt.date(2023, 1, 3) in ny and dt.date(2023, 1, 2) in la


def test_relanding_duplicates_and_keep_latest(spark):
    bars = fx.order_bars(spark, SF0001)
    root = shared_dir(spark, "t", "bronze")
    folder = land_bronze(bars, root, ingest_epoch=100, zone="UTC")
    land_bronze(bars.withColumn("close", F.col("close") + 1), root, ingest_epoch=200,
                zone="UTC", mode="append")
    bronze = read_bronze(spark, folder)
    cmap = fx.company_map(spark, SF0001)
    strict = to_silver(bronze, cmap, zone="UTC")
    with pytest.raises(quality.ValidationError):
        quality.assert_primary_key(strict, ["date", "ticker"])
    latest = to_silver(bronze, cmap, zone="UTC", keep="latest")
    quality.assert_primary_key(latest, ["date", "ticker"])
    want = rows(daily(bars).withColumn("close", F.col("close") + 1), "ticker", "date", "close")
    assert rows(latest, "ticker", "date", "close") == want


def test_land_bronze_overwrites_range_folder(spark):
    from bourse.operators.bars import ticks_in_range
    rng = ("1996-01-01", "1996-12-31")
    ticks = ticks_in_range(fx.order_ticks(spark, SF0001), rng)
    plan = ticks._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan          # pushed to the scan
    bars = resample_bars(ticks, order_by="seq")
    root = shared_dir(spark, "t", "bronze")
    f1 = land_bronze(bars, root, dates=rng, ingest_epoch=1)
    f2 = land_bronze(bars, root, dates=rng, ingest_epoch=2)
    assert f1 == f2 and f1.endswith("1996-01-01_1996-12-31")
    b = read_bronze(spark, f1)
    assert b.select(F.unix_seconds("ingested_at").alias("e")).distinct().first().e == 2
    assert b.select("ingested_at").distinct().count() == 1
    dates = explode_results(b).select(F.min("bar.t"), F.max("bar.t")).first()
    # 1996-01-01 and 1997-01-01 at midnight in New York, in epoch ms
    assert dates[0] >= 820472400000 and dates[1] < 852094800000


def test_company_map_by_header_name(spark):
    path = local_path(shared_dir(spark, "t", "map"))
    os.makedirs(path)
    with open(os.path.join(path, "m.csv"), "w") as f:
        f.write("company_name,symbol\nAcme Corp,A\n")
    r = read_company_map(spark, path).first()
    assert (r.symbol, r.company_name) == ("A", "Acme Corp")


def test_document_period_bounds_arrays(spark):
    from bourse.operators.bars import document_period
    assert [document_period(t) for t in ("seconds", "minute", "hour", "day", "week")] == \
        ["day", "day", "month", "month", "year"]
    bars = resample_bars(ticks(spark), multiplier=15, timespan="minute", order_by=["ts", "seq"])
    docs = bronze_documents(bars, period=document_period("minute"))
    assert docs.agg(F.max("resultsCount")).first()[0] <= 1440
    assert docs.filter(F.col("ticker") == "A").count() == 2   # two days of A


def test_zoned_ticks_bucketed_in_market_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            # 2024-01-03 03:00 UTC is 2024-01-02 22:00 in New York
            df = spark.createDataFrame([("A", 1704250800, 5.0)], "ticker string, s long, price double") \
                      .select("ticker", F.timestamp_seconds("s").alias("ts"), "price")
            bar = resample_bars(df, zone="America/New_York").first()
            assert bar.bar_start == TS(2024, 1, 2), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("period", [None, "decade"])
def test_documents_need_a_period(spark, period):
    bars = resample_bars(fx.event_ticks(spark, SF0001))
    with pytest.raises(ValueError, match="period"):
        bronze_documents(bars, period=period)


def _orders_landed(spark, name):
    """Bars of 2,000 orders, of which every tenth has none, as landed documents."""
    symbols = spark.range(2000).select(F.col("id").cast("string").alias("symbol"))
    sold = spark.range(2000).filter("id % 10 > 0").select(
        F.col("id").cast("string").alias("ticker"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 300)").alias("ts"),
        (F.col("id") * 1.37).alias("price"), F.lit(3.0).alias("qty"))
    folder = land_bronze(resample_bars(sold, volume="qty"), shared_dir(spark, "t", name), symbols=symbols, ingest_epoch=7)
    return folder, symbols


def test_landed_documents_take_little_disk(spark):
    folder, _ = _orders_landed(spark, "small")
    parts = versions.folders(spark, folder)
    text = spark.read.option("recursiveFileLookup", True).text(parts).agg(F.sum(F.length("value") + 1).alias("n")).first()["n"]
    on_disk = bronze_files(spark, parts).agg(F.sum("length").alias("n")).first()["n"]
    assert 0 < on_disk < text / 3
    bronze = read_bronze(spark, folder)
    assert [tuple(r) for r in bronze.select(F.unix_seconds("ingested_at")).distinct().collect()] == [(7,)]
    assert quality.corrupt_documents(bronze).isEmpty()
    assert rows(quality.missing_results(bronze)) == sorted((str(i),) for i in range(0, 2000, 10))


def test_completeness_of_compressed_landing(spark):
    folder, symbols = _orders_landed(spark, "complete")
    source = read_bronze(spark, folder).select("source_file").distinct()
    assert source.filter(~F.col("source_file").endswith(".json.gz")).isEmpty() and not source.isEmpty()
    more = symbols.unionByName(spark.range(2000, 2003).select(F.col("id").cast("string").alias("symbol")))
    assert rows(quality.landed_completeness(read_bronze(spark, folder), more)) == [("2000",), ("2001",), ("2002",)]
