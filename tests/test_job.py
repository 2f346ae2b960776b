"""The bronze -> silver -> gold job end to end on sf0.001."""

import os

import pytest
from pyspark.sql import functions as F

from bourse.operators import gold, quality
from bourse.plans import run
from bourse.session import local_path, shared_dir
from bourse.sinks import versions
from bourse.sources import fixtures as fx
from tests.conftest import SF0001


def _symbols_csv(spark):
    path = shared_dir(spark, "t", "symbols")
    fx.company_map(spark, SF0001).coalesce(1).write.option("header", True).csv(path)
    return path


def test_job_stages(spark):
    ticks = fx.order_ticks(spark, SF0001)
    root = shared_dir(spark, "t", "job")
    out = run(spark, ticks=ticks, symbols_csv=_symbols_csv(spark), bronze_root=f"{root}/bronze",
              silver_path=f"{root}/silver", gold_root=f"{root}/gold", years=[1997],
              dates=("1995-01-01", "2001-12-31"), do_bronze=True, do_silver=True, do_gold=True,
              zone="America/New_York", order_by="seq", ingest_epoch=1_700_000_000)
    assert out["n_missing_results"] == 0
    silver = out["silver"]
    quality.assert_primary_key(silver, ["date", "ticker"])
    prices = fx.daily_prices(spark, SF0001)
    assert silver.count() == prices.count()
    gold_dir = local_path(out["gold"])
    names = sorted(os.listdir(gold_dir))
    assert names == ["1997_consolidated.csv", "a.MAX_RELATIVE_INCREASE_1997.csv",
                     "b.INVESTMENT_VALUE_1997.csv", "c.CAGR_TICKER_JAN_JUNE_1997.csv",
                     "d.MAX_DECREASE_1997.csv"]
    got = spark.read.option("header", True).csv(
        f"{out['gold']}/a.MAX_RELATIVE_INCREASE_1997.csv").first()
    want = gold.max_relative_increase(prices, ("1997-01-01", "1997-12-31")).first()
    assert got.ticker == want.ticker
    d_rows = spark.read.option("header", True).csv(f"{out['gold']}/d.MAX_DECREASE_1997.csv").count()
    assert d_rows == 10
    # round trip: gold over the landed silver equals gold over the bars
    rng, half = ("1997-01-01", "1997-12-31"), ("1997-01-01", "1997-06-30")
    from_silver = gold.consolidate(silver, rng, growth_dates=half).first()
    from_bars = gold.consolidate(prices, rng, growth_dates=half).first()
    a, b = from_silver.asDict(), from_bars.asDict()
    key = "investment_return_by_end_of_year"   # a sum: last bits depend on order
    assert a.pop(key) == pytest.approx(b.pop(key), rel=1e-12)
    assert a == b
    pv = sorted(map(tuple, gold.position_values(silver).collect()))
    assert pv == sorted(map(tuple, gold.position_values(prices).collect()))


def test_job_stops_on_bad_silver(spark):
    ticks = fx.order_ticks(spark, SF0001)
    root = shared_dir(spark, "t", "job")
    sym = _symbols_csv(spark)
    run(spark, ticks=ticks, symbols_csv=sym, bronze_root=f"{root}/bronze",
        do_bronze=True, ingest_epoch=1)
    # a second landing of the same bars into the same folder -> duplicate keys
    from bourse.operators.bars import resample_bars
    from bourse.sinks import land_bronze
    land_bronze(resample_bars(ticks, order_by="seq"), f"{root}/bronze", ingest_epoch=2,
                mode="append", zone="America/New_York")
    with pytest.raises(quality.ValidationError):
        run(spark, symbols_csv=sym, bronze_root=f"{root}/bronze", silver_path=f"{root}/silver",
            gold_root=f"{root}/gold", years=[1997], do_silver=True, do_gold=True)
    assert not os.path.exists(local_path(f"{root}/gold"))
    assert versions.current(spark, f"{root}/silver") is None
    # keeping the latest ingest resolves the re-landing
    out = run(spark, symbols_csv=sym, bronze_root=f"{root}/bronze", silver_path=f"{root}/silver",
              do_silver=True, keep="latest")
    assert out["silver"].count() == fx.daily_prices(spark, SF0001).count()


def test_job_cli(spark):
    from bourse.plans.job import main
    root = shared_dir(spark, "t", "cli")
    fx.order_ticks(spark, SF0001).write.parquet(f"{root}/ticks")
    main(["--ticks", f"{root}/ticks", "--symbols", _symbols_csv(spark),
          "--bronze-root", f"{root}/bronze", "--silver", f"{root}/silver",
          "--gold-root", f"{root}/gold", "--start", "1995-01-01", "--end", "2001-12-31",
          "--years", "1996", "--order-by", "seq", "--bronze", "--silver-stage", "--gold"])
    summary = spark.read.option("header", True).csv(f"{root}/gold/1996_consolidated.csv").first()
    prices = fx.daily_prices(spark, SF0001)
    want = gold.consolidate(prices, ("1996-01-01", "1996-12-31"),
                            growth_dates=("1996-01-01", "1996-06-30")).first()
    assert summary.max_relative_increase_ticker == want.max_relative_increase_ticker
    assert summary.max_decrease_by_week_weeknum == want.max_decrease_by_week_weeknum
    assert summary.max_decrease_by_week_weeknum == want.max_decrease_by_week_weeknum


def test_job_rejects_sub_day_bars_for_silver(spark):
    with pytest.raises(ValueError):
        run(spark, ticks=fx.order_ticks(spark, SF0001), symbols_csv="x", bronze_root="b",
            silver_path="s", do_bronze=True, do_silver=True, timespan="hour")


def test_silver_only_run_reads_its_range(spark):
    ticks = fx.order_ticks(spark, SF0001)
    root = shared_dir(spark, "t", "job")
    sym = _symbols_csv(spark)
    for rng in (("1996-01-01", "1996-12-31"), ("1997-01-01", "1997-12-31")):
        run(spark, ticks=ticks, symbols_csv=sym, bronze_root=f"{root}/bronze", dates=rng,
            do_bronze=True, order_by="seq", ingest_epoch=1)
    out = run(spark, symbols_csv=sym, bronze_root=f"{root}/bronze", silver_path=f"{root}/silver",
              dates=("1997-01-01", "1997-12-31"), do_silver=True)
    years = {r.y for r in out["silver"].select(F.year("date").alias("y")).distinct().collect()}
    assert years == {1997}


def test_incremental_silver_over_ranges(spark):
    from bourse.plans.job import main
    root = shared_dir(spark, "t", "ranges")
    fx.order_ticks(spark, SF0001).write.parquet(f"{root}/ticks")
    sym, silver = _symbols_csv(spark), f"{root}/silver"
    ranges = [f"{y}-01-01:{y}-12-31" for y in (1996, 1997)]

    def land(year, *more):
        main(["--ticks", f"{root}/ticks", "--symbols", sym, "--bronze-root", f"{root}/bronze", "--silver", silver, "--order-by", "seq",
              "--start", f"{year}-01-01", "--end", f"{year}-12-31", "--bronze", *more])
    land(1996)
    land(1997, "--silver-stage", "--incremental", "--silver-ranges", *ranges)
    first = dict(versions.current(spark, silver).parts)
    land(1996, "--silver-stage", "--incremental", "--silver-ranges", *ranges)
    second = dict(versions.current(spark, silver).parts)
    assert sorted(first) == sorted(second) == ["year=1996", "year=1997"]
    assert [y for y in first if first[y] != second[y]] == ["year=1996"]


def test_gold_without_years_is_refused(spark):
    with pytest.raises(ValueError, match="year"):
        run(spark, silver_path="s", gold_root="g", do_gold=True)


def test_silver_refuses_corrupt_documents(spark):
    root = shared_dir(spark, "t", "bad")
    good = '{"ticker":"A","results":[{"c":1.5,"n":2,"t":0}]}'
    for k, bad in enumerate(['{"ticker":"B","results":[{"c":1', '{"ticker":"C","results":[{"c":"x1","n":5.5,"t":0}]}']):
        folder = f"{root}/{k}/bronze/all/ingest=7"
        spark.createDataFrame([(good,), (bad,)], "value string").write.text(folder)
        from bourse.sources.readers import read_bronze
        report = quality.corrupt_documents(read_bronze(spark, f"{root}/{k}/bronze/all")).collect()
        assert [r.document for r in report] == [bad]
        with pytest.raises(quality.ValidationError, match="1 corrupt"):
            run(spark, symbols_csv=_symbols_csv(spark), bronze_root=f"{root}/{k}/bronze",
                silver_path=f"{root}/{k}/silver", do_silver=True)
        assert versions.current(spark, f"{root}/{k}/silver") is None


def test_stake_reaches_the_gold_files(spark):
    root = shared_dir(spark, "t", "stake")
    from bourse.sinks import write_silver
    write_silver(fx.daily_prices(spark, SF0001), f"{root}/silver", partition_by="year")
    for stake in (1_000_000, 10):
        run(spark, silver_path=f"{root}/silver", gold_root=f"{root}/{stake}", years=[1997], do_gold=True, stake=stake)
    big, small = (float(spark.read.option("header", True).csv(f"{root}/{s}/b.INVESTMENT_VALUE_1997.csv")
                        .first().investment_value) for s in (1_000_000, 10))
    assert big == pytest.approx(100_000 * small)


def test_cli_needs_start_and_end(spark):
    from bourse.plans.job import main
    with pytest.raises(SystemExit):
        main(["--start", "2024-01-01", "--bronze"])


def test_existing_provider_bronze_folder(spark):
    """Silver and gold stages on a bronze folder laid out as the reference
    lands it: {start}_{end}/{ticker}_{epoch}.json, one provider document per
    file, bar start at midnight New York time."""
    import datetime as dt
    import json
    from zoneinfo import ZoneInfo
    from bourse.session import local_path
    ny = ZoneInfo("America/New_York")
    bars = fx.daily_prices(spark, SF0001).collect()
    root = shared_dir(spark, "t", "provider")
    folder = local_path(f"{root}/bronze/1995-01-01_2001-12-31")
    os.makedirs(folder)
    by_ticker = {}
    for b in bars:
        t = int(dt.datetime.combine(b.date, dt.time(), ny).timestamp() * 1000)
        by_ticker.setdefault(b.ticker, []).append(
            {"c": b.close, "h": b.high, "l": b.low, "n": b.trades, "o": b.open, "t": t,
             "v": 100, "vw": b.close})
    for ticker, results in by_ticker.items():
        doc = {"ticker": ticker, "queryCount": len(results), "resultsCount": len(results),
               "adjusted": True, "results": sorted(results, key=lambda r: r["t"]),
               "status": "OK", "request_id": "x"}
        with open(os.path.join(folder, f"{ticker}_1741000000.json"), "w") as f:
            json.dump(doc, f)
    from bourse.sinks import write_calendar
    from bourse.sources.calendar import calendar
    cal_csv = shared_dir(spark, "t", "dim_date")
    write_calendar(calendar(spark, "1995-01-01", "2001-12-31"), csv_path=cal_csv)
    out = run(spark, symbols_csv=_symbols_csv(spark), bronze_root=f"{root}/bronze",
              silver_path=f"{root}/silver", gold_root=f"{root}/gold", years=[1997],
              dates=("1995-01-01", "2001-12-31"), do_silver=True, do_gold=True,
              calendar_csv=cal_csv)
    silver = out["silver"]
    got = sorted((r.ticker, r.date, r.close, r.volume) for r in silver.collect())
    assert got == sorted((b.ticker, b.date, b.close, 100.0) for b in bars)
    assert silver.filter(F.unix_seconds("ingested_at") != 1741000000).count() == 0
    summary = spark.read.option("header", True).csv(f"{root}/gold/1997_consolidated.csv").first()
    want = gold.consolidate(fx.daily_prices(spark, SF0001), ("1997-01-01", "1997-12-31"),
                            growth_dates=("1997-01-01", "1997-06-30")).first()
    assert summary.max_relative_increase_ticker == want.max_relative_increase_ticker
    assert summary.max_decrease_by_week_weeknum == want.max_decrease_by_week_weeknum


def test_failed_landing_keeps_the_old_one(spark, monkeypatch):
    ticks = fx.order_ticks(spark, SF0001)
    root = shared_dir(spark, "t", "job")
    sym = _symbols_csv(spark)
    landing = dict(ticks=ticks, symbols_csv=sym, bronze_root=f"{root}/bronze", do_bronze=True)
    folder = run(spark, ingest_epoch=1, **landing)["bronze"]
    before = versions.folders(spark, folder)
    monkeypatch.setattr(quality, "landed_completeness", lambda landed, symbols: symbols.select("symbol"))
    with pytest.raises(quality.ValidationError):
        run(spark, ingest_epoch=2, **landing)
    assert [f.rsplit("/", 1)[1] for f in before] == ["ingest=1"] and versions.folders(spark, folder) == before


def test_failed_silver_keeps_the_old_one(spark, monkeypatch):
    ticks = fx.order_ticks(spark, SF0001)
    root = shared_dir(spark, "t", "job")
    args = dict(symbols_csv=_symbols_csv(spark), bronze_root=f"{root}/bronze", silver_path=f"{root}/silver",
                do_silver=True)
    run(spark, ticks=ticks, do_bronze=True, **args)
    before = versions.current(spark, f"{root}/silver")

    def refuse(df, keys):
        raise quality.ValidationError("planted")
    monkeypatch.setattr(quality, "assert_primary_key", refuse)
    with pytest.raises(quality.ValidationError):
        run(spark, **args)
    assert versions.current(spark, f"{root}/silver") == before
