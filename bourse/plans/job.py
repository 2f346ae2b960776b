"""M1: the bronze -> silver -> gold job.

Stages run in order; a failing stage raises and nothing after it runs.

    python -m bourse --ticks PATH --symbols CSV --bronze-root DIR \
        --silver PATH --gold-root DIR --start 2023-01-01 --end 2024-12-31 \
        --years 2023 2024 --bronze --silver-stage --gold

(or ``spark-submit bourse/plans/job.py ...`` with the package on the
Python path of the driver; executors run no Python code of this package.)
"""

from __future__ import annotations

import argparse
import datetime as dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bourse.functions import MARKET_ZONE
from bourse.operators import gold, quality
from bourse.operators.bars import bronze_documents, document_period, resample_bars, ticks_in_range
from bourse.operators.silver import keep_latest, silver_rows
from bourse.schemas import SILVER, SILVER_KEY
from bourse.session import scratch, staged
from bourse.sinks import bronze_folder, land_documents, versions, write_gold, write_silver
from bourse.sources.readers import (bronze_files, read_bronze_files, read_calendar, read_company_map,
                                    read_silver, read_symbols)


def build_silver(spark: SparkSession, bronze_path, company_map: DataFrame,
                 silver_path: str, zone: str = MARKET_ZONE, keep: str = "strict",
                 multi_line: bool = False, partition_by: str | None = "year",
                 incremental: bool = False) -> DataFrame:
    """B1: read bronze, transform, validate schema and key, then write.

    The bronze JSON is parsed once: the job that stages the rows as Parquet
    in the shared folder also counts corrupt documents, and the key check
    reads two columns of the staged rows. The silver path gets its next
    version only after every check has passed. ``bronze_path`` may be a list
    of range folders.

    Each version remembers the bronze files it was made of and the years
    they hold. With ``incremental`` and such a version, only files that are
    new, and those that share a year with a new or vanished one, are parsed,
    and only those years are written; the result equals a full build. A
    changed company map, zone or ``keep`` makes a full build. Staged tables
    are removed at the end.
    """
    with scratch(spark):
        _build_silver(spark, bronze_path, company_map, silver_path, zone, keep, multi_line, partition_by, incremental)
    return read_silver(spark, silver_path)


def _build_silver(spark: SparkSession, bronze_path, company_map: DataFrame, silver_path: str, zone: str, keep: str,
                  multi_line: bool, partition_by: str | None, incremental: bool) -> None:
    if keep not in ("strict", "latest"):
        raise ValueError("keep must be 'strict' or 'latest'")
    paths = [bronze_path] if isinstance(bronze_path, str) else list(bronze_path)
    folders = [f for p in paths for f in versions.folders(spark, p)]
    names = company_map.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("symbol", "company_name"))).first()
    made_with = {"zone": zone, "keep": keep, "map": [names[0], names[1]], "multi_line": multi_line, "partition_by": partition_by}
    before = versions.current(spark, silver_path) if incremental and partition_by else None
    if before is None or any(before.notes.get(k) != v for k, v in made_with.items()):
        years = None
        rows = _stage_rows(spark, folders, company_map, zone, multi_line)
        sources = _with_years(bronze_files(spark, folders), rows)
    else:
        present = staged(bronze_files(spark, folders), "bronze_files")
        used = spark.read.parquet(before.notes["sources"])
        same = ["source_file", "changed", "length"]
        new, held = present.join(used, same, "left_anti"), used.join(present, same, "left_semi")
        gone = used.join(present, same, "left_anti").select("year")
        if new.isEmpty() and gone.isEmpty():
            return
        fresh = _stage_rows(spark, _names(new), company_map, zone, multi_line)
        years = {r.year for r in fresh.select(F.year("date").alias("year")).unionByName(gone).distinct().collect()}
        touched = F.col("year").isin([y for y in years if y is not None]) | (F.lit(None in years) & F.col("year").isNull())
        beside = _stage_rows(spark, _names(held.filter(touched)), company_map, zone, multi_line)
        rows = fresh.unionByName(beside.withColumn("year", F.year("date")).filter(touched).drop("year"))
        sources = _with_years(new, fresh).unionByName(held.select(*same, "year"))
    silver = rows.drop("source_file")
    silver = staged(keep_latest(silver), "silver") if keep == "latest" else silver
    quality.assert_schema(silver, SILVER)
    quality.assert_primary_key(silver, SILVER_KEY)
    listed = f"{silver_path.rstrip('/')}/_sources/{uuid.uuid4().hex[:12]}"
    sources.write.parquet(listed)
    write_silver(silver, silver_path, partition_by=partition_by, only_years=years, notes={**made_with, "sources": listed})


def _names(files: DataFrame) -> list[str]:
    return [r.source_file for r in files.select("source_file").distinct().collect()]


def _with_years(files: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for each file and year it holds; files without a bar stay."""
    return files.join(rows.select("source_file", F.year("date").alias("year")).distinct(), "source_file", "left")


def _stage_rows(spark: SparkSession, files: list[str], company_map: DataFrame, zone: str, multi_line: bool) -> DataFrame:
    """Silver rows and their source file of bronze files or folders, staged;
    raises if a document is corrupt."""
    if not files:
        return spark.createDataFrame([], StructType([*SILVER.fields, StructField("source_file", StringType())]))
    seen = Observation()
    bronze = read_bronze_files(spark, files, multi_line=multi_line)
    rows = staged(silver_rows(quality.observe_documents(bronze, seen), company_map, zone, carry=["source_file"]), "silver")
    quality.assert_no_corrupt_documents(bronze, seen.get["corrupt"])
    return rows


# Gold output folder names, as the reference names them (fixed values).
GOLD_OUTPUTS = {
    "a": "a.MAX_RELATIVE_INCREASE_{year}.csv",
    "b": "b.INVESTMENT_VALUE_{year}.csv",
    "c": "c.CAGR_TICKER_JAN_JUNE_{year}.csv",
    "d": "d.MAX_DECREASE_{year}.csv",
    "summary": "{year}_consolidated.csv",
}


def year_ranges(year: int):
    return ((dt.date(year, 1, 1), dt.date(year, 12, 31)),
            (dt.date(year, 1, 1), dt.date(year, 6, 30)))


def run_gold(prices, gold_root: str, years, stake: float = gold.DEFAULT_STAKE,
             spark: SparkSession | None = None, calendar: DataFrame | None = None) -> None:
    """The reference's gold set for each year: a., b., c. (January-June),
    d. (day grain, 10 rows) and the consolidated row. Every output is
    bounded (top-k, one row per year), so single CSV files are fine.

    ``prices`` is a DataFrame or the path of a silver table; with a path
    each year is read on its own, pruning the other years' partitions. The
    year's slice (three columns, range pushed to the scan) is read once, to
    the weekly frame from which the five outputs follow as concurrent jobs.
    ``calendar`` (date, weeknum, year) replaces the computed ISO weeks of d.;
    days it lacks get a NULL week.
    """
    for y in years:
        full, half = year_ranges(y)
        name = {k: f"{gold_root}/{v.format(year=y)}" for k, v in GOLD_OUTPUTS.items()}
        src = read_silver(spark, prices, full) if isinstance(prices, str) else prices
        with scratch(src.sparkSession):
            answer = gold.answers(src, full, stake, growth_dates=half, calendar=calendar)
            answer["summary"] = answer["summary"].drop("year")
            # small, latency-bound jobs: submit them together (Spark runs jobs
            # from several threads concurrently)
            with ThreadPoolExecutor(max_workers=len(answer)) as pool:
                for f in [pool.submit(write_gold, df, name[k], True) for k, df in answer.items()]:
                    f.result()


# Bar widths whose bars fall on distinct dates, as silver's (date, ticker)
# key requires (fixed values).
DAILY_OR_COARSER = ("day", "week", "month", "quarter", "year")


def run(spark: SparkSession, *, ticks: DataFrame | None = None, symbols_csv: str | None = None,
        bronze_root: str | None = None, silver_path: str | None = None,
        gold_root: str | None = None, years=(), dates=None, do_bronze: bool = False,
        do_silver: bool = False, do_gold: bool = False, zone: str = MARKET_ZONE,
        ticker: str = "ticker", ts: str = "ts", price: str = "price",
        volume: str | None = None, order_by=None, multiplier: int = 1,
        timespan: str = "day", ingest_epoch: int | None = None,
        calendar_csv: str | None = None, silver_partition: str | None = "year",
        keep: str = "strict", stake: float = gold.DEFAULT_STAKE,
        multi_line: bool = False, incremental: bool = False, silver_ranges=None) -> dict:
    """Run the requested stages in order; each stage needs the previous one
    to have succeeded in this run or to have its output on storage
    (``bronze_folder(bronze_root, dates)``).

    Bronze: ticks in ``dates`` (filter pushed to the scan) become
    ``multiplier`` x ``timespan`` bars, ordered by tick time and then by the
    tie-break columns ``order_by``; TIMESTAMP tick times are read in
    ``zone``. Every symbol must get a document (else ValidationError);
    symbols whose document has no bars are reported
    (``out["missing_results"]``, ``out["n_missing_results"]``). Documents are
    staged and checked first; the range folder is replaced only when they pass.
    Silver needs bars of a day or coarser, as it is keyed by (date, ticker);
    ``keep="latest"`` resolves tickers landed more than once (D16).
    ``silver_ranges`` lists the landed ranges that silver is made of (default:
    ``dates`` alone); with ``incremental`` only the years of bronze files that
    are new since the last build are built (``build_silver``).
    """
    span = timespan.lower().rstrip("s")
    if do_silver and span not in DAILY_OR_COARSER:
        raise ValueError(f"silver is keyed by (date, ticker): bars of {timespan!r} "
                         "would repeat dates; land day bars or coarser")
    out: dict = {}
    folder = bronze_folder(bronze_root, dates) if bronze_root else None
    if do_bronze:
        if ticks is None or symbols_csv is None or bronze_root is None:
            raise ValueError("bronze stage needs ticks, symbols_csv and bronze_root")
        symbols = read_symbols(spark, symbols_csv)
        ties = [] if order_by is None else ([order_by] if isinstance(order_by, str) else list(order_by))
        order = [ts] + [c for c in ties if c != ts]
        bars = resample_bars(ticks_in_range(ticks, dates, ts=ts, zone=zone), ticker=ticker, ts=ts,
                             price=price, volume=volume, multiplier=multiplier,
                             timespan=timespan, order_by=order, zone=zone)
        docs = staged(bronze_documents(bars, zone=zone, period=document_period(timespan),
                                        symbols=symbols), "bronze")
        landed = docs.withColumnRenamed("resultsCount", "results_count")
        not_landed = quality.landed_completeness(landed, symbols)
        if not not_landed.isEmpty():
            sample = [r.symbol for r in not_landed.limit(5).collect()]
            raise quality.ValidationError(
                f"{not_landed.count()} symbols without a landed document, e.g. {sample}")
        out["missing_results"] = quality.missing_results(landed)
        out["n_missing_results"] = out["missing_results"].count()
        land_documents(docs, folder, int(time.time()) if ingest_epoch is None else int(ingest_epoch))
        out["bronze"] = folder
    if do_silver:
        if folder is None or silver_path is None or symbols_csv is None:
            raise ValueError("silver stage needs bronze_root, silver_path and symbols_csv")
        folders = [bronze_folder(bronze_root, r) for r in silver_ranges] if silver_ranges else [folder]
        out["silver"] = build_silver(spark, folders, read_company_map(spark, symbols_csv),
                                     silver_path, zone=zone, keep=keep, multi_line=multi_line,
                                     partition_by=silver_partition, incremental=incremental)
    if do_gold:
        if silver_path is None or gold_root is None:
            raise ValueError("gold stage needs silver_path and gold_root")
        if not years:
            raise ValueError("gold stage needs at least one year")
        cal = read_calendar(spark, calendar_csv) if calendar_csv else None
        run_gold(silver_path, gold_root, years, stake, spark=spark, calendar=cal)
        out["gold"] = gold_root
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="bronze -> silver -> gold")
    ap.add_argument("--ticks", help="Parquet ticks with ticker, ts, price[, volume]")
    ap.add_argument("--symbols", help="symbol,company_name CSV")
    ap.add_argument("--bronze-root")
    ap.add_argument("--silver")
    ap.add_argument("--gold-root")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--years", nargs="*", type=int, default=[])
    ap.add_argument("--zone", default=MARKET_ZONE)
    ap.add_argument("--calendar", help="date,weeknum,year CSV for the weeks of d. (optional)")
    ap.add_argument("--ticker-col", default="ticker")
    ap.add_argument("--ts-col", default="ts")
    ap.add_argument("--price-col", default="price")
    ap.add_argument("--volume", help="volume column of the ticks (optional)")
    ap.add_argument("--order-by", help="comma-separated tick columns that break ties in tick time")
    ap.add_argument("--multiplier", type=int, default=1)
    ap.add_argument("--timespan", default="day",
                    help="second, minute, hour, day, week, month, quarter or year")
    ap.add_argument("--stake", type=float, default=gold.DEFAULT_STAKE,
                    help="money invested at the start of the range")
    ap.add_argument("--multi-line", action="store_true",
                    help="bronze files that hold one document over several lines")
    ap.add_argument("--keep", choices=["strict", "latest"], default="strict",
                    help="duplicate (date, ticker) from re-landing: fail, or keep the latest ingest")
    ap.add_argument("--silver-ranges", nargs="*", metavar="START:END",
                    help="landed ranges that silver is made of (default: the range of this run)")
    ap.add_argument("--incremental", action="store_true",
                    help="build only the years of bronze files that are new since the last silver")
    ap.add_argument("--flat-silver", action="store_true",
                    help="write silver unpartitioned (default: one folder per year)")
    ap.add_argument("--bronze", action="store_true")
    ap.add_argument("--silver-stage", action="store_true")
    ap.add_argument("--gold", action="store_true")
    a = ap.parse_args(argv)
    if bool(a.start) != bool(a.end):
        ap.error("--start and --end go together")
    from bourse.session import get_session
    spark = get_session()
    ticks = spark.read.parquet(a.ticks) if a.ticks else None
    dates = (a.start, a.end) if a.start else None
    run(spark, ticks=ticks, symbols_csv=a.symbols, bronze_root=a.bronze_root,
        silver_path=a.silver, gold_root=a.gold_root, years=a.years, dates=dates,
        do_bronze=a.bronze, do_silver=a.silver_stage, do_gold=a.gold, zone=a.zone,
        ticker=a.ticker_col, ts=a.ts_col, price=a.price_col,
        volume=a.volume, multiplier=a.multiplier, timespan=a.timespan,
        order_by=a.order_by.split(",") if a.order_by else None, calendar_csv=a.calendar,
        silver_partition=None if a.flat_silver else "year", keep=a.keep, stake=a.stake,
        multi_line=a.multi_line, incremental=a.incremental,
        silver_ranges=[tuple(r.split(":")) for r in a.silver_ranges] if a.silver_ranges else None)


if __name__ == "__main__":
    main()
