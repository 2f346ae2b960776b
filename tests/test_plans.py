"""Physical-plan checks: pushdown, pruning, partial aggregation, no
row-at-a-time Python, no window over raw rows of a ticker."""

import re

import pytest
from pyspark.sql import functions as F

from bourse.operators import gold
from bourse.operators.bars import resample_bars
from bourse.session import shared_dir, staged
from bourse.sinks import write_silver
from bourse.sources import fixtures as fx
from bourse.sources.readers import read_silver
from tests.conftest import SF0001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    path = shared_dir(spark, "t", "silver")
    write_silver(fx.daily_prices(spark, SF0001).drop("volume", "vwap"), path)
    return read_silver(spark, path)


def test_date_range_reaches_parquet_scan(spark, silver):
    df = gold.relative_change(silver, ("1997-01-01", "1997-12-31"))
    p = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in p.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    assert scan, p
    text = " ".join(scan)
    assert "GreaterThanOrEqual(date,1997-01-01)" in text
    assert "LessThanOrEqual(date,1997-12-31)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["close", "date", "ticker"]


@pytest.mark.parametrize("fn", [gold.relative_change, gold.position_values, gold.growth_rate,
                                gold.investment_return, gold.max_cagr, gold.max_relative_increase])
def test_no_window_and_partial_aggregation(silver, fn):
    p = plan(fn(silver))
    assert "Window" not in p
    assert "partial_min_by" in p and "partial_max_by" in p
    assert "EvalPython" not in p


def test_weekly_change_single_window_on_week_rows(silver):
    p = plan(gold.weekly_change(silver))
    assert p.count("Window [") == 1
    assert "partial_min_by" in p


def test_weekly_change_by_day_has_no_second_join(silver):
    p = plan(gold.weekly_change_by_day(silver))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p
    assert "TakeOrderedAndProject" in p


def test_resample_bars_partial_aggregate(spark):
    b = resample_bars(fx.event_ticks(spark, SF0001), multiplier=15, timespan="minute")
    p = plan(b)
    assert "partial_min_by" in p
    # ticks are keyed by integer arithmetic; no timestamp is built per tick
    pre = [line for line in p.splitlines() if "Project [" in line][-1]
    assert "unix_timestamp" in pre and "timestampadd" not in pre and "timestampdiff" not in pre


def test_year_partitions_pruned(spark):
    path = shared_dir(spark, "t", "silver_by_year")
    write_silver(fx.daily_prices(spark, SF0001).drop("volume", "vwap"), path, partition_by="year")
    df = read_silver(spark, path, ("1997-01-01", "1997-12-31"))
    assert "year" not in df.columns
    assert df.inputFiles() and all("/year=1997/" in f for f in df.inputFiles())
    plain = shared_dir(spark, "t", "plain_by_year")  # not written by us: pruned by Spark
    read_silver(spark, path).withColumn("year", F.year("date")).write.partitionBy("year").parquet(plain)
    p = plan(gold.relative_change(read_silver(spark, plain, ("1997-01-01", "1997-12-31"))))
    assert re.search(r"PartitionFilters: \[[^\]]*year", p), p
    full = fx.daily_prices(spark, SF0001)
    want = gold.relative_change(full, ("1997-01-01", "1997-12-31"))
    got = gold.relative_change(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture
def whole_paths(spark):
    """Plans that show the whole path of each scan."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_gold_answers_read_the_series_once(silver, monkeypatch, whole_paths):
    built = []
    monkeypatch.setattr(gold, "staged", lambda df, name: built.append(df) or staged(df, name))
    full, half = ("1997-01-01", "1997-12-31"), ("1997-01-01", "1997-06-30")
    got = gold.answers(silver, full, growth_dates=half)
    assert len(built) == 1
    p = plan(built[0])
    assert p.count("FileScan parquet") == 1
    assert "partial_min_by" in p and "GreaterThanOrEqual(date,1997-01-01)" in p
    for df in got.values():
        scans = [line for line in plan(df).splitlines() if "FileScan parquet" in line]
        assert scans and all("/staged/weeks/" in line for line in scans)


def test_day_values_read_the_series_twice(silver, monkeypatch, whole_paths):
    built = []
    monkeypatch.setattr(gold, "staged", lambda df, name: built.append(df) or staged(df, name))
    df = gold.day_values(silver)
    scans = [line for d in (*built, df) for line in plan(d).splitlines() if "FileScan parquet" in line]
    assert len(built) == 1
    assert sum("/staged/base/" not in line for line in scans) == 2


def _ran(df) -> str:
    """The plan that ran, its subqueries included, without the plans they began as."""
    df.collect()
    out, skip = [], None
    for line in plan(df).splitlines():
        at = re.search(r"[^ :+|-]", line).start()
        if skip is not None and at < skip:
            skip = None
        if skip is None and "== Initial Plan ==" in line:
            skip = at
        if skip is None:
            out.append(line)
    return "\n".join(out)


@pytest.mark.parametrize("fn", [gold.position_values, gold.investment_return, gold.growth_rate, gold.max_cagr,
                                gold.weekly_change, gold.max_weekly_decrease, gold.weekly_change_by_day])
def test_one_scan_when_called_alone(silver, fn):
    """The stake's subquery reads the exchange of the answer itself."""
    ran = _ran(fn(silver))
    assert "ReusedExchange" in ran and "Initial Plan" not in ran
    assert ran.count("FileScan parquet") == 1
    assert ran.count("+- Subquery subquery") == 1
