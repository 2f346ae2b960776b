"""Versioned bronze and silver: killed writes, kept parts, one parse, incremental builds."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from bourse.operators import quality
from bourse.operators.bars import daily, resample_bars, ticks_in_range
from bourse.plans.job import build_silver
from bourse.session import local_path, scratch, shared_dir, staged
from bourse.sinks import land_bronze, versions, write_silver
from bourse.sources import fixtures as fx
from bourse.sources.readers import read_bronze, read_silver
from tests.conftest import SF0001, rows

YEARS = (1995, 1996, 1997)


def _range(year):
    return (f"{year}-01-01", f"{year}-12-31")


def _land(spark, root, year, add=0.0, epoch=1, **how):
    ticks = ticks_in_range(fx.order_ticks(spark, SF0001), _range(year))
    bars = resample_bars(ticks.withColumn("price", F.col("price") + add), order_by="seq")
    return land_bronze(bars, root, dates=_range(year), ingest_epoch=epoch, zone="UTC", **how)


def _killed(df, column):
    """``df`` whose job fails after some of its tasks have written."""
    bad = F.raise_error(F.lit("killed")).cast(df.schema[column].dataType)
    return df.repartition(4).withColumn(column, F.when(F.spark_partition_id() < 3, F.col(column)).otherwise(bad))


def test_versions_and_conflicts(spark):
    path = shared_dir(spark, "t", "versions")
    assert versions.current(spark, path) is None and versions.folders(spark, path) == [path]
    one = versions.publish(spark, path, None, [("a", "x"), ("b", "y")], {"k": [1, None]})
    assert versions.current(spark, path) == one and versions.folders(spark, path) == ["x", "y"]
    two = versions.publish(spark, path, one, [])
    assert versions.current(spark, path) == two and two.number == 2 and versions.folders(spark, path) == []
    with pytest.raises(versions.VersionConflict):
        versions.publish(spark, path, one, [("a", "z")])


def test_killed_landing_leaves_the_old_rows(spark):
    root = shared_dir(spark, "t", "bronze")
    folder = _land(spark, root, 1996)
    want = rows(read_bronze(spark, folder).select("ticker", F.to_json("results").alias("results")))
    bars = resample_bars(ticks_in_range(fx.order_ticks(spark, SF0001), _range(1996)), order_by="seq")
    with pytest.raises(Exception, match="killed"):
        land_bronze(_killed(staged(bars, "bars"), "close"), root, dates=_range(1996), ingest_epoch=2, zone="UTC")
    assert rows(read_bronze(spark, folder).select("ticker", F.to_json("results").alias("results"))) == want
    _land(spark, root, 1996, epoch=3)  # the next one isn't in its way
    assert read_bronze(spark, folder).select(F.unix_seconds("ingested_at").alias("e")).distinct().collect() == [(3,)]


def test_killed_silver_leaves_the_old_rows(spark):
    path = shared_dir(spark, "t", "silver")
    prices = daily(fx.order_bars(spark, SF0001)).drop("volume", "vwap")
    write_silver(prices, path, partition_by="year")
    want = rows(read_silver(spark, path))
    with pytest.raises(Exception, match="killed"):
        write_silver(_killed(staged(prices, "prices"), "close"), path, partition_by="year")
    assert rows(read_silver(spark, path)) == want == rows(prices)


def test_parts_of_years(spark):
    path = shared_dir(spark, "t", "silver")
    frame = "ticker string, date date, close double"
    day = [("A", dt.date(1996, 5, 1), 1.0), ("A", dt.date(1997, 5, 1), 2.0), ("A", None, 3.0)]
    write_silver(spark.createDataFrame(day, frame), path, partition_by="year")
    first = dict(versions.current(spark, path).parts)
    assert sorted(first) == ["year=", "year=1996", "year=1997"]
    write_silver(spark.createDataFrame([("A", dt.date(1997, 6, 1), 9.0)], frame), path, "year", only_years={1997, None})
    now = dict(versions.current(spark, path).parts)
    assert sorted(now) == ["year=1996", "year=1997"] and now["year=1996"] == first["year=1996"]
    assert sorted(r.close for r in read_silver(spark, path).collect()) == [1.0, 9.0]
    only = read_silver(spark, path, ("1996-01-01", "1996-12-31"))
    assert [r.close for r in only.collect()] == [1.0]
    assert all("year=1996" in f for f in only.inputFiles())
    write_silver(spark.createDataFrame([], frame), path, partition_by="year")
    assert read_silver(spark, path).count() == 0 and read_silver(spark, path).columns == ["ticker", "date", "close"]


def test_bronze_is_parsed_once(spark, monkeypatch):
    """The job that stages the rows counts the documents; nothing else reads them."""
    root = shared_dir(spark, "t", "once")
    folder = _land(spark, f"{root}/bronze", 1996)
    reports = []
    monkeypatch.setattr(quality, "corrupt_documents", lambda bronze: reports.append(bronze) or bronze.limit(0))
    import bourse.plans.job as job
    real, counts = job.quality.observe_documents, []

    def observed(bronze, seen):
        counts.append(seen)
        return real(bronze, seen)
    monkeypatch.setattr(job.quality, "observe_documents", observed)
    build_silver(spark, folder, fx.company_map(spark, SF0001), f"{root}/silver", zone="UTC")
    n = read_bronze(spark, folder).count()
    assert [c.get for c in counts] == [{"documents": n, "corrupt": 0, "empty": 0}]


def _equal_to_full(spark, folders, path, **how):
    cmap = fx.company_map(spark, SF0001)
    got = build_silver(spark, folders, cmap, path, zone="UTC", incremental=True, **how)
    full = build_silver(spark, folders, cmap, shared_dir(spark, "t", "full"), zone="UTC", **how)
    assert rows(got.withColumn("ingested_at", F.unix_seconds("ingested_at"))) == \
        rows(full.withColumn("ingested_at", F.unix_seconds("ingested_at")))
    return dict(versions.current(spark, path).parts)


def test_incremental_build_rewrites_touched_years_only(spark):
    root = shared_dir(spark, "t", "incremental")
    path, bronze = f"{root}/silver", f"{root}/bronze"
    folders = [_land(spark, bronze, y) for y in YEARS]
    one = _equal_to_full(spark, folders, path)
    assert sorted(one) == [f"year={y}" for y in YEARS]
    assert _equal_to_full(spark, folders, path) == one  # nothing new, nothing written
    _land(spark, bronze, 1996, add=5.0, epoch=2)
    two = _equal_to_full(spark, folders, path)
    assert [y for y in one if one[y] != two[y]] == ["year=1996"]
    # A range that spans two years beside the landings of each; later ingests win.
    wide = ticks_in_range(fx.order_ticks(spark, SF0001), ("1996-07-01", "1997-06-30"))
    folders.append(land_bronze(resample_bars(wide.withColumn("price", F.col("price") + 9), order_by="seq"), bronze,
                               dates=("1996-07-01", "1997-06-30"), ingest_epoch=3, zone="UTC"))
    three = _equal_to_full(spark, folders, path, keep="latest")  # another rule: a full build
    assert set(three.values()).isdisjoint(two.values())
    _land(spark, bronze, 1997, add=1.0, epoch=4)
    four = _equal_to_full(spark, folders, path, keep="latest")
    assert [y for y in three if three[y] != four[y]] == ["year=1997"]
    five = _equal_to_full(spark, folders[1:], path, keep="latest")  # a range that is gone
    assert sorted(five) == ["year=1996", "year=1997"] and five["year=1997"] == four["year=1997"]
    _land(spark, bronze, 1995)  # not asked for, so not read
    with pytest.raises(quality.ValidationError):  # strict: the ranges overlap
        _equal_to_full(spark, folders[1:], path)
    assert dict(versions.current(spark, path).parts) == five


def test_staged_tables_are_removed(spark):
    """Scratch blocks remove their own tables, also nested and after a failure."""
    outer, left = [], staged(spark.range(3), "left")
    with pytest.raises(RuntimeError):
        with scratch(spark):
            a = staged(spark.range(4), "a")
            outer += a.inputFiles()
            with scratch(spark):
                b = staged(a, "b")
                inner = b.inputFiles()
                assert b.count() == 4
            assert not any(os.path.exists(local_path(f)) for f in inner) and a.count() == 4
            raise RuntimeError
    assert outer and not any(os.path.exists(local_path(f)) for f in outer) and left.count() == 3


def test_build_leaves_only_its_versions(spark, monkeypatch):
    import bourse.session as session
    made, real = [], session.scratch_dir
    monkeypatch.setattr(session, "scratch_dir", lambda *a: made.append(real(*a)) or made[-1])
    root = shared_dir(spark, "t", "left")
    folder = _land(spark, f"{root}/bronze", 1996)
    silver = build_silver(spark, folder, fx.company_map(spark, SF0001), f"{root}/silver", zone="UTC", incremental=True)
    assert made and not any(os.path.exists(local_path(p)) for p in made) and silver.count() > 0
