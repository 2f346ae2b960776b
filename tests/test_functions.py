import datetime as dt

import pytest
from pyspark.sql import functions as F

from bourse.functions import (bucket_start, epoch_ms_to_date, ingest_epoch_from_path,
                              iso_week, iso_year, local_to_epoch_ms, parse_range, round_half)


def test_iso_week_and_year_edges(spark):
    days = [dt.date(2024, 12, 30), dt.date(2024, 12, 31), dt.date(2023, 1, 1),
            dt.date(2025, 1, 5), dt.date(1996, 12, 30), dt.date(1997, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: (r.wk, r.yr) for r in df.select(
        "d", iso_week(F.col("d")).alias("wk"), iso_year(F.col("d")).alias("yr")).collect()}
    for d in days:
        y, w, _ = d.isocalendar()
        assert got[d] == (w, y), d
    assert got[dt.date(2024, 12, 30)] == (1, 2025)
    assert got[dt.date(2023, 1, 1)] == (52, 2022)


@pytest.mark.parametrize("zone,expected", [
    ("America/New_York", dt.date(2023, 1, 3)),
    ("UTC", dt.date(2023, 1, 3)),
    ("America/Los_Angeles", dt.date(2023, 1, 2)),
])
def test_epoch_ms_to_date_zone(spark, zone, expected):
    df = spark.range(1).select(epoch_ms_to_date(F.lit(1672722000000), zone).alias("d"))
    assert df.first().d == expected


def test_epoch_ms_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = []
        for tz in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out.append(spark.range(1).select(
                epoch_ms_to_date(F.lit(1672722000000), "America/New_York").alias("d")).first().d)
        assert len(set(out)) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_local_to_epoch_round_trip(spark):
    df = spark.range(1).select(
        local_to_epoch_ms(F.expr("TIMESTAMP_NTZ'2023-01-03 00:00:00'"), "America/New_York").alias("ny"),
        local_to_epoch_ms(F.expr("TIMESTAMP_NTZ'2023-01-03 00:00:00'"), "UTC").alias("utc"))
    r = df.first()
    assert r.ny == 1672722000000
    assert r.utc == 1672704000000


def test_ingest_epoch_from_path(spark):
    paths = ["/b/2023-01-01_2024-12-31/NVDA_1741000000.json",
             "file:/x/bronze/ingest=1700000000/part-0001.json",
             "/b/no_epoch_here.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r.e for r in df.select(ingest_epoch_from_path(F.col("p")).alias("e")).collect()]
    assert got == [1741000000, 1700000000, None]


def test_parse_range():
    assert parse_range(None) is None
    assert parse_range(("2023-01-01", "2023-12-31")) == (dt.date(2023, 1, 1), dt.date(2023, 12, 31))
    with pytest.raises(ValueError):
        parse_range(("2024-01-02", "2024-01-01"))


@pytest.mark.parametrize("mult,span,ts,expected", [
    (15, "minute", "2024-01-01 10:37:12", "2024-01-01 10:30:00"),
    (1, "hour", "2024-01-01 10:37:12", "2024-01-01 10:00:00"),
    (4, "hours", "2024-01-01 10:37:12", "2024-01-01 08:00:00"),
    (1, "day", "2024-01-01 23:59:59", "2024-01-01 00:00:00"),
    (1, "week", "2024-01-07 12:00:00", "2024-01-01 00:00:00"),
    (1, "month", "2024-02-29 12:00:00", "2024-02-01 00:00:00"),
    (1, "quarter", "2024-05-15 00:00:00", "2024-04-01 00:00:00"),
    (1, "year", "2024-05-15 00:00:00", "2024-01-01 00:00:00"),
])
def test_bucket_start(spark, mult, span, ts, expected):
    df = spark.range(1).select(F.to_timestamp_ntz(F.lit(ts)).alias("ts"))
    out = df.select(bucket_start(F.col("ts"), mult, span, df.schema["ts"].dataType).alias("b")).first().b
    assert out == dt.datetime.fromisoformat(expected)


def test_round_half(spark):
    df = spark.createDataFrame([(2.675,), (1.0000000000000002,), (None,)], "x double")
    got = [r.r for r in df.select(round_half(F.col("x"), 2).alias("r")).collect()]
    assert got == [2.68, 1.0, None]


def test_calendar_matches_python_isocalendar(spark):
    from bourse.sources.calendar import calendar
    cal = calendar(spark, "2020-01-01", "2025-12-31")
    got = {r.date: (r.weeknum, r.year) for r in cal.collect()}
    assert len(got) == 2192
    d = dt.date(2020, 1, 1)
    while d <= dt.date(2025, 12, 31):
        y, w, _ = d.isocalendar()
        assert got[d] == (w, y), d
        d += dt.timedelta(days=1)
    assert cal.schema.simpleString() == "struct<date:date,weeknum:int,year:int>"


def test_calendar_csv_and_parquet_round_trip(spark):
    from bourse.session import shared_dir
    from bourse.sinks import write_calendar
    from bourse.sources.calendar import calendar
    from bourse.sources.readers import read_calendar
    cal = calendar(spark, "2024-12-20", "2025-01-10")
    csv, pq = shared_dir(spark, "t", "cal_csv"), shared_dir(spark, "t", "cal_pq")
    write_calendar(cal, csv_path=csv, parquet_path=pq)
    want = sorted(map(tuple, cal.collect()))
    assert sorted(map(tuple, read_calendar(spark, csv).collect())) == want
    assert sorted(map(tuple, read_calendar(spark, pq, fmt="parquet").collect())) == want
    cut = read_calendar(spark, csv, ("2024-12-30", "2025-01-05"))
    assert {(r.weeknum, r.year) for r in cut.collect()} == {(1, 2025)}


def test_in_time_range_zoned_ticks_any_session_zone(spark):
    from pyspark.sql.types import TimestampType
    from bourse.functions import in_time_range
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = [(1704171599,), (1704171600,), (1704257999,), (1704258000,)]  # around NY midnights
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame(rows, "s long").select(F.timestamp_seconds("s").alias("ts"))
            cond = in_time_range(F.col("ts"), TimestampType(), ("2024-01-02", "2024-01-02"),
                                 "America/New_York")
            got = sorted(r.s for r in df.filter(cond).select(F.unix_seconds("ts").alias("s")).collect())
            assert got == [1704171600, 1704257999], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
