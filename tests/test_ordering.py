"""Order columns as one number: sorts as the tuple does, and bars aggregate by hash."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bourse.functions import order_key
from bourse.operators.bars import resample_bars
from bourse.sources import fixtures as fx
from tests.conftest import SF0001, rows
from tests.test_plans import plan


def _low(v):
    return (v is not None, v if v is not None else 0)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sorts_as_the_columns_do(spark, zone):
    rng = random.Random(7)
    t0 = dt.datetime(2024, 11, 3, 0, 30)  # an hour that comes twice in New York
    edge = {"n": [dt.datetime(1, 1, 2), dt.datetime(9999, 12, 30, 23, 59, 59, 999_999)], "s": [-2**63, 2**63 - 1], "d": [dt.date(1, 1, 1)],
            "i": [-2**31, 2**31 - 1], "h": [-2**15, 2**15 - 1], "b": [-128, 127], "k": [True, False]}
    make = {"n": lambda: t0 + dt.timedelta(minutes=rng.randrange(240), microseconds=rng.randrange(3)), "s": lambda: rng.randrange(-3, 4),
            "d": lambda: dt.date(1969, 12, 30) + dt.timedelta(rng.randrange(4)), "i": lambda: rng.randrange(-3, 3),
            "h": lambda: rng.randrange(-2, 2), "b": lambda: rng.randrange(-2, 2), "k": lambda: rng.random() < 0.5}
    values = [tuple(None if rng.random() < 0.1 else rng.choice(edge[c]) if rng.random() < 0.1 else make[c]() for c in make) for _ in range(300)]
    df = spark.createDataFrame(values, "n timestamp_ntz, s bigint, d date, i int, h smallint, b tinyint, k boolean")
    df = df.withColumn("t", F.when(F.year("n").between(1970, 9000), F.to_timestamp_ltz(F.date_format("n", "yyyy-MM-dd HH:mm:ss.SSSSSS"))))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for cols in (["n", "s"], ["t", "s"], ["d", "h", "s"], ["i", "h", "b", "k", "n"], ["s", "i", "h", "b"], ["k", "d", "i", "h"]):
            key = order_key(cols, df.schema)
            assert df.select(key).schema.fields[0].dataType.simpleString() == "decimal(38,0)"
            got = df.select(key.alias("key"), *cols).collect()
            by_key = sorted(got, key=lambda r: r.key)
            assert [tuple(r[c] for c in cols) for r in by_key] == sorted((tuple(r[c] for c in cols) for r in got),
                                                                       key=lambda r: tuple(map(_low, r)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_what_does_not_fit_stays_a_struct(spark):
    df = spark.createDataFrame([], "t timestamp_ntz, a bigint, b bigint, x double, s string, `d.e` int")
    for cols in (["a", "b"], ["t", "x"], ["t", "s"], ["t", "a", "b"]):
        assert df.select(order_key(cols, df.schema)).schema.fields[0].dataType.simpleString().startswith("struct<")
    assert df.select(order_key(["a"], df.schema)).schema.fields[0].dataType.simpleString() == "bigint"


def test_times_before_year_one_are_refused(spark):
    df = spark.range(1).select(F.expr("TIMESTAMP_NTZ'0001-01-01 00:00:00' - INTERVAL 400 DAYS").alias("t"), F.lit(1).alias("i"))
    with pytest.raises(Exception, match="before the year 1"):
        df.select(order_key(["t", "i"], df.schema)).collect()


def test_bars_with_a_tie_column_aggregate_by_hash(spark):
    ticks = fx.order_ticks(spark, SF0001)
    packed = resample_bars(ticks, order_by=["ts", "seq"])
    p = plan(packed)
    assert "HashAggregate" in p and "SortAggregate" not in p
    as_struct = resample_bars(ticks.withColumn("x", F.lit(1.0)), order_by=["ts", "seq", "x"])
    assert "SortAggregate" in plan(as_struct)
    assert rows(packed.drop("volume", "vwap")) == rows(as_struct.drop("volume", "vwap"))
