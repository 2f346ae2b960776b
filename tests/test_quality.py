import pytest
from pyspark.sql.types import (ArrayType, DoubleType, LongType, MapType, StringType, StructField,
                               StructType)

from bourse.operators import quality
from bourse.schemas import SILVER
from bourse.sources import fixtures as fx
from tests.conftest import SF0001, SF001


def test_schema_diff_and_assert(spark):
    ok = spark.createDataFrame([], SILVER)
    quality.assert_schema(ok, SILVER)
    assert quality.schema_diff(spark, ok, SILVER).count() == 0
    swapped = StructType([SILVER.fields[1], SILVER.fields[0], *SILVER.fields[2:]])
    wrong_type = StructType([*SILVER.fields[:2], StructField("close", SILVER.fields[5].dataType),
                             *SILVER.fields[3:]])
    extra = StructType([*SILVER.fields, StructField("x", SILVER.fields[0].dataType)])
    for bad, issue in ((swapped, "order"), (wrong_type, "type"), (extra, "extra")):
        df = spark.createDataFrame([], bad)
        with pytest.raises(quality.ValidationError):
            quality.assert_schema(df, SILVER)
        assert issue in {r.issue for r in quality.schema_diff(spark, df, SILVER).collect()}


def test_schema_differences_by_path(spark):
    bar = [StructField("c", DoubleType()), StructField("n", LongType()), StructField("t", LongType())]
    want = StructType([StructField("ticker", StringType()), StructField("results", ArrayType(StructType(bar))),
                       StructField("tags", MapType(StringType(), StructType(bar[:2])))])

    def issues(results, tags=want["tags"].dataType):
        df = spark.createDataFrame([], StructType([want.fields[0], StructField("results", results), StructField("tags", tags)]))
        found = quality.schema_issues(df, want)
        assert sorted(tuple(r) for r in quality.schema_diff(spark, df, want).collect()) == sorted(found)
        return found

    assert issues(want["results"].dataType) == []
    assert issues(ArrayType(StructType([bar[0], StructField("n", StringType()), bar[2]]))) == [
        ("results[].n", "bigint", "string", "type")]
    assert issues(ArrayType(StructType([bar[1], bar[0], bar[2]]))) == [("results[]", "c,n,t", "n,c,t", "order")]
    assert issues(ArrayType(StructType([bar[0], StructField("n", LongType(), False), bar[2]]))) == [
        ("results[].n", "nullable", "not null", "nullability")]
    assert issues(ArrayType(StructType(bar), containsNull=False)) == [("results[]", "nullable", "not null", "nullability")]
    assert issues(ArrayType(StructType([*bar[:2], StructField("v", DoubleType())]))) == [
        ("results[].t", "bigint", None, "missing"), ("results[].v", None, "double", "extra")]
    assert issues(StringType())[0][0] == "results"
    other = MapType(StringType(), StructType([bar[0], StructField("n", ArrayType(LongType()))]))
    assert issues(want["results"].dataType, other) == [("tags{value}.n", "bigint", "array<bigint>", "type")]
    with pytest.raises(quality.ValidationError, match=r"tags\{value\}.n"):
        quality.assert_schema(spark.createDataFrame([], StructType([*want.fields[:2], StructField("tags", other)])), want)


def test_duplicate_keys_lineitem(spark):
    li = fx.table(spark, SF001, "lineitem")
    d = quality.duplicate_keys(li, ["l_orderkey", "l_linenumber"])
    assert d.count() == 11785
    with pytest.raises(quality.ValidationError):
        quality.assert_primary_key(li, ["l_orderkey", "l_linenumber"])


def test_primary_key_passes_on_bars(spark):
    quality.assert_primary_key(fx.daily_prices(spark, SF0001), ["date", "ticker"])


def test_assert_not_empty(spark):
    with pytest.raises(quality.ValidationError):
        quality.assert_not_empty(spark.createDataFrame([], "a int"))
    quality.assert_not_empty(spark.range(1))
