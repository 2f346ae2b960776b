"""ISO calendar generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.functions import iso_week, iso_year, parse_range


def _with_iso(days: DataFrame) -> DataFrame:
    return days.select("date", iso_week(F.col("date")).alias("weeknum"),
                       iso_year(F.col("date")).alias("year"))


def calendar(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end]: date, ISO week, ISO year.

    Days come from ``spark.range`` (split across tasks), not from a list
    built on the driver.
    """
    lo, hi = parse_range((start, end))
    n = (hi - lo).days + 1
    days = spark.range(0, n).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("date"))
    return _with_iso(days)


def calendar_spanning(df: DataFrame, col: str = "date") -> DataFrame:
    """The ISO calendar from the first to the last date found in ``df[col]``.

    The bounds are a one-row aggregate; the day list it expands to is
    bounded by the span in days (about 366 per year), not by the data size.
    """
    span = df.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return _with_iso(days)
