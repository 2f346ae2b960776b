"""Building blocks over a price series: any DataFrame with ticker, date, close.

Everything here is an aggregate with a map-side partial step, so a ticker
that holds a third of all rows is reduced to one row per partition before
the shuffle; no window is partitioned by ticker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.functions import iso_week, iso_year, parse_range


def in_range(df: DataFrame, dates=None, col: str = "date") -> DataFrame:
    """Inclusive date-range filter (P6). ``dates=None`` keeps every row.

    On a Parquet silver table the predicate reaches the scan
    (``PushedFilters``) and prunes row groups / partitions.
    """
    return df if parse_range(dates) is None else df.filter(range_test(dates, col))


def range_test(dates=None, col: str = "date") -> Column:
    """Whether ``col`` lies in the inclusive range; true for ``dates=None``,
    else NULL for a NULL date."""
    rng = parse_range(dates)
    if rng is None:
        return F.lit(True)
    lo, hi = rng
    return F.col(col).between(F.lit(lo), F.lit(hi))


def first_last_close(prices: DataFrame, keys, price: str = "close",
                     order: str = "date") -> DataFrame:
    """First and last close per group, ordered by date (A1).

    ``min_by``/``max_by`` on the date make the answer independent of the row
    order, and run as partial + final hash aggregation.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return prices.groupBy(*keys).agg(
        F.min_by(price, order).alias("first_close"),
        F.max_by(price, order).alias("last_close"),
    )


def ticker_count(df: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Exact number of distinct tickers, as a one-row DataFrame (A2)."""
    return df.agg(F.count_distinct(ticker).alias("n_tickers"))


def stake_per_ticker(df: DataFrame, stake: float, ticker: str = "ticker") -> Column:
    """``stake / number of tickers in df`` as a scalar-subquery column.

    Spark runs the one-row aggregate once and feeds the value into the
    outer plan; nothing travels through Python. NULL when ``df`` is empty.

    The subquery counts the other columns of ``df`` as well. If ``df`` is an
    aggregate whose columns the outer plan all uses, both plans then hold the
    same exchange, and Spark runs it once: the series is scanned a single
    time. An outer plan that uses fewer columns scans it twice, with the same
    result.
    """
    rest = [F.count(F.col(f"`{c}`")).alias(f"n{k}") for k, c in enumerate(df.columns) if c != ticker]
    size = df.agg(F.struct(F.count_distinct(ticker).alias("n_tickers"), *rest).alias("size")).scalar()
    return F.try_divide(F.lit(float(stake)), size["n_tickers"])


def attach_week(prices: DataFrame, calendar: DataFrame | None = None,
                date: str = "date") -> DataFrame:
    """Add ISO ``weeknum`` and ISO ``year`` to every row.

    Without a calendar both are computed in place (no join). With a calendar
    (date, weeknum, year) it is a LEFT join on date, so dates missing from
    the calendar get NULL week and year, as a calendar lookup would.
    """
    if calendar is None:
        return prices.withColumn("weeknum", iso_week(F.col(date))) \
                     .withColumn("year", iso_year(F.col(date)))
    cal = calendar.select(F.col("date").alias(date), "weeknum", "year")
    return prices.join(cal, on=date, how="left")
