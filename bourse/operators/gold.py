"""Gold questions over a daily price series (ticker, date, close).

a. relative price change          relative_change / max_relative_increase
b. equal-weight buy-and-hold      position_values / investment_return
c. compound growth rate           growth_rate / max_cagr
d. largest fall within a week     day_values / weekly_change /
                                  max_weekly_decrease / weekly_change_by_day
   summary                        consolidate
   all of them from one scan      answers

Semantics follow the reference pipeline, made deterministic:
first/last close are taken in date order (not row order), every ordering
ends with the key columns, every division is NULL-safe, and the stake per
ticker is ``stake / number of tickers present in the range``. Years in b.
and c. are calendar years; weeks in d. are ISO weeks with their ISO year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bourse.functions import safe_div
from bourse.operators.prices import (attach_week, first_last_close, in_range, range_test,
                                     stake_per_ticker)
from bourse.operators.ranks import places
from bourse.session import staged

DEFAULT_STAKE = 1_000_000


def _net_change(first: str = "first_close", last: str = "last_close"):
    return safe_div(F.col(last) - F.col(first), F.col(first)).alias("net_change")


def _desc(col: str):
    """Largest first; neither NULL nor NaN wins."""
    return F.desc_nulls_last(F.nanvl(F.col(col), F.lit(None).cast("double")))


# --------------------------------------------------------------------------
# a. relative change
# --------------------------------------------------------------------------

def relative_change(prices: DataFrame, dates=None, by_year: bool = False) -> DataFrame:
    """Per ticker (and calendar year if ``by_year``): first close, last close,
    ``net_change = (last - first) / first`` over the range (G1, G3)."""
    p = in_range(prices, dates)
    keys = ["ticker"]
    if by_year:
        p = p.withColumn("year", F.year("date"))
        keys.append("year")
    flc = first_last_close(p, keys)
    return flc.select(*keys, "first_close", "last_close", _net_change())


def relative_change_by_year(prices: DataFrame, dates=None, ranked: bool = False) -> DataFrame:
    """Per (ticker, year), largest change first. With ``ranked`` each row
    carries its place in that order (``rank``, from 1), so the order can be
    checked and kept; the places are counted by range partition, without a
    window over all rows (``ranks.places``)."""
    order = [_desc("net_change"), F.asc("ticker"), F.asc("year")]
    changes = relative_change(prices, dates, by_year=True)
    return places(changes, order, name="rank").orderBy("rank") if ranked else changes.orderBy(*order)


def max_relative_increase(prices: DataFrame, dates=None, n: int = 1) -> DataFrame:
    """ticker(s) with the greatest relative increase (top ``n``)."""
    return _top_change(relative_change(prices, dates), n)


def _top_change(changes: DataFrame, n: int) -> DataFrame:
    return changes.orderBy(_desc("net_change"), F.asc("ticker")).limit(n)


# --------------------------------------------------------------------------
# b. equal-weight buy-and-hold
# --------------------------------------------------------------------------

def _per_ticker_year(prices: DataFrame, dates) -> DataFrame:
    p = in_range(prices, dates).withColumn("year", F.year("date"))
    return first_last_close(p, ["ticker", "year"])


def position_values(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE) -> DataFrame:
    """Value at the last close of ``stake / N`` bought at the first close,
    per (ticker, calendar year); N = tickers present in the range."""
    return _positions(_per_ticker_year(prices, dates), stake)


def _positions(flc: DataFrame, stake: float) -> DataFrame:
    flc = flc.withColumn("_per", stake_per_ticker(flc, stake))
    return flc.select(
        "ticker", "year", "first_close", "last_close", _net_change(),
        (safe_div(F.col("_per"), F.col("first_close")) * F.col("last_close")).alias("investment_value"),
    )


def investment_return(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE) -> DataFrame:
    """Portfolio value per calendar year. Each year restarts from the
    full stake per ticker (no compounding), as in the reference."""
    return _portfolio(position_values(prices, dates, stake))


def _portfolio(positions: DataFrame) -> DataFrame:
    return positions.groupBy("year").agg(F.sum("investment_value").alias("investment_value"))


# --------------------------------------------------------------------------
# c. compound growth rate
# --------------------------------------------------------------------------

def growth_rate(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE,
                years: float = 0.5) -> DataFrame:
    """Per (ticker, calendar year): jan_value = stake / N,
    june_value = jan_value / first_close * last_close,
    CAGR = ((june_value / jan_value) ^ (1 / years) - 1) * 100.

    ``years`` is the length of the range in years (0.5 for January-June).
    """
    return _growth(_per_ticker_year(prices, dates), stake, years)


def _growth(flc: DataFrame, stake: float, years: float) -> DataFrame:
    if years <= 0:
        raise ValueError("years must be > 0")
    flc = flc.withColumn("_per", stake_per_ticker(flc, stake))
    per = F.col("_per")
    jan = per.alias("jan_value")
    june = (safe_div(per, F.col("first_close")) * F.col("last_close"))
    cagr = (F.pow(safe_div(june, per), F.lit(1.0 / years)) - F.lit(1)) * F.lit(100)
    return flc.select("ticker", "year", "first_close", "last_close", _net_change(),
                      jan, june.alias("june_value"), cagr.alias("CAGR"))


def max_cagr(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE,
             years: float = 0.5, n: int = 1) -> DataFrame:
    """Top ``n`` rows of ``growth_rate`` by CAGR."""
    return _top_growth(growth_rate(prices, dates, stake, years), n)


def _top_growth(growth: DataFrame, n: int) -> DataFrame:
    return growth.orderBy(_desc("CAGR"), "ticker", "year").limit(n)


# --------------------------------------------------------------------------
# d. weekly fall
# --------------------------------------------------------------------------

# Salt buckets for the day-row join on ticker (fixed value).
DAY_JOIN_SALT = 32


def day_values(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE,
               salt: int = DAY_JOIN_SALT) -> DataFrame:
    """Every day's value of the position bought at the first close of the
    whole range: shares = (stake / N) / first_close, day_value = shares * close.

    The per-ticker base (one row per ticker) is joined to every day row.
    Spark broadcasts it when its measured size allows (AQE); otherwise the
    join is a shuffle, and a hot ticker's day rows are spread over ``salt``
    join keys (a deterministic hash of the date) while the base is repeated
    once per salt value, so no single task receives a whole ticker. The base
    is written to the shared folder at the call and gives N too, so the
    series is read twice.
    """
    p = in_range(prices, dates)
    base = staged(p.groupBy("ticker").agg(F.min_by("close", "date").alias("first_close")), "base")
    base = base.withColumn("shares", safe_div(stake_per_ticker(base, stake), F.col("first_close")))
    rows = p.select("ticker", "date", "close")
    if salt > 1:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("date"), F.lit(salt)))
        salts = F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")
        base = base.withColumn("_salt", F.explode(salts))
        joined = rows.join(base, ["ticker", "_salt"])
    else:
        joined = rows.join(base, "ticker")
    shares = F.col("shares")
    return joined.select("ticker", "date", "close", "first_close", shares.alias("shares"),
                         (shares * F.col("close")).alias("day_value"))


def _weeks(prices: DataFrame, dates, calendar, *more) -> DataFrame:
    """Opening and last close of each week, and ``more`` aggregates: no more
    than the caller uses, so that the stake's subquery shares the exchange."""
    p = attach_week(in_range(prices, dates).select("ticker", "date", "close"), calendar)
    return p.groupBy("ticker", "year", "weeknum").agg(
        F.min("date").alias("week_start"), F.min_by("close", "date").alias("_open_close"),
        F.max_by("close", "date").alias("_last_close"), *more)


def _week_values(weeks: DataFrame, stake: float) -> DataFrame:
    # The range's first close per ticker, read off the week rows: a window
    # over at most one row per week of the range, so bounded for any ticker.
    per = stake_per_ticker(weeks, stake)
    weeks = weeks.withColumn("_first_close", F.min_by("_open_close", "week_start").over(
        Window.partitionBy("ticker")))
    weeks = weeks.withColumn("_shares", safe_div(per, F.col("_first_close")))
    shares = F.col("_shares")
    return weeks.withColumn("week_first_value", shares * F.col("_open_close")) \
                .withColumn("week_last_value", shares * F.col("_last_close")) \
                .withColumn("net_change", F.col("week_last_value") - F.col("week_first_value"))


def weekly_change(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE,
                  calendar: DataFrame | None = None) -> DataFrame:
    """Per (ticker, ISO year, ISO week): value of the position on the
    first and on the last trading day of the week and their difference
    (money, intra-week). ``week_start``/``week_end`` show partial weeks.

    Plan: one aggregate to week grain (partial agg, skew-proof); the range's
    first close per ticker is read off the week rows; N is a scalar
    subquery over the same exchange.
    """
    return _week_values(_weeks(prices, dates, calendar, F.max("date").alias("week_end")), stake).select(
        "ticker", "year", "weeknum", "week_start", "week_end",
        "week_first_value", "week_last_value", "net_change")


def _week_order():
    return [F.asc_nulls_last("net_change"), F.asc("ticker"),
            F.asc_nulls_last("year"), F.asc_nulls_last("weeknum")]


def max_weekly_decrease(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE,
                        n: int = 10, calendar: DataFrame | None = None) -> DataFrame:
    """The ``n`` weeks with the largest fall (most negative net_change)."""
    return weekly_change(prices, dates, stake, calendar).orderBy(*_week_order()).limit(n)


def weekly_change_by_day(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE,
                         n: int = 10, calendar: DataFrame | None = None) -> DataFrame:
    """The reference's output grain: each week repeated once per trading
    day, first ``n`` rows by (net_change, ticker, year, weeknum, date).

    The first ``n`` day rows can only come from the first ``n`` weeks, so the
    weeks are cut to ``n`` first. Without a calendar the week aggregate keeps
    the weekdays that have rows as bits of an integer, expanded for the top
    weeks only: no second pass, no join, and a repeated day comes once. With a calendar, days off
    the calendar share one NULL week per ticker (unbounded), so the top
    weeks (at most ``n`` rows) are joined back to the day rows instead.
    """
    # The weekdays with a row, as bits: an integer, however often a day comes.
    days = [F.bit_or(F.expr("shiftleft(1, weekday(date))")).alias("_days")] if calendar is None else []
    weeks = _week_values(_weeks(prices, dates, calendar, *days), stake)
    return _top_days(weeks, prices, dates, n, calendar)


# Columns of d. at day grain (fixed values).
DAY_COLUMNS = ["ticker", "date", "year", "weeknum", "week_last_value", "week_first_value",
               "net_change"]


def _top_days(weeks: DataFrame, prices: DataFrame, dates, n: int,
              calendar: DataFrame | None) -> DataFrame:
    values = DAY_COLUMNS[4:]
    top = weeks.orderBy(*_week_order()).limit(n)
    if calendar is None:
        weekday = F.filter(F.sequence(F.lit(0), F.lit(6)),
                           lambda d: F.col("_days").bitwiseAND(F.pow(F.lit(2), d).cast("int")) != 0)
        monday = F.date_trunc("week", "week_start").cast("date")
        days = top.select("*", F.explode(weekday).alias("_d")) \
                  .select("ticker", F.date_add(monday, F.col("_d")).alias("date"), "year", "weeknum", *values)
    else:
        top = top.select(F.col("ticker").alias("_t"), F.col("year").alias("_y"),
                         F.col("weeknum").alias("_w"), *values)
        rows = attach_week(in_range(prices, dates).select("ticker", "date"), calendar)
        cond = ((rows["ticker"] == top["_t"]) & rows["year"].eqNullSafe(top["_y"])
                & rows["weeknum"].eqNullSafe(top["_w"]))
        days = rows.join(top, cond).select(*DAY_COLUMNS)
    return days.orderBy(*_week_order(), F.asc("date")).limit(n)


# --------------------------------------------------------------------------
# all answers from one scan
# --------------------------------------------------------------------------

# Columns of the summary (fixed values).
SUMMARY_COLUMNS = ["max_relative_increase_ticker", "investment_return_by_end_of_year",
                   "max_CAGR_ticker_jan_june", "max_decrease_by_week_ticker",
                   "max_decrease_by_week_weeknum"]


def week_frame(prices: DataFrame, dates=None, growth_dates=None,
               calendar: DataFrame | None = None) -> DataFrame:
    """First and last date and close, and the weekdays with a row, per
    (ticker, calendar year, ISO year, ISO week, in the range, in the growth
    range): what every gold answer follows from.

    One scan and one hash aggregate; written to the shared folder, so that
    each answer reads these few rows and never the series again.
    """
    full, growth = range_test(dates), range_test(growth_dates)
    p = attach_week(prices.filter(full | growth).select("ticker", "date", "close"), calendar)
    return staged(p.groupBy("ticker", F.year("date").alias("calendar_year"), "year", "weeknum",
                            full.alias("in_range"), growth.alias("in_growth")).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close"),
        F.bit_or(F.expr("shiftleft(1, weekday(date))")).alias("days")), "weeks")


def _fold(frame: DataFrame, *keys) -> DataFrame:
    return frame.groupBy(*keys).agg(F.min_by("first_close", "first_date").alias("first_close"),
                                    F.max_by("last_close", "last_date").alias("last_close"))


def answers(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE, growth_dates=None,
            growth_years: float = 0.5, n: int = 10,
            calendar: DataFrame | None = None) -> dict[str, DataFrame]:
    """The gold set: ``a`` (max_relative_increase), ``b``
    (investment_return), ``c`` (max_cagr over ``growth_dates``; default: the
    same range), ``d`` (weekly_change_by_day, ``n`` rows) and ``summary``
    (consolidate), all from one ``week_frame``, which is built at the call.
    Only d. with a calendar reads the series once more, for the days of its
    ``n`` weeks.
    """
    frame = week_frame(prices, dates, growth_dates if growth_dates is not None else dates, calendar)
    full = frame.filter("in_range")
    year = F.col("calendar_year").alias("year")
    a = _top_change(_fold(full, "ticker").select("ticker", "first_close", "last_close", _net_change()), 1)
    b = _portfolio(_positions(_fold(full, "ticker", year), stake))
    c = _top_growth(_growth(_fold(frame.filter("in_growth"), "ticker", year), stake, growth_years), 1)
    weeks = _week_values(full.groupBy("ticker", "year", "weeknum").agg(
        F.min("first_date").alias("week_start"), F.max("last_date").alias("week_end"),
        F.min_by("first_close", "first_date").alias("_open_close"),
        F.max_by("last_close", "last_date").alias("_last_close"),
        F.bit_or("days").alias("_days")), stake)
    d = _top_days(weeks, prices, dates, n, calendar)
    return {"a": a, "b": b, "c": c, "d": d,
            "summary": _summary(a, b, c, weeks.orderBy(*_week_order()).limit(1))}


def _summary(a: DataFrame, b: DataFrame, c: DataFrame, week: DataFrame) -> DataFrame:
    # a., c. and d. are single rows, stacked and folded into one by a global
    # aggregate.
    a = a.select(F.col("ticker").alias("max_relative_increase_ticker"))
    b = b.select("year", F.col("investment_value").alias("investment_return_by_end_of_year"))
    c = c.select(F.col("ticker").alias("max_CAGR_ticker_jan_june"))
    d = week.select(
        F.col("ticker").alias("max_decrease_by_week_ticker"),
        F.concat(F.col("year").cast("string"), F.lit("-"),
                 F.col("weeknum").cast("string")).alias("max_decrease_by_week_weeknum"))
    stacked = a.unionByName(c, allowMissingColumns=True).unionByName(d, allowMissingColumns=True)
    row = stacked.agg(F.struct(*[F.max(x).alias(x) for x in SUMMARY_COLUMNS if x in stacked.columns]).alias("_r"))
    return b.withColumn("_r", row.scalar()).select("year", *[
        F.col(x) if x in b.columns else F.col(f"_r.{x}").alias(x) for x in SUMMARY_COLUMNS])


def consolidate(prices: DataFrame, dates=None, stake: float = DEFAULT_STAKE,
                growth_dates=None, growth_years: float = 0.5,
                calendar: DataFrame | None = None) -> DataFrame:
    """A. ticker, b. value, c. ticker over ``growth_dates`` (default:
    same range), d. ticker and ``year-week``: one row for each calendar year
    of the range, as b. has a value for each; a., c. and d. are answers over
    the whole range and repeat. An empty range yields no row. The series is
    read once (``answers``).
    """
    return answers(prices, dates, stake, growth_dates, growth_years, 1, calendar)["summary"]
