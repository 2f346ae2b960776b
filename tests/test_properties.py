"""Property tests: gold operators against a plain-Python brute force on
random series (ties, zero prices, ISO year edges)."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bourse.operators import gold

START = dt.date(2024, 12, 20)  # the window crosses an ISO year edge

series_st = st.dictionaries(
    keys=st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.integers(0, 30)),
    values=st.sampled_from([0.0, 1.0, 1.5, 2.0, 2.5, 3.0, 10.0]),
    min_size=1, max_size=60)

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, data):
    rows = [(t, START + dt.timedelta(days=k), c) for (t, k), c in data.items()]
    return spark.createDataFrame(rows, "ticker string, date date, close double").repartition(3), rows


def div(a, b):
    return None if b == 0 else a / b


@SETTINGS
@given(series_st)
def test_relative_change_property(spark, data):
    df, rows = frame(spark, data)
    got = {r.ticker: (r.first_close, r.last_close, r.net_change)
           for r in gold.relative_change(df).collect()}
    want = {}
    for t in {r[0] for r in rows}:
        pts = sorted((d, c) for tt, d, c in rows if tt == t)
        f, l = pts[0][1], pts[-1][1]
        want[t] = (f, l, div(l - f, f))
    assert got == want


def brute_weeks(rows, stake=1_000_000.0):
    tickers = {r[0] for r in rows}
    per = stake / len(tickers)
    out = {}
    for t in tickers:
        pts = sorted((d, c) for tt, d, c in rows if tt == t)
        shares = div(per, pts[0][1])
        weeks = {}
        for d, c in pts:
            y, w, _ = d.isocalendar()
            weeks.setdefault((y, w), []).append(c)
        for (y, w), cs in weeks.items():
            if shares is None:
                out[(t, y, w)] = None
            else:
                out[(t, y, w)] = shares * cs[-1] - shares * cs[0]
    return out


@SETTINGS
@given(series_st)
def test_weekly_change_property(spark, data):
    df, rows = frame(spark, data)
    got = {(r.ticker, r.year, r.weeknum): r.net_change for r in gold.weekly_change(df).collect()}
    assert got == brute_weeks(rows)


@SETTINGS
@given(series_st, st.integers(1, 5))
def test_max_weekly_decrease_order(spark, data, n):
    df, rows = frame(spark, data)
    weeks = brute_weeks(rows)
    order = sorted(weeks.items(), key=lambda kv: (kv[1] is None, kv[1] if kv[1] is not None else 0,
                                                  kv[0][0], kv[0][1], kv[0][2]))
    want = [k for k, _ in order[:n]]
    got = [(r.ticker, r.year, r.weeknum) for r in gold.max_weekly_decrease(df, n=n).collect()]
    assert got == want


ticks_st = st.lists(
    st.tuples(st.sampled_from(["X", "Y"]), st.integers(0, 3 * 86400 // 600),   # 10-minute steps
              st.sampled_from([1.0, 2.0, 2.5, 7.0]), st.integers(1, 5)),
    min_size=1, max_size=80)


@SETTINGS
@given(ticks_st, st.sampled_from([(15, "minute"), (1, "hour"), (4, "hours"), (1, "day")]))
def test_resample_bars_property(spark, ticks, span):
    import pandas as pd
    from bourse.operators.bars import resample_bars
    base = dt.datetime(2024, 1, 1)
    rows = [(t, base + dt.timedelta(minutes=10 * k), p, float(v), i)
            for i, (t, k, p, v) in enumerate(ticks)]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, price double, "
                                     "qty double, seq long").repartition(3)
    mult, unit = span
    got = {(r.ticker, r.bar_start): r for r in resample_bars(
        df, volume="qty", multiplier=mult, timespan=unit, order_by=["ts", "seq"]).collect()}
    pdf = pd.DataFrame(rows, columns=["ticker", "ts", "price", "qty", "seq"])
    width = {"minute": 60, "hour": 3600, "hours": 3600, "day": 86400}[unit] * mult
    secs = (pdf["ts"] - pd.Timestamp(0)).dt.total_seconds().astype("int64")
    pdf["bar_start"] = pd.to_datetime((secs // width) * width, unit="s")
    pdf = pdf.sort_values(["ts", "seq"])
    assert len(got) == pdf.groupby(["ticker", "bar_start"]).ngroups
    for (t, b), g in pdf.groupby(["ticker", "bar_start"]):
        r = got[(t, b.to_pydatetime())]
        assert (r.open, r.close, r.high, r.low, r.trades) == \
            (g.price.iloc[0], g.price.iloc[-1], g.price.max(), g.price.min(), len(g))
        assert r.volume == g.qty.sum()
        assert r.vwap == pytest.approx((g.price * g.qty).sum() / g.qty.sum(), rel=1e-12)
