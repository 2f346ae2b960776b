"""DuckDB SQL for every registered query with a SQL equivalent.

Written independently of the Spark code: plain SQL over the pre-registered
tables. Column names and the order of floating-point operations match the
Spark side; sums, vwap and CAGR are rounded through DECIMAL on both sides.
"""

from __future__ import annotations

STAKE = "CAST(1000000 AS DOUBLE)"

# daily bars of order ticks per nation.
F1_TICKS = """
f1_ticks AS (
  SELECT n.n_name AS ticker, o.o_orderdate AS ts, o.o_totalprice AS price,
         o.o_orderkey AS seq, o.o_orderstatus AS status
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

F1_BARS = F1_TICKS + """,
bars AS (
  SELECT ticker, CAST(ts AS DATE) AS date,
         min_by(price, seq) AS open, max(price) AS high, min(price) AS low,
         max_by(price, seq) AS close, count(*) AS trades,
         CAST(NULL AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS vwap
  FROM f1_ticks GROUP BY ticker, CAST(ts AS DATE))"""


def _prices(where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return F1_BARS + f""",
prices AS (SELECT ticker, date, close FROM bars {w})"""


COMPANY = """
company AS (
  SELECT n.n_name AS symbol, r.r_name AS company_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _rng(lo: str, hi: str) -> str:
    return f"date BETWEEN DATE '{lo}' AND DATE '{hi}'"


Y1997 = _rng("1997-01-01", "1997-12-31")
H1997 = _rng("1997-01-01", "1997-06-30")


def _round(expr: str, n: int) -> str:
    return f"CAST(round(TRY_CAST({expr} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def _flc(keys: str) -> str:
    return f"SELECT {keys}, min_by(close, date) AS first_close, max_by(close, date) AS last_close"


REL = "(last_close - first_close) / NULLIF(first_close, 0)"


def _relative(where: str = "") -> str:
    return f"""WITH {_prices(where)}
{_flc('ticker')}, {REL} AS net_change FROM prices GROUP BY ticker"""


def _per_year(where: str = "") -> str:
    return _prices(where) + f""",
py AS ({_flc('ticker, CAST(year(date) AS INTEGER) AS year')}
       FROM prices GROUP BY ticker, CAST(year(date) AS INTEGER)),
per AS (SELECT {STAKE} / count(DISTINCT ticker) AS s FROM py)"""


def _position_values(where: str = "") -> str:
    return f"""WITH {_per_year(where)}
SELECT ticker, year, first_close, last_close, {REL} AS net_change,
       (per.s / NULLIF(first_close, 0)) * last_close AS investment_value
FROM py CROSS JOIN per"""


def _growth(where: str = "") -> str:
    return f"""WITH {_per_year(where)},
g AS (
  SELECT ticker, year, first_close, last_close, {REL} AS net_change,
         per.s AS jan_value,
         (per.s / NULLIF(first_close, 0)) * last_close AS june_value
  FROM py CROSS JOIN per)
SELECT ticker, year, first_close, last_close, net_change, jan_value, june_value,
       (pow(june_value / jan_value, 1.0 / 0.5) - 1) * 100 AS CAGR
FROM g"""


SHIPPING = """date BETWEEN (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem)
              AND (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)"""


def _iso(calendar: bool) -> str:
    """ISO year and week of a day, NULL for days off the calendar of ship days."""
    year, week = "CAST(isoyear(date) AS INTEGER)", "CAST(weekofyear(date) AS INTEGER)"
    if calendar:
        year, week = (f"CASE WHEN {SHIPPING} THEN {x} END" for x in (year, week))
    return f"{year} AS year, {week} AS weeknum"


def _weekly(prices_cte: str, calendar: bool = False) -> str:
    return prices_cte + f""",
wk AS (
  SELECT ticker, {_iso(calendar)},
         min(date) AS week_start, max(date) AS week_end,
         min_by(close, date) AS oc, max_by(close, date) AS lc
  FROM prices GROUP BY 1, 2, 3),
base AS (SELECT ticker, min_by(close, date) AS fc FROM prices GROUP BY ticker),
per AS (SELECT {STAKE} / count(DISTINCT ticker) AS s FROM prices),
weekly AS (
  SELECT wk.ticker, year, weeknum, week_start, week_end,
         (per.s / NULLIF(base.fc, 0)) * wk.oc AS week_first_value,
         (per.s / NULLIF(base.fc, 0)) * wk.lc AS week_last_value
  FROM wk JOIN base ON wk.ticker = base.ticker CROSS JOIN per),
weekly_net AS (SELECT *, week_last_value - week_first_value AS net_change FROM weekly)"""


WEEK_ORDER = "net_change ASC NULLS LAST, ticker, year, weeknum"

EVENT_PRICES = """
prices AS (
  SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, max_by(value, ts) AS close
  FROM events GROUP BY 1, 2)"""


def _summary(where: str, growth_where: str, calendar: bool = False) -> str:
    rel = _relative(where)
    inv = f"""WITH {_per_year(where)},
pv AS (SELECT year, (per.s / NULLIF(first_close, 0)) * last_close AS v FROM py CROSS JOIN per)
SELECT year, sum(v) AS investment_value FROM pv GROUP BY year"""
    grow = _growth(growth_where)
    week = f"WITH {_weekly(_prices(where), calendar)} SELECT * FROM weekly_net"
    return f"""
SELECT b.year, a.ticker AS max_relative_increase_ticker,
       {_round('b.investment_value', 4)} AS investment_return_by_end_of_year,
       c.ticker AS max_CAGR_ticker_jan_june,
       d.ticker AS max_decrease_by_week_ticker,
       CAST(d.year AS VARCHAR) || '-' || CAST(d.weeknum AS VARCHAR) AS max_decrease_by_week_weeknum
FROM ({rel} ORDER BY net_change DESC NULLS LAST, ticker LIMIT 1) a
CROSS JOIN ({inv}) b
CROSS JOIN (SELECT * FROM ({grow}) ORDER BY CAGR DESC NULLS LAST, ticker, year LIMIT 1) c
CROSS JOIN (SELECT * FROM ({week}) ORDER BY {WEEK_ORDER} LIMIT 1) d"""


def _by_day(where: str = "", calendar: bool = False) -> str:
    return f"""WITH {_weekly(_prices(where), calendar)},
days AS (SELECT ticker, date, {_iso(calendar)} FROM prices)
SELECT d.ticker, d.date, d.year, d.weeknum, w.week_last_value, w.week_first_value, w.net_change
FROM days d JOIN weekly_net w
  ON d.ticker = w.ticker AND d.year IS NOT DISTINCT FROM w.year AND d.weeknum IS NOT DISTINCT FROM w.weeknum
ORDER BY w.net_change ASC NULLS LAST, d.ticker, d.year NULLS LAST, d.weeknum NULLS LAST, d.date LIMIT 10"""


def _job_gold(year: int, calendar: bool = False) -> str:
    full, half = _rng(f"{year}-01-01", f"{year}-12-31"), _rng(f"{year}-01-01", f"{year}-06-30")
    return f"""
SELECT 'a' AS output, ticker, CAST(NULL AS VARCHAR) AS label, {_round('net_change', 4)} AS value
FROM ({_relative(full)} ORDER BY net_change DESC NULLS LAST, ticker LIMIT 1)
UNION ALL
SELECT 'b', NULL, CAST(year AS VARCHAR), {_round('sum(investment_value)', 4)}
FROM ({_position_values(full)}) GROUP BY year
UNION ALL
SELECT 'c', ticker, CAST(year AS VARCHAR), {_round('CAGR', 4)}
FROM (SELECT * FROM ({_growth(half)}) ORDER BY CAGR DESC NULLS LAST, ticker, year LIMIT 1)
UNION ALL
SELECT 'd', ticker, CAST(date AS VARCHAR), {_round('net_change', 4)}
FROM ({_by_day(full, calendar)})
UNION ALL
SELECT 'summary', max_relative_increase_ticker,
       max_CAGR_ticker_jan_june || ' ' || max_decrease_by_week_ticker || ' ' || max_decrease_by_week_weeknum,
       investment_return_by_end_of_year
FROM ({_summary(full, half, calendar)})"""


def _bucket(us: int) -> str:
    return f"make_timestamp((epoch_us(ts) // {us}) * {us})"


def _event_bars(us: int) -> str:
    return f"""
SELECT CAST(user_id AS VARCHAR) AS ticker, {_bucket(us)} AS bar_start,
       min_by(value, ts) AS open, max(value) AS high, min(value) AS low,
       max_by(value, ts) AS close, count(*) AS trades,
       CAST(NULL AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS vwap
FROM events GROUP BY 1, 2"""


def _lineitem_bars(key: str, bucket: str = "CAST(CAST(ts AS DATE) AS TIMESTAMP)") -> str:
    return f"""
WITH t AS (
  SELECT CAST({key} AS VARCHAR) AS ticker, l_shipdate AS ts,
         l_extendedprice / NULLIF(l_quantity, 0) AS price, l_quantity AS volume,
         l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity
  FROM lineitem)
SELECT ticker, {bucket} AS bar_start,
       min_by(price, (ts, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)) AS open,
       max(price) AS high, min(price) AS low,
       max_by(price, (ts, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)) AS close,
       count(*) AS trades, sum(volume) AS volume,
       {_round('sum(price * volume) / NULLIF(sum(volume), 0)', 6)} AS vwap
FROM t GROUP BY 1, 2"""


SILVER_COLS = """b.ticker, company.company_name, b.close, b.high, b.low, b.trades, b.open,
       b.volume, b.vwap AS volume_weighted_average_price, b.date"""

ORACLE: dict[str, str] = {
    "symbols_distinct": """
SELECT DISTINCT c.c_name AS symbol FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",

    "calendar_iso": """
WITH s AS (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)),
                                         max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d
           FROM orders)
SELECT CAST(d AS DATE) AS date, CAST(weekofyear(d) AS INTEGER) AS weeknum,
       CAST(isoyear(d) AS INTEGER) AS year FROM s""",

    "bars_daily": f"""WITH {F1_BARS}
SELECT ticker, CAST(date AS TIMESTAMP) AS bar_start, open, high, low, close, trades, volume, vwap
FROM bars""",

    "bars_hourly": _event_bars(3_600_000_000),
    "bars_15min": _event_bars(900_000_000),
    "bars_stream_hourly": _event_bars(3_600_000_000),
    "bars_vwap": _lineitem_bars("l_suppkey"),
    "bars_monthly": _lineitem_bars("l_suppkey", "CAST(date_trunc('month', ts) AS TIMESTAMP)"),

    "bars_weekly": f"""WITH {F1_TICKS}
SELECT ticker, CAST(date_trunc('week', ts) AS TIMESTAMP) AS bar_start,
       min_by(price, seq) AS open, max(price) AS high, min(price) AS low,
       max_by(price, seq) AS close, count(*) AS trades,
       CAST(NULL AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS vwap
FROM f1_ticks GROUP BY 1, 2""",

    "bronze_documents": f"""WITH {F1_BARS}
SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS period, count(*) AS n_results,
       epoch_ms(CAST(min(date) AS TIMESTAMP)) AS first_t,
       epoch_ms(CAST(max(date) AS TIMESTAMP)) AS last_t
FROM bars GROUP BY 1, 2""",

    "bronze_explode": f"""WITH {F1_BARS}
SELECT ticker, close, high, low, trades, open, epoch_ms(CAST(date AS TIMESTAMP)) AS t,
       volume, vwap
FROM bars""",

    "silver_from_bronze": f"""WITH {F1_BARS}, {COMPANY}
SELECT {SILVER_COLS}, CAST(1700000000 AS BIGINT) AS ingest_epoch
FROM bars b LEFT JOIN company ON b.ticker = company.symbol""",

    "silver_build": f"""WITH {F1_BARS}, {COMPANY}
SELECT {SILVER_COLS}, CAST(1700000000 AS BIGINT) AS ingest_epoch
FROM bars b LEFT JOIN company ON b.ticker = company.symbol""",

    "silver_stream": f"""WITH {F1_BARS}, {COMPANY}
SELECT {SILVER_COLS}, CAST(1700000000 AS BIGINT) AS ingest_epoch
FROM bars b LEFT JOIN company ON b.ticker = company.symbol""",

    "company_left_join": f"""WITH bars AS ({_lineitem_bars("l_partkey")})
SELECT b.ticker, CAST(b.bar_start AS DATE) AS date, b.close, s.s_name AS company_name
FROM bars b LEFT JOIN supplier s ON b.ticker = CAST(s.s_suppkey AS VARCHAR)""",

    "corrupt_documents": """
SELECT CASE o_orderpriority
         WHEN '1-URGENT' THEN substr('{"ticker":"' || o_orderkey || '","resultsCount":1,"results":[{"c":', 1, 24)
         ELSE '{"ticker":"' || o_orderkey || '","resultsCount":1,"results":[{"c":"high","t":0}]}' END AS document
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",

    "job_gold": _job_gold(1997),
    "job_gold_two_years": f"""
SELECT 1996 AS job_year, * FROM ({_job_gold(1996)})
UNION ALL SELECT 1997, * FROM ({_job_gold(1997)})""",
    "job_gold_calendar": _job_gold(1997, calendar=True),

    "schema_drift": f"""WITH {F1_BARS},
seen AS (SELECT count(volume) AS volumes, count(vwap) AS vwaps FROM bars)
SELECT 'period' AS path, CAST(NULL AS VARCHAR) AS expected, 'string' AS actual, 'extra' AS issue
UNION ALL SELECT '', 'ticker,resultsCount,results', 'results,resultsCount,ticker', 'order'
UNION ALL SELECT 'results[].v', 'double', NULL, 'missing' FROM seen WHERE volumes = 0
UNION ALL SELECT 'results[].vw', 'double', NULL, 'missing' FROM seen WHERE vwaps = 0""",

    "keep_latest": f"""WITH {F1_BARS}, {COMPANY},
later AS (
  SELECT ticker, CAST(ts AS DATE) AS date,
         min_by(price, seq) AS open, max(price) AS high, min(price) AS low,
         max_by(price, seq) AS close, count(*) AS trades,
         CAST(NULL AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS vwap
  FROM f1_ticks WHERE status = 'F' GROUP BY ticker, CAST(ts AS DATE)),
u AS (
  SELECT *, CAST(1700000000 AS BIGINT) AS ingest_epoch FROM bars
  UNION ALL
  SELECT *, CAST(1700086400 AS BIGINT) AS ingest_epoch FROM later),
latest AS (
  SELECT * FROM u
  QUALIFY row_number() OVER (PARTITION BY date, ticker ORDER BY ingest_epoch DESC) = 1)
SELECT {SILVER_COLS}, b.ingest_epoch
FROM latest b LEFT JOIN company ON b.ticker = company.symbol""",

    "date_range_filter": f"WITH {_prices(Y1997)} SELECT ticker, date, close FROM prices",

    "first_last_close": f"WITH {_prices()} {_flc('ticker')} FROM prices GROUP BY ticker",

    "ticker_count": f"WITH {_prices()} SELECT count(DISTINCT ticker) AS n_tickers FROM prices",

    "relative_change": _relative(),

    "relative_change_by_year": f"""SELECT *, row_number() OVER (ORDER BY net_change DESC NULLS LAST, ticker, year) AS rank
FROM (WITH {_prices()}
{_flc('ticker, CAST(year(date) AS INTEGER) AS year')}, {REL} AS net_change
FROM prices GROUP BY ticker, CAST(year(date) AS INTEGER))""",

    "max_relative_increase": _relative() + " ORDER BY net_change DESC NULLS LAST, ticker LIMIT 1",

    "max_relative_increase_1997": _relative(Y1997)
    + " ORDER BY net_change DESC NULLS LAST, ticker LIMIT 1",

    "position_values": _position_values(),

    "investment_return": f"""SELECT year, {_round('sum(investment_value)', 4)} AS investment_value
FROM ({_position_values()}) GROUP BY year""",

    "investment_return_1997": f"""SELECT year, {_round('sum(investment_value)', 4)} AS investment_value
FROM ({_position_values(Y1997)}) GROUP BY year""",

    "growth_rate": f"""SELECT ticker, year, first_close, last_close, net_change, jan_value,
       june_value, {_round('CAGR', 6)} AS CAGR FROM ({_growth()})""",

    "max_cagr": f"""SELECT ticker, year, first_close, last_close, net_change, jan_value,
       june_value, {_round('CAGR', 6)} AS CAGR
FROM ({_growth(H1997)}) ORDER BY CAGR DESC NULLS LAST, ticker, year LIMIT 1""",

    "max_cagr_all": f"""SELECT ticker, year, first_close, last_close, net_change, jan_value,
       june_value, {_round('CAGR', 6)} AS CAGR
FROM ({_growth()}) ORDER BY CAGR DESC NULLS LAST, ticker, year LIMIT 1""",

    "day_values": f"""WITH {_prices()},
base AS (SELECT ticker, min_by(close, date) AS first_close FROM prices GROUP BY ticker),
per AS (SELECT {STAKE} / count(*) AS s FROM base)
SELECT p.ticker, p.date, p.close, base.first_close,
       per.s / NULLIF(base.first_close, 0) AS shares,
       (per.s / NULLIF(base.first_close, 0)) * p.close AS day_value
FROM prices p JOIN base ON p.ticker = base.ticker CROSS JOIN per""",

    "weekly_change": f"WITH {_weekly(_prices())} SELECT * FROM weekly_net",

    "weekly_change_events": f"WITH {_weekly(EVENT_PRICES)} SELECT * FROM weekly_net",

    "max_weekly_decrease": f"""WITH {_weekly(_prices())}
SELECT * FROM weekly_net ORDER BY {WEEK_ORDER} LIMIT 10""",

    "weekly_change_by_day_1997": _by_day(Y1997),

    "weekly_change_by_day": _by_day(),

    "week_join_calendar": f"""WITH {_prices()}
SELECT ticker, date, close,
       CASE WHEN {SHIPPING} THEN CAST(weekofyear(date) AS INTEGER) END AS weeknum,
       CASE WHEN {SHIPPING} THEN CAST(isoyear(date) AS INTEGER) END AS year
FROM prices""",

    "consolidate": _summary(Y1997, H1997),
    "consolidate_all": _summary("", ""),

    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",

    "landed_completeness": """
SELECT CAST(o_orderkey AS VARCHAR) AS symbol FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",

    "missing_results": """
SELECT CAST(o_orderkey AS VARCHAR) AS ticker FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
}
ORACLE["silver_from_provider_docs"] = ORACLE["silver_incremental"] = ORACLE["silver_build"]
ORACLE["week_join_calendar_parquet"] = ORACLE["week_join_calendar"]
