"""SQL the registered queries are checked against, over the same tables.

Statements are composed from the shared views below and state each result in
relational terms: range comparisons, row numbers, correlated subqueries and
products where the Spark plans use intervals and conditional aggregates.
"""

from __future__ import annotations

from registered.inputs import CASH_STAMP, COINS, EQUITIES, HOLIDAYS, PAIRS, VALID_UP_TO

# Fixed value of the audited types.
CLOSE_LIMIT = 250


def _case(column: str, table: dict[str, str], default: str) -> str:
    whens = " ".join("WHEN '{}' THEN '{}'".format(k, v.replace("'", "''")) for k, v in table.items())
    return f"CASE {column} {whens} ELSE {default} END"


_STAMP = "CAST({0} + 1 AS VARCHAR) || 'T06:00:00'"
_YMD = "strftime({0}, '%Y%m%d')"

_BAR = """
    first(price ORDER BY ok, ln, price) AS open, max(price) AS high, min(price) AS low,
    last(price ORDER BY ok, ln, price) AS close, sum(qty) AS volume,
    CAST(sum(CAST(ext AS DECIMAL(12, 2))) AS DOUBLE) / sum(qty) AS vwap
"""

# View name -> definition; a query lists the views it needs, in this order.
_VIEWS = {
    "points": f"""
        SELECT {_case("o_orderpriority", COINS, "o_orderpriority")} AS coin, o_orderkey AS k,
               CAST(o_orderdate AS DATE) AS data_date, o_orderdate AS data_timestamp, o_totalprice AS price,
               CAST(o_custkey AS DOUBLE) AS vol
        FROM orders""",
    "series": f"""
        SELECT coin AS asset_id, 'Coin ' || coin AS asset_name, 'crypto' AS asset_type, data_date, data_timestamp,
               price AS close_price, price * 1000 AS market_cap_usd, vol AS volume_usd,
               'coingecko_market_chart_' || {_YMD.format("data_date")} || '_' || coin AS __batch_id,
               {_STAMP.format("data_date")} AS __ingested_at
        FROM points p
        WHERE price > 0 AND NOT EXISTS (
            SELECT 1 FROM points q WHERE q.coin = p.coin AND q.data_date = p.data_date
              AND (q.data_timestamp > p.data_timestamp
                   OR (q.data_timestamp = p.data_timestamp AND q.k > p.k)))""",
    "trades": """
        SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_returnflag AS flag,
               CAST(l_shipdate AS DATE) AS data_date, l_extendedprice / l_quantity AS price,
               l_quantity AS qty, l_extendedprice AS ext
        FROM lineitem""",
    "raw_bars": f"""
        SELECT p_brand AS ticker, data_date, {_BAR}
        FROM trades JOIN part ON p_partkey = pk GROUP BY p_brand, data_date""",
    "raw_rates": f"""
        SELECT {_case("flag", PAIRS, "flag")} AS ticker, data_date, {_BAR}
        FROM trades GROUP BY flag, data_date""",
    "bars": f"""
        SELECT ticker AS asset_id, data_date, close AS close_price, open AS open_price, high AS high_price,
               low AS low_price, volume, vwap,
               {_case("ticker", {k: v[1] for k, v in EQUITIES.items()}, "'unknown'")} AS asset_type,
               {_case("ticker", {k: v[0] for k, v in EQUITIES.items()}, "ticker")} AS asset_name,
               'massive_stocks_' || {_YMD.format("data_date")} || '_' || ticker AS __batch_id,
               {_STAMP.format("data_date")} AS __ingested_at
        FROM raw_bars WHERE close > 0 AND ticker IS NOT NULL AND data_date IS NOT NULL""",
    "rates": f"""
        SELECT substr(ticker, 3, 3) AS asset_id, data_date, close AS close_price, open AS open_price,
               high AS high_price, low AS low_price, volume, 'fiat' AS asset_type,
               {_case("ticker", {"C:EURUSD": "Euro", "C:GBPUSD": "British Pound"}, "ticker")} AS asset_name,
               ticker AS raw_ticker,
               'massive_forex_' || {_YMD.format("data_date")} || '_' || replace(ticker, ':', '_') AS __batch_id,
               {_STAMP.format("data_date")} AS __ingested_at
        FROM raw_rates WHERE close > 0 AND data_date IS NOT NULL""",
    "prices": f"""
        SELECT asset_id, asset_name, asset_type, data_date, close_price, CAST(NULL AS DOUBLE) AS open_price,
               CAST(NULL AS DOUBLE) AS high_price, CAST(NULL AS DOUBLE) AS low_price, CAST(NULL AS DOUBLE) AS volume,
               CAST(NULL AS DOUBLE) AS vwap, market_cap_usd, volume_usd, __batch_id, __ingested_at FROM series
        UNION ALL BY NAME SELECT * FROM bars
        UNION ALL BY NAME SELECT * EXCLUDE (raw_ticker) FROM rates
        UNION ALL BY NAME
        SELECT 'USD' AS asset_id, 'US Dollar' AS asset_name, 'fiat' AS asset_type, data_date,
               CAST(1 AS DOUBLE) AS close_price, CAST(1 AS DOUBLE) AS open_price, CAST(1 AS DOUBLE) AS high_price,
               CAST(1 AS DOUBLE) AS low_price, CAST(0 AS DOUBLE) AS volume, 'synthetic' AS __batch_id,
               '{CASH_STAMP}' AS __ingested_at
        FROM series WHERE asset_id = 'BTC'""",
    "holidays": """
        SELECT make_date(CAST(y AS BIGINT), CAST(m AS BIGINT), CAST(d AS BIGINT)) AS holiday_date,
               holiday_name, market_status, market_code
        FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
             (VALUES """ + ", ".join(
        "({}, {}, '{}', '{}', '{}')".format(m, d, n.replace("'", "''"), s, c) for m, d, n, s, c in HOLIDAYS) + """
             ) AS h(m, d, holiday_name, market_status, market_code)""",
    "dates": """
        SELECT d AS date,
               CASE WHEN isodow(d) >= 6 OR EXISTS (SELECT 1 FROM holidays WHERE holiday_date = d
                    AND market_code = 'US' AND market_status = 'closed') THEN 0 ELSE 1 END AS us,
               CASE WHEN isodow(d) >= 6 OR EXISTS (SELECT 1 FROM holidays WHERE holiday_date = d
                    AND market_code = 'UK' AND market_status = 'closed') THEN 0 ELSE 1 END AS uk,
               CASE WHEN isodow(d) >= 6 OR EXISTS (SELECT 1 FROM holidays WHERE holiday_date = d
                    AND market_code = 'EU' AND market_status = 'closed') THEN 0 ELSE 1 END AS eu
        FROM (SELECT DISTINCT data_date AS d FROM prices)""",
    "filled": """
        SELECT s.asset_id, p.asset_name, p.asset_type, s.date AS data_date, p.close_price,
               CASE WHEN p.data_date = s.date THEN 'OBSERVED' ELSE 'IMPUTED' END AS price_source,
               p.__batch_id, p.__ingested_at
        FROM (SELECT a.asset_id, d.date FROM (SELECT DISTINCT asset_id FROM prices) a, dates d) s
        ASOF JOIN prices p ON s.asset_id = p.asset_id AND s.date >= p.data_date""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY data_date) AS n FROM prices""",
    "returns": """
        SELECT c.asset_id, c.asset_name, c.asset_type, c.data_date, c.close_price,
               p.close_price AS prev_close_price,
               CASE WHEN p.close_price > 0 THEN (c.close_price - p.close_price) / p.close_price END AS daily_return,
               c.data_date - p.data_date AS days_gap, c.__batch_id, c.__ingested_at, c.n
        FROM numbered c LEFT JOIN numbered p ON p.asset_id = c.asset_id AND p.n = c.n - 1""",
    "gaps": """
        SELECT a.asset_id, a.asset_type, d.date AS missing_date, d.us AS is_trading_day
        FROM (SELECT asset_id, asset_type, min(data_date) AS lo, max(data_date) AS hi
              FROM prices GROUP BY asset_id, asset_type) a
        JOIN dates d ON d.date BETWEEN a.lo AND a.hi
        WHERE (a.asset_type IN ('crypto', 'fiat') OR d.us = 1)
          AND NOT EXISTS (SELECT 1 FROM prices p WHERE p.asset_id = a.asset_id AND p.data_date = d.date)""",
    "audits": f"""
        SELECT event_type, CAST(ts AS DATE) AS day, max(value) AS worst, max(ts) AS t1, min(ts) AS t0,
               max(value) <= {VALID_UP_TO} AS ok
        FROM events GROUP BY event_type, CAST(ts AS DATE)""",
}

_NEEDS = {
    "points": [], "series": ["points"], "trades": [], "raw_bars": ["trades"], "raw_rates": ["trades"],
    "bars": ["raw_bars"], "rates": ["raw_rates"], "prices": ["series", "bars", "rates"], "holidays": [],
    "dates": ["prices", "holidays"], "filled": ["prices", "dates"], "numbered": ["prices"], "returns": ["numbered"],
    "gaps": ["prices", "dates"], "audits": [],
}


def _sql(views: str, body: str) -> str:
    wanted: set[str] = set()

    def need(name: str) -> None:
        wanted.add(name)
        for other in _NEEDS[name]:
            need(other)

    for name in views.split():
        need(name)
    parts = [f"{name} AS MATERIALIZED ({_VIEWS[name]})" for name in _VIEWS if name in wanted]
    with_clause = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return with_clause + body


def _day(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def _r(expression: str, digits: int, name: str) -> str:
    """Rounded; adding zero turns a negative zero into zero."""
    return f"round({expression}, {digits}) + 0.0 AS {name}"


_ROLL = ",\n".join(
    f"{_r(f'avg(daily_return) OVER w{n}', 8, f'avg_return_{n}d')},"
    f"{_r(f'stddev_samp(daily_return) OVER w{n}', 8, f'volatility_{n}d')},"
    f"count(daily_return) OVER w{n} AS obs_count_{n}d" for n in (7, 14, 30))
_ROLL_WINDOWS = ", ".join(
    f"w{n} AS (PARTITION BY asset_id ORDER BY n ROWS {n - 1} PRECEDING)" for n in (7, 14, 30))
_FIRST = "(SELECT f.close_price FROM numbered f WHERE f.asset_id = r.asset_id AND f.n = 1)"


def _rolling(extra: str) -> str:
    return f"""
        SELECT asset_id, asset_name, asset_type, {_day("data_date")}, close_price, daily_return, {_ROLL}, {extra}
               close_price / {_FIRST} - 1 AS cumulative_return_from_start
        FROM returns r WINDOW {_ROLL_WINDOWS}"""


_PERIODS = """
    periods(period, start_day) AS (
        SELECT period, CASE WHEN days IS NULL THEN CAST(date_trunc('year', e) AS DATE) ELSE e - days END
        FROM (VALUES ('7D', 7), ('1M', 30), ('3M', {m3}), ('6M', {m6}), ('1Y', 365), ('YTD', NULL)) AS v(period, days),
             ({end}) AS z(e))"""

_INVEST = """,
    latest AS (SELECT max(data_date) AS e FROM filled),
    wanted AS (
        SELECT 'Lump Sum' AS strategy, CAST(e - 365 AS DATE) AS due, 1000.0::DOUBLE AS amount FROM latest
        UNION ALL
        SELECT 'DCA', CAST(e - to_months(CAST(k AS INTEGER)) AS DATE), 100.0::DOUBLE FROM latest, range(12) AS t(k)),
    buys AS (
        SELECT f.asset_id, w.strategy, w.due, w.amount, arg_min(f.close_price, f.data_date) AS price
        FROM wanted w JOIN filled f ON f.data_date >= w.due GROUP BY ALL),
    held AS (
        SELECT b.asset_id, b.strategy, sum(b.amount) AS invested, max(c.close_price) AS current,
               -- Newest purchase first: a mean can lie exactly between two cents, so the order of addition counts.
               list_reduce(list(b.price ORDER BY b.due DESC), lambda x, y: x + y) / count(*) AS mean_price,
               list_reduce(list(b.amount / b.price ORDER BY b.due DESC), lambda x, y: x + y) AS units
        FROM buys b JOIN filled c ON c.asset_id = b.asset_id AND c.data_date = (SELECT e FROM latest)
        GROUP BY b.asset_id, b.strategy)
    SELECT asset_id AS asset, strategy, round(invested, 2) AS initial_investment_usd,
           round(mean_price, 2) AS avg_purchase_price, round(current, 2) AS current_price,
           round(units, 8) AS btc_amount, round(units * current, 2) AS current_value_usd,
           round(units * current - invested, 2) + 0.0 AS profit_loss_usd,
           round((units * current / invested - 1) * 100, 2) + 0.0 AS return_pct
    FROM held"""

_HOLDING = """
    SELECT p.asset_id, p.data_date, p.close_price,
           p.close_price * (1000.0::DOUBLE / f.close_price) AS investment_value
    FROM prices p JOIN numbered f ON f.asset_id = p.asset_id AND f.n = 1"""

_DCA = """,
    starts AS (SELECT asset_id, data_date AS s, close_price AS first_price FROM numbered WHERE n = 1),
    dues AS (SELECT asset_id, k, CAST(s + to_months(CAST(k AS INTEGER)) AS DATE) AS due
             FROM starts, range(12) AS t(k)),
    bought AS (
        SELECT d.asset_id, d.k, min(p.data_date) AS day, arg_min(p.close_price, p.data_date) AS price
        FROM dues d JOIN prices p ON p.asset_id = d.asset_id AND p.data_date >= d.due GROUP BY d.asset_id, d.k),
    curve AS (
        SELECT p.asset_id, p.data_date, p.close_price * (1200.0::DOUBLE / s.first_price) AS lump_sum_value,
               sum(100.0::DOUBLE / b.price) * p.close_price AS dca_value, count(*) * 100.0::DOUBLE AS dca_cost
        FROM prices p JOIN starts s USING (asset_id)
        JOIN bought b ON b.asset_id = p.asset_id AND b.day <= p.data_date
        GROUP BY p.asset_id, p.data_date, p.close_price, s.first_price)"""

_VOL = """
    SELECT asset_id, stddev_samp(daily_return) * sqrt(252) * 100 AS v FROM returns GROUP BY asset_id"""

_TICKERS = """(
        SELECT *, unnest(['C:' || upper(event_type) || 'USD', lpad(CAST(user_id % 7 AS VARCHAR), 4, '0')]) AS ticker
        FROM events)"""

_DAILY_EVENTS = f"""
    SELECT ticker, CAST(ts AS DATE) AS data_date,
           arg_min(value + 1, event_id) AS open, max(value + 1) AS high, min(value + 1) AS low,
           arg_max(value + 1, event_id) AS close,
           CAST(count(*) AS DOUBLE) AS volume,
           'massive_forex_' || strftime(date_trunc('month', min(ts)), '%Y%m%d') || '_' || replace(ticker, ':', '_')
               AS __batch_id
    FROM {_TICKERS} GROUP BY ticker, CAST(ts AS DATE)"""

# One bar an event type and day, as responses of which some are cut short and some have no ticker.
_TYPE_DAYS = """
    SELECT event_type, CAST(ts AS DATE) AS d, arg_max(value + 1, event_id) AS close,
           day(CAST(ts AS DATE)) % 7 = 0 AS cut, day(CAST(ts AS DATE)) % 5 = 0 AS unnamed
    FROM events GROUP BY event_type, CAST(ts AS DATE)"""

_VERDICTS = f"""
    verdicts AS (
        SELECT event_type, 'whole' AS kind, count(*) AS n, max(close) AS worst, 0 AS lost FROM ({_TYPE_DAYS}) GROUP BY event_type
        UNION ALL
        SELECT event_type, 'cut', count(*) FILTER (NOT cut AND NOT unnamed), max(close) FILTER (NOT cut AND NOT unnamed),
               count(*) FILTER (cut)
        FROM ({_TYPE_DAYS}) GROUP BY event_type),
    judged AS (
        SELECT *, CASE WHEN worst <= {CLOSE_LIMIT} THEN 0 ELSE 1 END AS dear, CASE WHEN lost > 0 THEN 1 ELSE 0 END AS torn
        FROM verdicts)"""

ORACLE = {
    "stg_benchmark_series": _sql("series", f"""
        SELECT * REPLACE ({_day("data_date")}, strftime(data_timestamp, '%Y-%m-%d %H:%M:%S') AS data_timestamp)
        FROM series"""),
    "stg_bars": _sql("bars", f"SELECT * REPLACE ({_day('data_date')}) FROM bars"),
    "stg_rates": _sql("rates", f"SELECT * REPLACE ({_day('data_date')}) FROM rates"),
    "stg_holidays": _sql("holidays", f"SELECT * REPLACE ({_day('holiday_date')}) FROM holidays"),
    "unified_prices": _sql("prices", f"SELECT * REPLACE ({_day('data_date')}) FROM prices"),
    "dim_assets": _sql("prices", """
        SELECT *, row_number() OVER (ORDER BY CASE asset_type WHEN 'crypto' THEN 1 WHEN 'fiat' THEN 2 WHEN 'stock' THEN 3
                                              WHEN 'index' THEN 4 ELSE 5 END, asset_id) AS position
        FROM (SELECT asset_id, asset_name, asset_type FROM prices GROUP BY ALL)"""),
    "dim_dates": _sql("dates", f"""
        SELECT {_day("date")}, year(date) AS year, month(date) AS month, day(date) AS day,
               isodow(date) % 7 AS day_of_week, quarter(date) AS quarter, dayofyear(date) AS day_of_year,
               CAST(us AS BIGINT) AS is_trading_day, CAST(us AS BIGINT) AS is_us_trading_day,
               CAST(uk AS BIGINT) AS is_uk_trading_day, CAST(eu AS BIGINT) AS is_eu_trading_day,
               CAST(dayofyear(date) = 1 AS BIGINT) AS is_year_start, strftime(date, '%Y-%m') AS year_month,
               year(date) || '-Q' || quarter(date) AS year_quarter
        FROM dates"""),
    "daily_prices_locf": _sql("filled", f"SELECT * REPLACE ({_day('data_date')}) FROM filled"),
    "daily_prices_named": _sql("filled", f"SELECT * REPLACE ({_day('data_date')}) FROM filled"),
    "daily_returns": _sql("returns", f"""
        SELECT * EXCLUDE (n) REPLACE ({_day("data_date")}, coalesce(CAST(days_gap AS VARCHAR), 'none') AS days_gap)
        FROM returns"""),
    "fct_daily_returns": _sql("returns", f"""
        SELECT * EXCLUDE (n, prev_close_price, days_gap) REPLACE ({_day("data_date")}) FROM returns"""),
    "benchmark_relative": _sql("returns", """
        SELECT a.asset_id, a.asset_name, a.asset_type, CAST(a.data_date AS VARCHAR) AS data_date,
               a.daily_return AS asset_return, b.daily_return AS btc_daily_return,
               ifnull(a.daily_return, 0) - ifnull(b.daily_return, 0) AS return_vs_btc,
               CAST(ifnull(a.daily_return > b.daily_return, false) AS BIGINT) AS outperformed_btc_flag
        FROM returns a LEFT JOIN returns b ON b.asset_id = 'BTC' AND b.data_date = a.data_date
        WHERE a.asset_id <> 'BTC'"""),
    "rolling_metrics": _sql("returns", _rolling(f"{_FIRST} AS first_price,")),
    "fct_rolling_metrics": _sql("returns", _rolling("")),
    "data_gaps": _sql("gaps", f"""
        SELECT * REPLACE ({_day("missing_date")}, CAST(is_trading_day AS BIGINT) AS is_trading_day) FROM gaps"""),
    "critical_gaps": _sql("gaps", f"""
        SELECT asset_id, asset_type, {_day("missing_date")}, CAST(is_trading_day AS BIGINT) AS is_trading_day
        FROM (SELECT * FROM gaps WHERE asset_type = 'crypto' OR (asset_type IN ('stock', 'index') AND is_trading_day = 1)
              ORDER BY asset_id, missing_date LIMIT 100)"""),
    "performance_summary": _sql("filled", ",\n" + _PERIODS.format(
        m3=90, m6=180, end="SELECT max(data_date) FROM filled") + """,
        starts AS (
            SELECT f.asset_id, f.asset_name, f.asset_type, p.period,
                   arg_min(f.close_price, f.data_date) AS start_price, arg_max(f.close_price, f.data_date) AS current_price
            FROM filled f JOIN periods p ON f.data_date >= p.start_day GROUP BY ALL),
        rated AS (SELECT *, current_price / start_price - 1 AS return_pct FROM starts WHERE start_price > 0),
        report AS (
        SELECT r.*, b.return_pct AS btc_return_pct, r.return_pct - b.return_pct AS return_vs_btc,
               CASE WHEN r.return_pct > b.return_pct THEN 'Outperformed' WHEN r.return_pct = b.return_pct THEN 'Matched'
                    ELSE 'Underperformed' END AS vs_btc_status,
               1 + (SELECT count(*) FROM rated o WHERE o.period = r.period AND o.return_pct > r.return_pct)
                   AS rank_by_return
        FROM rated r LEFT JOIN rated b ON b.asset_id = 'BTC' AND b.period = r.period)
        SELECT *, row_number() OVER (ORDER BY list_position(['7D', '1M', '3M', '6M', 'YTD', '1Y'], period),
                                              rank_by_return, asset_id) AS position
        FROM report"""),
    "investment_comparison": _sql("filled", _INVEST),
    "investment_benchmark_and_cash": "SELECT *, row_number() OVER (ORDER BY asset = 'BTC', strategy = 'DCA') AS position FROM ("
        + _sql("filled", _INVEST + """
        WHERE asset_id = 'BTC' OR (asset_id = 'USD' AND strategy = 'Lump Sum')""") + ")",
    "rank_extremes": """
        WITH v AS (
            SELECT o_orderkey, o_orderpriority,
                   CASE o_orderkey % 50 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE
                        WHEN 3 THEN NULL ELSE round(o_totalprice, -3) END AS v
            FROM orders)
        SELECT o_orderkey, o_orderpriority,
               rank() OVER (PARTITION BY o_orderpriority ORDER BY v DESC NULLS LAST) AS rank_in_class,
               rank() OVER (ORDER BY v DESC NULLS LAST) AS rank_overall
        FROM v""",
    "volatility_comparison": _sql("returns", """,
        stats AS (
            SELECT asset_id, asset_name, asset_type, count(*) AS num_observations, avg(daily_return) AS m,
                   stddev_samp(daily_return) AS s, min(daily_return) AS lo, max(daily_return) AS hi
            FROM returns WHERE daily_return IS NOT NULL GROUP BY ALL)
        SELECT *, row_number() OVER (ORDER BY volatility_rank, asset_id) AS position FROM (
        SELECT asset_id, asset_name, asset_type,
               CASE asset_type WHEN 'fiat' THEN 'Fiat Currencies' WHEN 'crypto' THEN 'Cryptocurrency'
                    WHEN 'stock' THEN 'Stocks' WHEN 'index' THEN 'Market Index' ELSE 'Other' END AS category,
               num_observations, round(m * 100, 4) + 0.0 AS avg_daily_return_pct,
               round(s * 100, 4) + 0.0 AS daily_volatility_pct,
               round(s * sqrt(252) * 100, 2) + 0.0 AS annualized_volatility_pct,
               round(lo * 100, 2) + 0.0 AS min_daily_return_pct, round(hi * 100, 2) + 0.0 AS max_daily_return_pct,
               1 + (SELECT count(*) FROM stats o WHERE o.s > stats.s OR (stats.s IS NULL AND o.s IS NOT NULL))
                   AS volatility_rank
        FROM stats)"""),
    "return_correlation": _sql("returns", """
        SELECT asset_a, asset_a_name, asset_b, asset_b_name, round(c, 8) + 0.0 AS correlation, observation_count,
               row_number() OVER (ORDER BY asset_a, round(c, 8) DESC, asset_b) AS position
        FROM (SELECT a.asset_id AS asset_a, a.asset_name AS asset_a_name, b.asset_id AS asset_b,
                     b.asset_name AS asset_b_name, corr(a.daily_return, b.daily_return) AS c,
                     count(*) AS observation_count
              FROM returns a JOIN returns b ON a.data_date = b.data_date
              WHERE a.daily_return IS NOT NULL AND b.daily_return IS NOT NULL GROUP BY ALL)
        WHERE c IS NOT NULL AND NOT isnan(c)"""),
    "holiday_overlaps": _sql("rates holidays", f"""
        SELECT asset_id, {_day("data_date")}, holiday_name, market_code, close_price
        FROM rates JOIN holidays ON data_date = holiday_date
        WHERE (asset_id, market_code) IN (('GBP', 'UK'), ('EUR', 'EU'))"""),
    "weekday_closures": _sql("holidays", f"""
        SELECT {_day("holiday_date")}, holiday_name, market_code, dayname(holiday_date) AS day_of_week
        FROM holidays WHERE market_status = 'closed' AND isodow(holiday_date) < 6"""),
    "window_returns_observed": _sql("prices", ",\n" + _PERIODS.format(
        m3=91, m6=182, end="SELECT min(l) FROM (SELECT max(data_date) AS l FROM prices GROUP BY asset_id)") + """,
        ending AS (
            SELECT asset_id, arg_max(close_price, data_date) AS p FROM prices
            WHERE data_date <= (SELECT min(l) FROM (SELECT max(data_date) AS l FROM prices GROUP BY asset_id))
            GROUP BY asset_id)
        SELECT v.period, p.asset_id AS asset,
               (any_value(e.p) / arg_min(p.close_price, p.data_date) - 1) * 100 AS return_pct
        FROM prices p JOIN periods v ON p.data_date >= v.start_day JOIN ending e ON e.asset_id = p.asset_id
        GROUP BY v.period, p.asset_id"""),
    "holding_value_curve": _sql("prices numbered", f"SELECT * REPLACE ({_day('data_date')}) FROM ({_HOLDING})"),
    "holding_value_summary": _sql("prices numbered", f""", curve AS ({_HOLDING}),
        best AS (SELECT asset_id, max(investment_value) AS hi, min(investment_value) AS lo,
                        arg_max(investment_value, data_date) AS fin FROM curve GROUP BY asset_id)
        SELECT asset_id, fin AS final_value, hi AS max_value, lo AS min_value,
               (SELECT CAST(min(data_date) AS VARCHAR) FROM curve c WHERE c.asset_id = best.asset_id
                AND c.investment_value = hi) AS max_date,
               (SELECT CAST(min(data_date) AS VARCHAR) FROM curve c WHERE c.asset_id = best.asset_id
                AND c.investment_value = lo) AS min_date,
               (fin - 1000) / 1000 * 100 AS return_pct
        FROM best"""),
    "dca_value_curve": _sql("prices numbered", _DCA + f"""
        SELECT asset_id, {_day("data_date")}, lump_sum_value, {_r("dca_value", 6, "dca_value")}, dca_cost FROM curve"""),
    "dca_value_summary": _sql("prices numbered", _DCA + f""",
        fin AS (SELECT asset_id, arg_max(lump_sum_value, data_date) AS l, arg_max(dca_value, data_date) AS d
                FROM curve GROUP BY asset_id)
        SELECT asset_id, l AS final_lump, {_r("d", 6, "final_dca")}, (l - 1200) / 1200 * 100 AS lump_return,
               {_r("(d - 1200) / 1200 * 100", 6, "dca_return")}, CASE WHEN d > l THEN 'DCA' ELSE 'Lump Sum' END AS winner,
               {_r("abs((d - 1200) / 1200 * 100 - (l - 1200) / 1200 * 100)", 6, "margin")}
        FROM fin"""),
    "annualised_volatility": _sql("returns", f"""
        SELECT asset_id, {_r("v", 8, "annualized_volatility_pct")} FROM ({_VOL})"""),
    "volatility_ratio": _sql("returns", f"""
        SELECT {_r("b", 8, "benchmark_volatility")}, {_r("f", 8, "compared_mean")}, {_r("b / f", 8, "ratio")}
        FROM (SELECT max(v) FILTER (asset_id = 'BTC') AS b, avg(v) FILTER (asset_id IN ('EUR', 'GBP')) AS f
              FROM ({_VOL}))"""),
    "flattened_series": """
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + CAST(k AS INTEGER) AS VARCHAR) AS data_date,
               epoch_ms(CAST(CAST(o_orderdate AS DATE) + CAST(k AS INTEGER) AS TIMESTAMP)) AS data_timestamp,
               o_totalprice + k AS price_usd, CASE WHEN k < 2 THEN o_totalprice * 1000 END AS market_cap_usd,
               CAST(o_custkey AS DOUBLE) + k AS volume_24h_usd,
               'coingecko_market_chart_' || strftime(o_orderdate, '%Y%m%d') AS __batch_id,
               'coingecko' AS __source_name, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS __ingested_at,
               '{version}' AS __schema_version
        FROM orders, range(3) AS t(k)""",
    "projected_paths": """
        SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(7 AS BIGINT) AS second,
               CAST(NULL AS DOUBLE) AS beyond, '[' || user_id || ',' || event_id || ']' AS firsts,
               '[[' || user_id || ',7],[' || event_id || ']]' AS nested, CAST(NULL AS DOUBLE) AS missing_key,
               CAST(0 AS BIGINT) AS n_missing
        FROM events""",
    "converted_dates": """
        SELECT o_orderkey,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS from_text,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS from_ms
        FROM orders""",
    "batch_keys": _sql("raw_rates", f"""
        SELECT 'massive_forex_' || {_YMD.format("data_date")} || '_' || replace(ticker, ':', '_') AS __batch_id,
               count(*) AS n_bars FROM raw_rates GROUP BY ALL"""),
    "routed_records": """
        SELECT CASE WHEN l_returnflag <> 'A' AND l_linestatus = 'F' THEN 'kept' ELSE 'rejected' END AS route,
               CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END AS ticker, count(*) AS n_rows,
               count(*) FILTER (l_linestatus = 'F') AS n_dated
        FROM lineitem GROUP BY ALL""",
    "load_plan": _sql("points", """
        SELECT c.coin AS ticker, CAST(CAST(day AS DATE) AS VARCHAR) AS data_date
        FROM (SELECT DISTINCT coin FROM points) c,
             (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS day FROM lineitem) s
        WHERE NOT EXISTS (SELECT 1 FROM points p WHERE p.coin = c.coin AND p.data_date = CAST(s.day AS DATE))"""),
    "landing_round_trip": f"""
        SELECT 'massive' AS source, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS ingestion_date,
               'massive_forex_' || strftime(date_trunc('month', ts), '%Y%m%d') || '_' || replace(ticker, ':', '_')
                   AS batch_id,
               ticker, count(DISTINCT CAST(ts AS DATE)) AS n_bars
        FROM {_TICKERS} GROUP BY ALL""",
    "landing_ids": """
        SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, lpad(CAST(user_id % 9 AS VARCHAR), 5, '0') AS batch_id,
               event_id + 9007199254740992 AS id
        FROM events""",
    "published_bronze": f"""
        SELECT ticker, {_day("data_date")}, open, high, low, close, volume, __batch_id, 'massive' AS __source_name,
               strftime(date_trunc('month', data_date), '%Y-%m-%d') || ' 00:00:00' AS __ingested_at,
               '{{rates_version}}' AS __schema_version
        FROM ({_DAILY_EVENTS})""",
    "published_dates": f"SELECT ticker, {_day('data_date')} FROM ({_DAILY_EVENTS})",
    "ingest_outcomes": f"""
        SELECT event_type AS source, count(*) FILTER (NOT cut AND NOT unnamed) AS published,
               count(*) FILTER (NOT cut AND NOT unnamed) AS in_table, count(*) FILTER (NOT cut AND unnamed) AS rejected,
               count(*) FILTER (NOT cut AND unnamed) AS rejects_kept, count(*) FILTER (cut) AS unreadable,
               count(*) FILTER (cut) AS unreadable_kept
        FROM ({_TYPE_DAYS}) GROUP BY event_type""",
    "gate_verdicts": f"""
        WITH {_VERDICTS}
        SELECT event_type || '_' || kind AS batch_id, event_type AS resource, dear + torn = 0 AS is_valid,
               CAST(12 - dear - torn AS BIGINT) AS checks_passed, CAST(dear + torn AS BIGINT) AS checks_failed,
               concat_ws('; ',
                   CASE WHEN dear = 1 THEN 'close <= {CLOSE_LIMIT}: fail: value ' || CAST(worst AS VARCHAR) || ' violates <= {CLOSE_LIMIT}' END,
                   CASE WHEN torn = 1 THEN 'unreadable_responses <= 0: fail: value ' || lost || ' violates <= 0' END) AS failed_checks,
               CASE WHEN dear + torn = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
        FROM judged""",
    "ingested_pass_rate": f"""
        WITH {_VERDICTS}
        SELECT 'events' AS source, event_type AS resource, count(*) AS total_runs,
               count(*) FILTER (dear + torn = 0) AS passed, count(*) FILTER (dear + torn > 0) AS failed,
               round(100.0::DOUBLE * count(*) FILTER (dear + torn = 0) / count(*), 1) AS pass_rate_pct
        FROM judged GROUP BY event_type""",
    "empty_batch_policy": """
        SELECT event_type, strict AS fail_on_empty, NOT strict AS is_valid, CAST(0 AS BIGINT) AS checks_passed,
               CAST(strict AS BIGINT) AS checks_failed,
               CASE WHEN strict THEN 'fail_on_empty_data: fail: the batch holds no rows' ELSE '' END AS failed_checks
        FROM (SELECT DISTINCT event_type FROM events), (VALUES (false), (true)) AS p(strict)""",
    "materialised_rates": _sql("rates", f"SELECT * REPLACE ({_day('data_date')}) FROM rates"),
    "selected_assets": """
        SELECT p_partkey AS ticker, p_name AS name, lower(p_type) AS asset_type
        FROM part WHERE p_size > 25 AND string_split(p_name, ' ')[1] = 'red'""",
    "audit_report_bars": """
        WITH t AS (SELECT l_returnflag AS ticker, CAST(l_shipdate AS DATE) AS d, l_quantity AS low,
                          l_extendedprice AS high, l_discount AS disc, l_tax AS tax FROM lineitem),
        m(name, rule, metric, held) AS (
            SELECT 'row_count > 0', '> 0', count(*), count(*) > 0 FROM t
            UNION ALL SELECT 'missing_count(data_date) = 0', '= 0', count(*), count(*) = 0 FROM t WHERE d IS NULL
            UNION ALL SELECT 'missing_count(tax) = 0', '= 0', count(*), count(*) = 0 FROM t WHERE NOT tax > 0 OR tax IS NULL
            UNION ALL SELECT 'low > 0', '> 0', min(low), bool_and(low > 0) FROM t
            UNION ALL SELECT 'discount > 0', '> 0', min(disc), bool_and(disc > 0) FROM t
            UNION ALL SELECT 'discount < 0.5', '< 0.5', max(disc), bool_and(disc < 0.5) FROM t
            UNION ALL SELECT 'low <= 10', '<= 10', max(low), bool_and(low <= 10) FROM t
            UNION ALL SELECT 'high_lt_low = 0', '= 0', count(*), count(*) = 0 FROM t WHERE high < low
            UNION ALL SELECT 'no_duplicate_dates = 0', '= 0', count(*), count(*) = 0
                      FROM (SELECT 1 FROM t GROUP BY ticker, d HAVING count(*) > 1)
            UNION ALL SELECT 'days > 10', '> 10', count(DISTINCT d), count(DISTINCT d) > 10 FROM t)
        SELECT name, CAST(metric AS DOUBLE) AS metric, CASE WHEN held THEN 'pass' ELSE 'fail' END AS outcome,
               CASE WHEN held THEN '' ELSE 'value ' || CAST(CAST(metric AS DOUBLE) AS VARCHAR) || ' violates ' || rule END
                   AS diagnostic
        FROM m""",
    "audit_summary_series": """
        WITH n AS (
            SELECT count(*) AS a, count(o_orderdate) AS d, count(o_totalprice) AS p, count(o_custkey) AS c,
                   min(o_totalprice) AS lp, min(o_custkey) AS lc FROM orders),
        m(name, rule, metric, held) AS (
            SELECT unnest([
                {'n': 'row_count > 0', 'r': '> 0', 'm': a::DOUBLE, 'h': a > 0},
                {'n': 'missing_count(data_timestamp) = 0', 'r': '= 0', 'm': (a - d)::DOUBLE, 'h': a = d},
                {'n': 'missing_count(data_date) = 0', 'r': '= 0', 'm': (a - d)::DOUBLE, 'h': a = d},
                {'n': 'missing_count(price_usd) = 0', 'r': '= 0', 'm': (a - p)::DOUBLE, 'h': a = p},
                {'n': 'missing_count(market_cap_usd) = 0', 'r': '= 0', 'm': (a - p)::DOUBLE, 'h': a = p},
                {'n': 'missing_count(volume_24h_usd) = 0', 'r': '= 0', 'm': (a - c)::DOUBLE, 'h': a = c},
                {'n': 'price_usd > 0', 'r': '> 0', 'm': lp::DOUBLE, 'h': lp > 0},
                {'n': 'market_cap_usd > 0', 'r': '> 0', 'm': (lp * 1000)::DOUBLE, 'h': lp > 0},
                {'n': 'volume_24h_usd > 0', 'r': '> 0', 'm': lc::DOUBLE, 'h': lc > 0}], recursive := true)
            FROM n)
        SELECT count(*) FILTER (NOT held) = 0 AS is_valid, count(*) FILTER (held) AS checks_passed,
               count(*) FILTER (NOT held) AS checks_failed,
               coalesce(string_agg(name || ': fail: value ' || CAST(metric AS VARCHAR) || ' violates ' || rule, '; ' ORDER BY name)
                        FILTER (NOT held), '') AS failed_checks
        FROM m""",
    "duplicate_observations": _sql("points", f"""
        SELECT coin, {_day("data_date")}, count(*) AS n_rows FROM points GROUP BY coin, points.data_date HAVING count(*) > 1"""),
    "null_violations": _sql("numbered", f"SELECT asset_id, {_day('data_date')}, close_price FROM numbered WHERE n = 1"),
    "unique_violations": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_rows
        FROM lineitem GROUP BY l_orderkey, lineitem.l_linenumber HAVING count(*) > 1""",
    "accepted_value_violations": _sql("prices", """
        SELECT asset_type, count(*) AS n_rows FROM prices WHERE asset_type = 'unknown' GROUP BY asset_type"""),
    "relationship_violations": """
        SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)""",
    "source_freshness": _sql("points", """
        SELECT coin, strftime(CAST(max(data_date) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
               epoch(TIMESTAMP '2001-08-04 12:00:00')::BIGINT - epoch(CAST(max(data_date) AS TIMESTAMP))::BIGINT
                   AS age_seconds,
               CASE WHEN max(data_date) < TIMESTAMP '2001-08-01 12:00:00' THEN 'error'
                    WHEN max(data_date) < TIMESTAMP '2001-08-02 12:00:00' THEN 'warn' ELSE 'pass' END AS status
        FROM points GROUP BY coin"""),
    "quality_pass_rate": _sql("audits", """
        SELECT 'events' AS source, event_type AS resource, count(*) AS total_runs, count(*) FILTER (ok) AS passed,
               count(*) FILTER (NOT ok) AS failed, round(100.0::DOUBLE * count(*) FILTER (ok) / count(*), 1) AS pass_rate_pct,
               strftime(max(t1), '%Y-%m-%d %H:%M:%S') AS last_run
        FROM audits GROUP BY event_type"""),
    "recent_failures": _sql("audits", f"""
        SELECT 'events_' || event_type || '_' || {_YMD.format("day")} AS batch_id, 'events' AS source,
               event_type AS resource, 'value_bound: fail: max ' || CAST(worst AS VARCHAR) AS failed_checks
        FROM (SELECT * FROM audits WHERE NOT ok ORDER BY t1 DESC LIMIT 5)"""),
    "ledger_upsert": _sql("audits", f"""
        SELECT 'events_' || event_type || '_' || {_YMD.format("day")} AS batch_id, 'events' AS source,
               event_type AS resource, fine AS is_valid, CAST(1 + fine::INT AS BIGINT) AS checks_passed,
               CAST(1 - fine::INT AS BIGINT) AS checks_failed,
               strftime(CASE WHEN day >= DATE '2024-01-16' THEN t1 + INTERVAL 1 DAY ELSE t1 END, '%Y-%m-%d %H:%M:%S')
                   AS created_at,
               strftime(day, '%Y-%m-%d 00:00:00') AS data_interval_start,
               strftime(day + 1, '%Y-%m-%d 00:00:00') AS data_interval_end,
               CASE WHEN fine THEN '' ELSE 'value_bound: fail: max ' || CAST(worst AS VARCHAR) END AS failed_checks
        FROM (SELECT *, CASE WHEN day >= DATE '2024-01-16' THEN worst <= 100 ELSE ok END AS fine FROM audits)"""),
    "run_state": _sql("audits", f"""
        SELECT 'run_' || event_type || '_' || {_YMD.format("day")} AS run_id,
               CASE WHEN worst > 300 THEN 'RUNNING' WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END AS status,
               strftime(t0, '%Y-%m-%d %H:%M:%S') AS start_time,
               CASE WHEN worst <= 300 THEN strftime(t1, '%Y-%m-%d %H:%M:%S') END AS end_time,
               'events_' || event_type || '_' || {_YMD.format("day")} AS batch_id, 'events' AS source,
               event_type AS resource
        FROM audits"""),
    "step_state": _sql("audits", f"""
        SELECT 'run_' || event_type || '_' || {_YMD.format("day")} AS run_id, step AS step_name,
               CASE WHEN step = 'extract' THEN 'SUCCESS' WHEN worst > 300 THEN 'RUNNING' WHEN ok THEN 'SUCCESS'
                    ELSE 'FAILED' END AS status,
               strftime(CASE step WHEN 'extract' THEN t0 ELSE t1 END, '%Y-%m-%d %H:%M:%S') AS start_time,
               CASE WHEN step = 'extract' OR worst <= 300 THEN strftime(t1, '%Y-%m-%d %H:%M:%S') END AS end_time,
               '' AS metadata
        FROM audits, (VALUES ('extract'), ('validate')) AS s(step)"""),
    "lineage_trace": _sql("rates", f"""
        SELECT asset_id, {_day("data_date")}, close_price, __batch_id, 'second-' || __batch_id AS run_id,
               CASE WHEN volume > 100 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
               CAST(rates.data_date + 2 AS VARCHAR) AS start_time
        FROM rates"""),
    "landing_lineage": f"""
        SELECT ticker, {_day("data_date")}, __batch_id, 'SUCCESS' AS status,
               substr(CAST(data_date AS VARCHAR), 1, 8) || '01' AS ingestion_date, __batch_id AS landing_file
        FROM ({_DAILY_EVENTS})""",
    "swap_amounts": """
        SELECT event_id, CAST(round(value * 1000000) AS DOUBLE) / 1e6 AS amount0_in,
               CAST(user_id || '000000000000007' AS DOUBLE) / 1e18 AS amount1_in,
               CAST(event_id AS DOUBLE) / 1e6 AS amount0_out,
               CAST(event_id || repeat('0', 60) AS DOUBLE) / 1e18 AS amount1_out, event_type,
               user_id AS taker, user_id % 100 AS tx_from
        FROM events""",
    "unique_takers": """
        SELECT event_type, count(DISTINCT user_id) AS unique_takers_direct,
               count(DISTINCT user_id % 100) AS unique_users_tx_from
        FROM events GROUP BY event_type""",
}


def _versions() -> None:
    """Schema fingerprints, spelled out here from their definition."""
    import hashlib
    import json

    def fingerprint(fields: dict[str, tuple[str | None, bool]]) -> str:
        shape = {n: {"partition_key": k, "type": t} for n, (t, k) in sorted(fields.items())}
        return hashlib.md5(json.dumps(shape).encode()).hexdigest()[:8]

    series = fingerprint({
        "data_timestamp": ("timestamp_ms_to_datetime", False), "data_date": ("timestamp_ms_to_date", True),
        "price_usd": (None, False), "market_cap_usd": (None, False), "volume_24h_usd": (None, False)})
    rates = fingerprint({
        "ticker": ("string", True), "data_date": ("timestamp_ms_to_date", True),
        **{n: (None, False) for n in ("open", "high", "low", "close", "volume")}})
    ORACLE["flattened_series"] = ORACLE["flattened_series"].replace("{version}", series)
    ORACLE["published_bronze"] = ORACLE["published_bronze"].replace("{rates_version}", rates)


_versions()
