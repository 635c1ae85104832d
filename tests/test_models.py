"""Models on hand-computed tables, and invariants."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from bourse import fixed_values as fv
from bourse.operators.ranking import _ranged, rank_descending
from bourse.plans import core, figures, market, reports, staging, swaps
from bourse.plans.build import LAYERS, PUBLISHED_NAMES, build_models, data_tests
from bourse.sources import reference_data

D = dt.date


@pytest.fixture(scope="module")
def holidays(spark):
    return reference_data.builtin_holidays(spark)


def test_latest_point_decides_before_the_price_filter(spark, rows):
    raw = spark.createDataFrame(
        [("2026-01-01", "2026-01-01 01:00:00", 5.0, "a"), ("2026-01-01", "2026-01-01 02:00:00", 6.0, "a"),
         ("2026-01-02", "2026-01-02 01:00:00", 7.0, "a"), ("2026-01-02", "2026-01-02 02:00:00", 0.0, "a"),
         ("2026-01-03", "2026-01-03 00:00:00", 8.0, "a"), ("2026-01-03", "2026-01-03 00:00:00", 9.0, "b"),
         (None, "2026-01-03 00:00:00", 9.0, "b"), ("2026-01-04", "2026-01-04 00:00:00", None, "a")],
        "d string, t string, price_usd double, __ingested_at string").select(
        F.col("d").cast("date").alias("data_date"), F.col("t").cast("timestamp").alias("data_timestamp"), "price_usd",
        F.lit(1.0).alias("market_cap_usd"), F.lit(2.0).alias("volume_24h_usd"), "__ingested_at")
    out = staging.benchmark_series(raw)
    assert rows(out, "asset_id", "data_date", "close_price") == [
        ("BTC", D(2026, 1, 1), 6.0), ("BTC", D(2026, 1, 3), 9.0)]


def raw_bars(spark, entries):
    return spark.createDataFrame(entries, "ticker string, close double").select(
        "ticker", F.lit("2026-01-01").cast("date").alias("data_date"), "close",
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "volume", "vwap")],
        F.lit("b").alias("__batch_id"), F.lit("t").alias("__ingested_at"))


def test_stock_and_rate_names(spark, rows):
    stocks = staging.stock_bars(raw_bars(spark, [("AAPL", 1.0), ("SPY", 2.0), ("XYZ", 3.0), ("MSFT", 0.0), (None, 1.0)]))
    assert rows(stocks, "asset_id", "asset_name", "asset_type") == [
        ("AAPL", "Apple Inc.", "stock"), ("SPY", "S&P 500 ETF", "index"), ("XYZ", "XYZ", "unknown")]
    rates = staging.rate_bars(raw_bars(spark, [("C:EURUSD", 1.0), ("C:CHFUSD", 2.0), ("C:GBPUSD", -1.0)]))
    assert rows(rates, "asset_id", "asset_name", "raw_ticker", "asset_type") == [
        ("CHF", "C:CHFUSD", "C:CHFUSD", "fiat"), ("EUR", "Euro", "C:EURUSD", "fiat")]


def test_cash_follows_the_benchmark_days(priced, spark, rows):
    series = priced([("BTC", "crypto", "2026-01-01", 5.0), ("BTC", "crypto", "2026-01-02", 6.0),
                     ("ETH", "crypto", "2026-01-03", 7.0)])
    out = core.unified_prices(series, cash_ingested_at=F.lit("t"))
    assert list(out.columns) == list(core.PRICE_COLUMNS)
    assert rows(out.filter("asset_id = 'USD'"), "data_date", "close_price", "volume", "__batch_id") == [
        (D(2026, 1, 1), 1.0, 0.0, "synthetic"), (D(2026, 1, 2), 1.0, 0.0, "synthetic")]
    assert out.count() == 5


def test_dim_dates(priced, holidays):
    days = ["2026-01-01", "2026-01-03", "2026-04-06", "2026-12-24", "2026-07-03"]
    out = core.dim_dates(priced([("A", "stock", d, 1.0) for d in days]), holidays)
    got = {str(r.date): r for r in out.collect()}
    assert len(got) == 5
    new_year = got["2026-01-01"]
    assert (new_year.is_us_trading_day, new_year.is_uk_trading_day, new_year.is_eu_trading_day) == (0, 0, 0)
    assert (new_year.day_of_week, new_year.is_year_start, new_year.year_month, new_year.year_quarter) == (
        4, 1, "2026-01", "2026-Q1")
    assert got["2026-01-03"].day_of_week == 6 and got["2026-01-03"].is_trading_day == 0
    easter = got["2026-04-06"]
    assert (easter.is_us_trading_day, easter.is_uk_trading_day, easter.is_eu_trading_day) == (1, 0, 0)
    assert got["2026-12-24"].is_trading_day == 1, "an early close is a trading day"
    assert got["2026-07-03"].is_trading_day == 0 and got["2026-07-03"].is_uk_trading_day == 1


def test_dim_assets_order(priced):
    prices = priced([("Z", "crypto", "2026-01-01", 1.0), ("A", "index", "2026-01-01", 1.0),
                     ("M", "stock", "2026-01-01", 1.0), ("B", "fiat", "2026-01-01", 1.0), ("U", "unknown", "2026-01-01", 1.0),
                     ("B", "fiat", "2026-01-02", 1.0)])
    assert [r.asset_id for r in core.sorted_assets(core.dim_assets(prices)).collect()] == ["Z", "B", "M", "A", "U"]


def test_forward_fill(priced, holidays, rows):
    prices = priced([("A", "stock", "2026-01-05", 1.0), ("A", "stock", "2026-01-07", 3.0),
                     ("B", "stock", "2026-01-06", 2.0), ("B", "stock", "2026-01-08", None)])
    dates = core.dim_dates(prices, holidays)
    out = core.daily_prices(prices, dates, core.dim_assets(prices))
    assert rows(out, "asset_id", F.day("data_date"), "close_price", "price_source", "__batch_id") == [
        ("A", 5, 1.0, "OBSERVED", "b2026-01-05"), ("A", 6, 1.0, "IMPUTED", "b2026-01-05"),
        ("A", 7, 3.0, "OBSERVED", "b2026-01-07"), ("A", 8, 3.0, "IMPUTED", "b2026-01-07"),
        ("B", 6, 2.0, "OBSERVED", "b2026-01-06"), ("B", 7, 2.0, "IMPUTED", "b2026-01-06"),
        # The row without a price keeps its own batch and takes the carried price.
        ("B", 8, 2.0, "IMPUTED", "b2026-01-08")]


def test_forward_fill_is_idempotent(priced, holidays, rows):
    prices = priced([("A", "stock", "2026-01-05", 1.0), ("A", "stock", "2026-01-09", 3.0), ("B", "stock", "2026-01-07", 2.0)])
    dates = core.dim_dates(prices, holidays)
    once = core.daily_prices(prices, dates)
    twice = core.daily_prices(once.drop("price_source"), dates)
    assert rows(once, "asset_id", "data_date", "close_price") == rows(twice, "asset_id", "data_date", "close_price")


def test_fill_equals_calendar_product(priced, holidays, rows):
    """Against the plain product of assets and days, on random gaps."""
    rng = random.Random(7)
    start = D(2026, 1, 1)
    entries = [(a, "stock", str(start + dt.timedelta(days=i)), rng.random() + 1)
               for a in "ABCD" for i in range(40) if rng.random() < 0.3]
    prices = priced(entries)
    days = sorted({e[2] for e in entries})
    expected = []
    for asset in "ABCD":
        own = {d: p for a, _, d, p in entries if a == asset}
        last = None
        for day in days:
            last = own.get(day, last)
            if last is not None:
                expected.append((asset, day, last, "OBSERVED" if day in own else "IMPUTED"))
    out = core.daily_prices(prices, core.dim_dates(prices, holidays))
    assert rows(out, "asset_id", F.col("data_date").cast("string"), "close_price", "price_source") == sorted(expected, key=repr)


def test_daily_returns(priced, rows):
    prices = priced([("A", "stock", "2026-01-02", 10.0), ("A", "stock", "2026-01-05", 11.0), ("A", "stock", "2026-01-06", 0.0),
                     ("A", "stock", "2026-01-07", 5.0)])
    got = market.daily_returns(prices).orderBy("data_date").collect()
    assert [r.days_gap for r in got] == [None, 3, 1, 1]
    assert [r.daily_return for r in got] == [None, pytest.approx(0.1), -1.0, None]


def test_benchmark_relative(priced, rows):
    prices = priced([("BTC", "crypto", "2026-01-01", 1.0), ("BTC", "crypto", "2026-01-02", 2.0),
                     ("A", "stock", "2026-01-01", 1.0), ("A", "stock", "2026-01-02", 4.0), ("A", "stock", "2026-01-03", 2.0)])
    out = market.benchmark_relative(market.daily_returns(prices))
    assert rows(out, F.day("data_date"), "asset_return", "btc_daily_return", "return_vs_btc", "outperformed_btc_flag") == [
        (1, None, None, 0.0, 0), (2, 3.0, 1.0, 2.0, 1), (3, -0.5, None, -0.5, 0)]


def test_rolling_metrics_count_rows_not_days(priced):
    start = D(2026, 1, 1)
    closes = [10.0 + (i * 7) % 5 for i in range(40)]
    prices = priced([("A", "stock", str(start + dt.timedelta(days=3 * i)), p) for i, p in enumerate(closes)])
    got = market.rolling_metrics(market.daily_returns(prices)).orderBy("data_date").collect()
    returns = [None] + [(b - a) / a for a, b in zip(closes, closes[1:])]
    for n in (7, 14, 30):
        for i, row in enumerate(got):
            window = [r for r in returns[max(0, i - n + 1):i + 1] if r is not None]
            assert row[f"obs_count_{n}d"] == len(window)
            assert row[f"avg_return_{n}d"] == (pytest.approx(statistics.mean(window)) if window else None)
            assert row[f"volatility_{n}d"] == (pytest.approx(statistics.stdev(window)) if len(window) > 1 else None)
    assert got[-1].first_price == 10.0 and got[-1].cumulative_return_from_start == pytest.approx(closes[-1] / 10.0 - 1)
    assert "first_price" not in market.fct_rolling_metrics(market.rolling_metrics(market.daily_returns(prices))).columns


def test_gaps(priced, holidays, rows):
    # Thursday 1 (holiday), Friday 2, weekend, Monday 5, Tuesday 6.
    days = ["2026-01-01", "2026-01-02", "2026-01-03", "2026-01-05", "2026-01-06"]
    prices = priced([("BTC", "crypto", d, 1.0) for d in days] +
                    [("ETH", "crypto", d, 1.0) for d in (days[0], days[4])] +
                    [("A", "stock", d, 1.0) for d in (days[0], days[4])] +
                    [("EUR", "fiat", d, 1.0) for d in (days[2], days[4])] +
                    [("FX-GBP", "forex", d, 1.0) for d in (days[1], days[4])])
    gaps = market.data_gaps(prices, core.dim_dates(prices, holidays))
    assert rows(gaps, "asset_id", F.day("missing_date"), "is_trading_day") == [
        ("A", 2, 1), ("A", 5, 1), ("ETH", 2, 1), ("ETH", 3, 0), ("ETH", 5, 1), ("EUR", 5, 1), ("FX-GBP", 5, 1)]
    assert [(r.asset_id, r.missing_date.day) for r in market.critical_gaps(gaps).collect()] == [
        ("A", 2), ("A", 5), ("ETH", 2), ("ETH", 3), ("ETH", 5), ("FX-GBP", 5)]
    assert market.critical_gaps(gaps, show=1).count() == 1


def yearly(asset, kind, step=1, late=0, n=400, end=D(2026, 1, 31)):
    days = [end - dt.timedelta(days=i) for i in range(0, n, step)]
    return [(asset, kind, str(d), 100.0 + (d.toordinal() * 13 + late) % 37) for d in days if (end - d).days >= late]


@pytest.fixture(scope="module")
def market_year(spark):
    return (yearly("BTC", "crypto") + yearly("A", "stock", step=3) + yearly("B", "stock", step=5, late=2)
            + yearly("NEW", "stock", n=20) + [(a, k, d, 1.0) for a, k, d, _ in yearly("USD", "fiat")])


def test_performance_on_observed_prices_equals_filled(priced, market_year, holidays, rows):
    prices = priced(market_year)
    filled = core.daily_prices(prices, core.dim_dates(prices, holidays))
    columns = ["asset_id", "period", "start_price", "current_price", "return_pct", "return_vs_btc", "vs_btc_status",
               "rank_by_return"]
    direct = rows(reports.performance_summary(prices), *columns)
    assert direct == rows(reports.performance_summary(filled), *columns)
    assert len(direct) == 5 * 6


def test_performance_values(priced):
    prices = priced([("BTC", "crypto", "2025-12-31", 50.0), ("BTC", "crypto", "2026-01-10", 100.0),
                     ("A", "stock", "2026-01-01", 10.0), ("A", "stock", "2026-01-04", 40.0),
                     ("L", "stock", "2026-01-09", 3.0), ("L", "stock", "2026-01-10", 3.0)])
    got = {(r.asset_id, r.period): r for r in reports.performance_summary(prices).collect()}
    # The first calendar day at or after 2026-01-03 is the 4th; BTC still shows 50 there.
    assert got["BTC", "7D"].start_price == 50.0 and got["A", "7D"].start_price == 40.0
    assert got["A", "YTD"].start_price == 10.0 and got["A", "YTD"].return_pct == 3.0
    assert got["L", "7D"].start_price == 3.0, "a late series starts at its first price"
    assert got["BTC", "7D"].vs_btc_status == "Matched" and got["A", "YTD"].vs_btc_status == "Outperformed"
    assert [got[a, "7D"].rank_by_return for a in ("BTC", "A", "L")] == [1, 2, 2]


def test_performance_without_benchmark(priced):
    got = reports.performance_summary(priced([("A", "stock", "2026-01-01", 1.0)])).collect()
    assert {r.vs_btc_status for r in got} == {"Underperformed"} and {r.btc_return_pct for r in got} == {None}


def test_investments(priced, market_year, holidays, rows):
    prices = priced(market_year)
    filled = core.daily_prices(prices, core.dim_dates(prices, holidays))
    assert rows(reports.investment_comparison(prices)) == rows(reports.investment_comparison(filled))
    three = reports.investment_comparison(prices, benchmark="BTC")
    assert rows(three, "asset", "strategy") == [("BTC", "DCA"), ("BTC", "Lump Sum"), ("USD", "Lump Sum")]
    cash = three.filter("asset = 'USD'").first()
    assert (cash.btc_amount, cash.current_value_usd, cash.profit_loss_usd, cash.return_pct) == (1000.0, 1000.0, 0.0, 0.0)


def test_investments_at_month_ends(priced):
    """Offsets count from the last day: 31 March less one month is 28 February."""
    days = [D(2025, 3, 31) - dt.timedelta(days=i) for i in range(400)]
    prices = priced([("BTC", "crypto", str(d), float(d.toordinal() - 700_000)) for d in days])
    dca = reports.investment_comparison(prices, "BTC").filter("strategy = 'DCA'").first()
    due = [D(2025, 3, 31), D(2025, 2, 28), D(2025, 1, 31), D(2024, 12, 31), D(2024, 11, 30), D(2024, 10, 31),
           D(2024, 9, 30), D(2024, 8, 31), D(2024, 7, 31), D(2024, 6, 30), D(2024, 5, 31), D(2024, 4, 30)]
    paid = [d.toordinal() - 700_000 for d in due]
    assert dca.avg_purchase_price == pytest.approx(sum(paid) / 12, abs=0.005)
    assert dca.btc_amount == pytest.approx(sum(100 / p for p in paid), abs=1e-8)


def test_volatility_report(priced):
    prices = priced([("A", "stock", f"2026-01-{i + 1:02d}", p) for i, p in enumerate([10.0, 11.0, 9.9, 10.89])] +
                    [("C", "odd", f"2026-01-{i + 1:02d}", 5.0) for i in range(3)] +
                    [("ONE", "fiat", "2026-01-01", 1.0), ("ONE", "fiat", "2026-01-02", 2.0)])
    got = {r.asset_id: r for r in reports.volatility_comparison(market.daily_returns(prices)).collect()}
    sd = statistics.stdev([0.1, -0.1, 0.1])
    assert got["A"].daily_volatility_pct == pytest.approx(sd * 100, abs=5e-5)
    assert got["A"].annualized_volatility_pct == pytest.approx(sd * math.sqrt(252) * 100, abs=5e-3)
    assert (got["A"].volatility_rank, got["C"].volatility_rank, got["ONE"].volatility_rank) == (1, 2, 3)
    assert got["C"].category == "Other" and got["A"].category == "Stocks"
    assert got["ONE"].daily_volatility_pct is None and got["ONE"].num_observations == 1


def test_rank_against_a_plain_window(spark, rows):
    rng = random.Random(3)
    values = [rng.choice([0.0, -0.0, 1.5, -2.5, 1e-300, -1e300, rng.gauss(0, 1), rng.gauss(0, 1e6), None]) for _ in range(600)]
    df = spark.createDataFrame([(i, "ab"[i % 2], v) for i, v in enumerate(values)], "id int, g string, v double")
    mine = rows(rank_descending(df, "v", ("g",), "r"), "id", "r")
    plain = df.selectExpr("id", "cast(rank() over (partition by g order by v desc nulls last) as bigint) as r")
    assert mine == rows(plain)
    overall = df.selectExpr("id", "cast(rank() over (order by v desc nulls last) as bigint) as r")
    assert rows(rank_descending(df, "v", (), "r"), "id", "r") == rows(overall)


def test_rank_of_nan_and_infinities(spark, rows):
    values = [float("nan"), float("inf"), float("-inf"), 0.0, 1.0, None, -1e308, 1e308] * 3
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    plain = df.selectExpr("id", "cast(rank() over (order by v desc nulls last) as bigint) as r")
    assert rows(rank_descending(df, "v", (), "r"), "id", "r") == rows(plain)


def test_reports_survive_nan_and_infinity(priced):
    days = [f"2026-01-{i + 1:02d}" for i in range(20)]
    prices = priced([("A", "stock", d, 1.0 + i) for i, d in enumerate(days)] +
                    [("N", "stock", d, float("nan") if i == 5 else 2.0) for i, d in enumerate(days)] +
                    [("I", "stock", d, float("inf") if i == 19 else 3.0) for i, d in enumerate(days)])
    assert reports.volatility_comparison(market.daily_returns(prices)).count() == 3
    assert reports.performance_summary(prices).count() > 0
    assert staging._valid(prices).filter("isnan(close_price)").count() == 0


def test_rank_spreads_dense_values_over_parts(spark, rows):
    # 20,000 distinct values inside one part in 10**8: one magnitude bucket would hold them all.
    df = spark.range(20000).selectExpr("id", "1.0D + (id * 7919 % 20000) * 1e-12D as v")

    counted = df.groupBy(F.col("v").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = [r.n for r in _ranged(counted, []).groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 20000 and max(sizes) <= 3 * 20000 / parts
    plain = df.selectExpr("id", "cast(rank() over (order by v desc nulls last) as bigint) as r")
    assert rows(rank_descending(df, "v", (), "r"), "id", "r") == rows(plain)


def test_rank_keeps_hot_values_whole(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7.0D, cast(id as double)) as v")
    ranked = rank_descending(df, "v", (), "r")
    assert ranked.count() == 3000
    assert ranked.filter("v = 7.0").select("r").distinct().count() == 1
    # Only the bucket totals, bounded in number, meet in one place.
    plan = ranked._jdf.queryExecution().executedPlan().toString().split("Exchange SinglePartition")
    assert len(plan) == 2 and plan[1].strip().splitlines()[1].lstrip(" :+-").startswith("HashAggregate(keys=[_b#")


def brute_correlation(series):
    out = {}
    for a, xs in series.items():
        for b, ys in series.items():
            days = sorted(set(xs) & set(ys))
            x, y = [xs[d] for d in days], [ys[d] for d in days]
            if len(days) < 2 or len(set(x)) == 1 or len(set(y)) == 1:
                continue
            out[a, b] = (statistics.correlation(x, y), len(days))
    return out


@pytest.mark.parametrize("block_size", [2, 128])
def test_correlation_against_brute_force(spark, block_size):
    from bourse.operators.pairwise import correlation_matrix

    rng = random.Random(11)
    series = {}
    for k in range(9):
        series[f"s{k}"] = {d: rng.gauss(5, 1) for d in range(60) if rng.random() < 0.6}
    series["flat"] = {d: 0.1 for d in range(60)}
    # Constant on most common days only, and a large offset: cancellation must not invent a value.
    series["step"] = {d: 1e6 + (1e-3 * d if d > 50 else 0.0) for d in range(60)}
    series["alone"] = {999: 1.0, 1000: 2.0}
    series["half"] = {d: (0.3 if d < 50 else rng.random()) for d in range(60)}
    data = [(k, D(2026, 1, 1) + dt.timedelta(days=d), v) for k, points in series.items() for d, v in points.items()]
    df = spark.createDataFrame(data + [("s0", D(2030, 1, 1), None)], "k string, d date, v double")
    got = {(r.a, r.b): (r.correlation, r.observation_count) for r in
           correlation_matrix(df, "k", "d", "v", block_size=block_size).collect()}
    want = brute_correlation(series)
    assert set(got) == set(want)
    for pair, (value, n) in want.items():
        assert got[pair][1] == n and got[pair][0] == pytest.approx(value, abs=1e-6)


def test_correlation_needs_one_row_a_day_and_little_memory_for_far_days(spark):
    from bourse.operators.pairwise import correlation_matrix

    days = [D(2026, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    data = [(f"s{k}", d, float((k + 2) * i % 7)) for k in range(34) for i, d in enumerate(days)] + [("s0", D(9999, 12, 31), 1.0)]
    df = spark.createDataFrame(data, "k string, d date, v double")
    assert correlation_matrix(df, "k", "d", "v").filter("a = 's0' and b = 's1'").first().observation_count == 40
    chunks = df.selectExpr("floor(datediff(d, date'1970-01-01') / 512) as c").distinct().count()
    assert chunks > 1  # as many groups, since 34 series are one block
    with pytest.raises(Exception, match="one row per series and day"):
        correlation_matrix(df.union(df.limit(1)), "k", "d", "v").collect()


def test_correlation_is_symmetric_and_drops_constants(priced):
    rng = random.Random(5)
    days = [str(D(2026, 1, 1) + dt.timedelta(days=i)) for i in range(30)]
    prices = priced([(a, "stock", d, rng.random() + 1) for a in "ABC" for d in days] + [("USD", "fiat", d, 1.0) for d in days])
    returns = market.daily_returns(prices)
    got = {(r.asset_a, r.asset_b): r for r in reports.return_correlation(returns).collect()}
    assert set(got) == {(a, b) for a in "ABC" for b in "ABC"}
    for (a, b), row in got.items():
        assert row.correlation == pytest.approx(got[b, a].correlation) and row.observation_count == 29
        assert row.asset_a_name == f"name {a}"
    assert got["A", "A"].correlation == pytest.approx(1.0)
    assert reports.return_correlation(returns, ["A", "B"]).count() == 4


def test_window_returns_end_at_the_earliest_last_day(priced, rows):
    prices = priced([("A", "stock", "2026-01-01", 1.0), ("A", "stock", "2026-01-10", 2.0), ("A", "stock", "2026-01-20", 9.0),
                     ("B", "stock", "2026-01-05", 4.0), ("B", "stock", "2026-01-12", 5.0)])
    out = figures.window_returns_observed(prices, {"7D": 7, "YTD": None})
    assert rows(out, "asset", "period", F.round("return_pct", 6)) == [
        ("A", "7D", 0.0), ("A", "YTD", 100.0), ("B", "7D", 25.0), ("B", "YTD", 25.0)]


def test_holding_curve(priced):
    prices = priced([("A", "stock", f"2026-01-0{i + 1}", p) for i, p in enumerate([10.0, 20.0, 5.0, 20.0, 15.0])])
    curve = figures.holding_value_curve(prices)
    assert [r.investment_value for r in curve.orderBy("data_date").collect()] == [1000.0, 2000.0, 500.0, 2000.0, 1500.0]
    row = figures.holding_value_summary(curve).first()
    assert (row.final_value, row.max_value, row.min_value, row.return_pct) == (1500.0, 2000.0, 500.0, 50.0)
    assert row.max_date == D(2026, 1, 2) and row.min_date == D(2026, 1, 3)


def test_monthly_purchases_forward_from_the_first_day(priced):
    # Start on a 31st; the February purchase falls on 2 March, as do nothing else.
    days = ["2025-01-31", "2025-02-15", "2025-03-02", "2025-03-31", "2025-12-31"]
    prices = priced([("A", "stock", d, p) for d, p in zip(days, [10.0, 20.0, 25.0, 50.0, 100.0])])
    got = figures.dca_value_curve(prices).orderBy("data_date").collect()
    # The last row takes April to December, nine purchases.
    assert [r.dca_cost for r in got] == [100.0, 100.0, 200.0, 300.0, 1200.0]
    assert [r.dca_value for r in got] == pytest.approx([100.0, 200.0, 350.0, 800.0, 1600.0 + 900.0])
    assert [r.lump_sum_value for r in got] == pytest.approx([1200.0, 2400.0, 3000.0, 6000.0, 12000.0])
    summary = figures.dca_value_summary(figures.dca_value_curve(prices)).first()
    assert summary.winner == "Lump Sum" and summary.margin == pytest.approx(900.0 - (2500 - 1200) / 12)


def test_volatility_ratio(spark):
    data = [("BTC", 0.1), ("BTC", -0.1), ("EUR", 0.01), ("EUR", -0.01), ("GBP", 0.03), ("GBP", -0.03), ("X", 5.0)]
    df = spark.createDataFrame(data, "asset_id string, daily_return double")
    assert figures.volatility_ratio(df).first().ratio == pytest.approx(5.0)
    assert figures.volatility_ratio(df.filter("asset_id = 'BTC'")).first().ratio == 0.0
    assert figures.volatility_ratio(df.filter("asset_id <> 'BTC'")).first().ratio == 0.0


def test_holiday_reports(spark, holidays, rows, tmp_path):
    assert holidays.count() == sum(map(len, fv.HOLIDAYS.values())) == 52
    closures = reference_data.weekday_closures(holidays)
    assert closures.filter("holiday_name = 'Boxing Day' and holiday_date = '2026-12-26'").count() == 0
    assert closures.filter("market_code = 'US' and holiday_date = '2026-07-03'").first().day_of_week == "Friday"
    rates = spark.createDataFrame([("EUR", "2025-05-01", 1.1), ("GBP", "2025-05-01", 1.3), ("GBP", "2025-05-05", 1.4)],
                                  "asset_id string, d string, close_price double").withColumn("data_date", F.col("d").cast("date"))
    assert rows(reference_data.holiday_overlaps(rates, holidays), "asset_id", "holiday_name", "market_code") == [
        ("EUR", "Labour Day", "EU"), ("GBP", "Early May Bank Holiday", "UK")]


def test_holidays_from_csv(spark, rows, tmp_path):
    for code, days in fv.HOLIDAYS.items():
        lines = ["holiday_date,holiday_name,market_status"] + [",".join(d) for d in days]
        (tmp_path / f"{code}.csv").write_text("\n".join(lines))
    read = reference_data.read_holidays(spark, {code: str(tmp_path / f"{code}.csv") for code in fv.HOLIDAYS})
    assert rows(read) == rows(reference_data.builtin_holidays(spark))


def test_catalogue(spark):
    assets = reference_data.builtin_catalogue(spark)

    def tickers(**filters):
        return sorted(r.ticker for r in reference_data.select_assets(assets, **filters).collect())

    assert len(tickers()) == 7
    assert tickers(tags=["sp500", "tech"]) == ["AAPL", "GOOGL", "MSFT"]
    assert tickers(source="massive", resource="forex") == ["C:EURUSD", "C:GBPUSD"]
    assert tickers(asset_type="crypto", tags=["btc"]) == ["bitcoin"] and tickers(tags=["none"]) == []
    off = assets.withColumn("enabled", F.col("ticker") != "SPY")
    assert reference_data.select_assets(off).count() == 6
    assert reference_data.select_assets(off, enabled_only=False).count() == 7


def test_swaps(spark):
    df = spark.createDataFrame([("a", "x", "0", "1789724345320037", "5008826", "0"), ("a", "y", "1", "0", "0", "0"),
                                ("b", "y", None, "0", "0", "0")],
                               "taker string, tx_from string, amount0_in string, amount1_in string, amount0_out string, amount1_out string")
    row = swaps.swap_amounts(df).first()
    assert row.amount1_in == pytest.approx(0.0017897, abs=1e-7) and row.amount0_out == 5.008826
    assert tuple(swaps.unique_takers(df).first()) == (2, 2)
    assert tuple(swaps.unique_takers(df, approximate=True).first()) == (2, 2)


def test_build_writes_and_tests_every_model(spark, priced, market_year, holidays, tmp_path):
    prices = priced(market_year)
    build = build_models(prices.filter("asset_type = 'crypto'").withColumn("data_timestamp", F.col("data_date").cast("timestamp")),
                         prices.filter("asset_type = 'stock'"),
                         prices.filter("asset_type = 'fiat'").limit(0), holidays, str(tmp_path))
    assert set(build.models) == set(LAYERS)
    for name, layer in LAYERS.items():
        assert (tmp_path / layer / f"{PUBLISHED_NAMES[name]}.parquet").is_dir()
        assert build.models[name].count() > 0 or name == "stg_rates"
    gaps = build.models["data_gaps"]
    failing = gaps.filter("asset_type in ('crypto', 'forex') or (asset_type in ('stock', 'index') and is_trading_day = 1)").count()
    assert failing > 100 and market.critical_gaps(gaps).count() == 100
    assert {k: v for k, v in build.violations.items() if v} == {"no_critical_gaps": failing}
    assert set(build.violations) == set(data_tests(build.models))
    assert not build.ok
    assert build.models["investment_comparison"].count() == 3
    assert build.models["daily_prices_locf"].filter("price_source = 'IMPUTED'").count() > 0


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_bucketed_prices_need_no_further_shuffle(spark, priced, market_year, holidays, tmp_path, rows):
    prices = priced(market_year)
    prices = prices.filter("asset_id <> 'USD'")  # cash is added by the build
    none = prices.limit(0)
    build = build_models(prices, none, none, holidays, str(tmp_path), run_tests=False, buckets=4,
                         cash_ingested_at=F.lit("t"))
    stored, returns = build.models["unified_prices"], build.models["daily_returns"]
    assert exchanges(market.daily_returns(stored)) == 0
    assert exchanges(market.rolling_metrics(market.daily_returns(stored))) == 0
    assert exchanges(figures.holding_value_curve(stored)) == 0
    assert exchanges(figures.annualised_volatility(returns)) == 0
    direct = market.daily_returns(core.unified_prices(prices, cash_ingested_at=F.lit("t")))
    assert rows(returns) == rows(direct)


def test_numbering_over_many_parts(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from bourse.operators.ranking import numbered

    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 101).alias("k"), (F.col("id") % 3).alias("g")).repartition(7)
    order = [F.col("k"), F.desc("g"), F.col("id")]
    mine = numbered(df, order, "n")
    assert mine.rdd.getNumPartitions() >= 1
    plain = df.withColumn("n", F.row_number().over(Window.orderBy(*order)))
    assert sorted(mine.select("id", "n").collect()) == sorted(plain.select("id", "n").collect())
    assert numbered(df.limit(0), order, "n").count() == 0
