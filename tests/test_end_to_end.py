"""From landed JSON to the reports, with the built-in contracts."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from bourse import contracts
from bourse.fixed_values import HOLIDAYS
from bourse.operators import ledger
from bourse.operators.flatten import batch_key
from bourse.plans import staging
from bourse.plans.build import build_models
from bourse.plans.ingest import ingest, quality_result
from bourse.sources import landing, published, reference_data

START, DAYS = dt.date(2025, 1, 28), 366


def ms(day, hour=0):
    return int(dt.datetime(day.year, day.month, day.day, hour, tzinfo=dt.timezone.utc).timestamp() * 1000)


def coin_response():
    days = [START + dt.timedelta(days=i) for i in range(DAYS)]
    points = [(ms(d), 100.0 + i) for i, d in enumerate(days)] + [(ms(days[-1], 7), 862.23)]
    return {"prices": points, "market_caps": [(t, p * 10) for t, p in points], "total_volumes": [(t, 5.0) for t, _ in points]}


def bar_response(base, closed=()):
    bars = []
    for i in range(DAYS):
        day = START + dt.timedelta(days=i)
        if day.weekday() < 5 and str(day) not in closed:
            p = base + i % 9
            bars.append({"t": ms(day), "o": p, "h": p + 1, "l": p - 1, "c": p, "v": 10, "vw": p})
    return {"results": bars}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    us_closed = {d for d, _, status in HOLIDAYS["US"] if status == "closed"}
    calls = [
        (contracts.CRYPTO_SERIES, "bitcoin", coin_response()),
        (contracts.STOCK_BARS, "AAPL", bar_response(200.0, us_closed)),
        (contracts.STOCK_BARS, "SPY", bar_response(500.0, us_closed | {"2025-03-12"})),
        (contracts.RATE_BARS, "C:EURUSD", bar_response(10.0)),
        (contracts.RATE_BARS, "C:GBPUSD", bar_response(12.0)),
    ]
    stamp = F.lit("2026-01-28T06:00:00").cast("timestamp")
    results = []
    for contract, ticker, response in calls:
        batch = spark.range(1).select(batch_key(contract.source, contract.resource, F.lit(str(START)).cast("date"),
                                                F.lit(ticker))).first()[0]
        df = spark.createDataFrame([(contract.source, "2026-01-28", batch, json.dumps(response), ticker)],
                                   "source string, ingestion_date string, batch_id string, payload string, ticker string")
        landing.write_landing(df, f"{root}/staging_{contract.resource}", parameters=("ticker",))
        rows = landing.read_landing(spark, f"{root}/staging_{contract.resource}", contract,
                                    parameters={"ticker": "string"}).filter(F.col("batch_id") == batch)
        outcome = ingest(rows, root, contract, batch, {"ticker": F.col("ticker")}, stamp)
        results.append(quality_result(spark, contract, batch, outcome.audit, at=stamp))
    ledger.append(results[0].unionByName(results[1]).unionByName(results[2]), f"{root}/ledger")
    ledger.append(results[3].unionByName(results[4]).unionByName(results[4]), f"{root}/ledger")
    return root


@pytest.fixture(scope="module")
def models(spark, lake):
    series = staging.benchmark_series(published.read_published(spark, lake, contracts.CRYPTO_SERIES))
    bars = staging.stock_bars(published.read_published(spark, lake, contracts.STOCK_BARS))
    rates = staging.rate_bars(published.read_published(spark, lake, contracts.RATE_BARS))
    return build_models(series, bars, rates, reference_data.builtin_holidays(spark), lake)


def test_ledger_of_the_run(spark, lake):
    rows = ledger.pass_rate(ledger.current_results(spark.read.parquet(f"{lake}/ledger"))).collect()
    assert {(r.resource, r.total_runs, r.pass_rate_pct) for r in rows} == {
        ("market_chart", 1, 100.0), ("stocks", 2, 100.0), ("forex", 2, 100.0)}


def test_bronze_keeps_all_points_and_staging_the_latest(spark, lake, models):
    bronze = published.read_published(spark, lake, contracts.CRYPTO_SERIES)
    assert bronze.count() == DAYS + 1
    series = models.models["stg_benchmark_series"]
    last = series.orderBy(F.desc("data_date")).first()
    assert series.count() == DAYS and last.close_price == 862.23
    assert last["__batch_id"] == "coingecko_market_chart_20250128_bitcoin"


def test_data_tests_find_only_the_missing_session(models):
    assert {k: v for k, v in models.violations.items() if v} == {"no_critical_gaps": 1}
    gap = models.models["data_gaps"].filter("asset_id = 'SPY'").collect()
    assert [str(g.missing_date) for g in gap] == ["2025-03-12"]


def test_reports(models):
    invest = {(r.asset, r.strategy): r for r in models.models["investment_comparison"].collect()}
    lump = invest["BTC", "Lump Sum"]
    assert lump.avg_purchase_price == 100.0 and lump.current_value_usd == pytest.approx(8622.3)
    assert invest["USD", "Lump Sum"].profit_loss_usd == 0.0 and invest["BTC", "DCA"].initial_investment_usd == 1200.0
    performance = models.models["performance_summary"]
    assert performance.count() == 6 * 6
    assert performance.filter("asset_id = 'BTC' and vs_btc_status <> 'Matched'").count() == 0
    volatility = models.models["volatility_comparison"]
    assert volatility.filter("asset_id = 'USD'").first().volatility_rank == 6
    assets = {r.asset_id: (r.asset_name, r.asset_type) for r in models.models["dim_assets"].collect()}
    assert assets == {"BTC": ("Bitcoin", "crypto"), "USD": ("US Dollar", "fiat"), "AAPL": ("Apple Inc.", "stock"),
                      "SPY": ("S&P 500 ETF", "index"), "EUR": ("Euro", "fiat"), "GBP": ("British Pound", "fiat")}
    correlation = models.models["return_correlation"]
    assert correlation.filter("asset_a = 'USD'").count() == 0 and correlation.count() == 25


def test_filled_prices_cover_weekends(models):
    filled = models.models["daily_prices_locf"]
    assert filled.filter("asset_id = 'AAPL'").count() == DAYS
    assert filled.filter("asset_id = 'AAPL' and price_source = 'IMPUTED' and dayofweek(data_date) in (1, 7)").count() > 100
