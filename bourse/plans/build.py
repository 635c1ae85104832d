"""Build every model once, in dependency order, with its data tests.

Each model is declared once: how it is built from the models before it, its layer, sort and data tests. Models read more
than once are written and read back, so each is computed once and a lost executor costs one model, not the whole chain.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse import fixed_values as fv
from bourse.contracts import Contract
from bourse.operators import checks as c
from bourse.plans import core, market, reports
from bourse.sources.published import write_model

# --- fixed values: the names under which readers of the published tables expect them ---
PUBLISHED_NAMES = {
    "stg_benchmark_series": "stg_coingecko__market_chart",
    "stg_bars": "stg_massive__stocks_daily",
    "stg_rates": "stg_massive__forex_daily",
    "stg_holidays": "stg_static__market_holidays",
    "unified_prices": "int_market__unified_prices",
    "daily_returns": "int_market__daily_returns",
    "benchmark_relative": "int_market__btc_relative_perf",
    "rolling_metrics": "int_market__rolling_metrics",
    "data_gaps": "int_market__data_gaps",
    "dim_assets": "dim_assets",
    "dim_dates": "dim_dates",
    "daily_prices_locf": "fct_daily_prices",
    "fct_daily_returns": "fct_daily_returns",
    "fct_rolling_metrics": "fct_rolling_metrics",
    "performance_summary": "rpt_performance_summary",
    "investment_comparison": "rpt_investment_simulation",
    "volatility_comparison": "rpt_volatility_comparison",
    "return_correlation": "rpt_correlation",
}

Models = dict[str, DataFrame]


@dataclass(frozen=True)
class Inputs:
    """Staged tables and options that models are built from."""

    series: DataFrame
    bars: DataFrame
    rates: DataFrame
    holidays: DataFrame
    benchmark: str
    options: dict


@dataclass(frozen=True)
class Model:
    """A model and what must hold for it."""

    name: str
    layer: str
    build: Callable[[Models, Inputs], DataFrame]
    not_null: tuple[str, ...]
    accepted: dict[str, tuple] = field(default_factory=dict)
    unique: str | None = None
    related: dict[str, tuple[str, str]] = field(default_factory=dict)
    sort: tuple[str, ...] = ()


def _calendar(models: Models) -> DataFrame:
    return models["dim_dates"].select(F.col("date").alias("data_date"))


_CLASSES = ("crypto", "fiat", "stock", "index")
_BY_DAY = ("asset_id", "data_date")

# In dependency order. Filled prices are looked up in the observed ones: far fewer rows to read.
MODELS = (
    Model("stg_benchmark_series", "staging", lambda m, i: i.series,
          ("data_date", "data_timestamp", "close_price", "asset_id"), {"asset_id": (fv.BENCHMARK_ID,)}),
    Model("stg_bars", "staging", lambda m, i: i.bars, ("asset_id", "data_date", "close_price"),
          {"asset_type": ("stock", "index", "unknown")}),
    Model("stg_rates", "staging", lambda m, i: i.rates, ("asset_id", "data_date", "close_price"), {"asset_type": ("fiat",)}),
    Model("stg_holidays", "staging", lambda m, i: i.holidays, ("holiday_date", "market_status", "market_code"),
          {"market_code": ("US", "UK", "EU")}),
    Model("unified_prices", "intermediate",
          lambda m, i: core.unified_prices(m["stg_benchmark_series"], m["stg_bars"], m["stg_rates"], i.benchmark, **i.options),
          ("asset_id", "data_date", "close_price"), sort=_BY_DAY),
    Model("daily_returns", "intermediate", lambda m, i: market.daily_returns(m["unified_prices"]),
          ("asset_id", "data_date", "close_price"), sort=_BY_DAY),
    Model("benchmark_relative", "intermediate", lambda m, i: market.benchmark_relative(m["daily_returns"], i.benchmark),
          _BY_DAY, {"outperformed_btc_flag": (0, 1)}),
    Model("rolling_metrics", "intermediate", lambda m, i: market.rolling_metrics(m["daily_returns"]), _BY_DAY),
    Model("dim_assets", "marts", lambda m, i: core.dim_assets(m["unified_prices"]), ("asset_id",),
          {"asset_type": _CLASSES}, unique="asset_id"),
    Model("dim_dates", "marts", lambda m, i: core.dim_dates(m["unified_prices"], m["stg_holidays"]), ("date",),
          {"is_trading_day": (0, 1)}, unique="date"),
    Model("data_gaps", "intermediate",
          lambda m, i: market.data_gaps(m["unified_prices"], m["dim_dates"]).withColumn("detected_at", F.current_timestamp()),
          ("asset_id", "missing_date"), {"asset_type": _CLASSES, "is_trading_day": (0, 1)}),
    Model("daily_prices_locf", "marts",
          lambda m, i: core.daily_prices(m["unified_prices"], m["dim_dates"], m["dim_assets"]),
          ("asset_id", "data_date", "close_price"), {"price_source": ("OBSERVED", "IMPUTED")},
          related={"asset_id": ("dim_assets", "asset_id")}),
    Model("fct_daily_returns", "marts", lambda m, i: core.fct_daily_returns(m["daily_returns"]), _BY_DAY, sort=_BY_DAY),
    Model("fct_rolling_metrics", "marts", lambda m, i: market.fct_rolling_metrics(m["rolling_metrics"]), _BY_DAY),
    Model("performance_summary", "marts",
          lambda m, i: reports.performance_summary(m["unified_prices"], benchmark=i.benchmark, calendar=_calendar(m)),
          ("asset_id", "period"), {"period": ("7D", "1M", "3M", "6M", "YTD", "1Y"),
                                   "vs_btc_status": ("Outperformed", "Matched", "Underperformed")}),
    Model("investment_comparison", "marts",
          lambda m, i: reports.investment_comparison(m["unified_prices"], i.benchmark, _calendar(m)),
          ("asset", "strategy", "initial_investment_usd", "current_value_usd")),
    Model("volatility_comparison", "marts", lambda m, i: reports.volatility_comparison(m["fct_daily_returns"]),
          ("asset_id", "daily_volatility_pct", "annualized_volatility_pct"), unique="asset_id"),
    Model("return_correlation", "marts",
          lambda m, i: reports.return_correlation(m["fct_daily_returns"], blocks=ceil(m["dim_assets"].count() / 256) or 1),
          ("asset_a", "asset_b", "correlation")),
)
LAYERS = {model.name: model.layer for model in MODELS}


@dataclass
class Build:
    models: Models = field(default_factory=dict)
    violations: dict[str, int] = field(default_factory=dict)
    freshness: dict[str, str] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not any(self.violations.values()) and "error" not in self.freshness.values()


def data_tests(models: Models) -> dict[str, DataFrame]:
    """Violating rows per declared test, for the models given."""
    tests = {}
    for model in MODELS:
        df = models.get(model.name)
        if df is None:
            continue
        tests[f"not_null:{model.name}"] = c.not_null_violations(df, *model.not_null)
        if model.unique:
            tests[f"unique:{model.name}.{model.unique}"] = c.unique_violations(df, model.unique)
        for column, values in model.accepted.items():
            tests[f"accepted_values:{model.name}.{column}"] = c.accepted_values_violations(df, column, values)
        for column, (parent, key) in model.related.items():
            if parent in models:
                tests[f"relationships:{model.name}.{column}"] = c.relationship_violations(df, column, models[parent], key)
    if "data_gaps" in models:
        tests["no_critical_gaps"] = market.failing_gaps(models["data_gaps"])
    return tests


def _any_null(columns: tuple[str, ...]) -> Column:
    return reduce(operator.or_, [F.col(column).isNull() for column in columns])


def count_violations(models: Models) -> dict[str, int]:
    """Violations per declared test: all row tests of a model in one aggregation, the others each in its own."""
    counts = {}
    for model in MODELS:
        if model.name in models:
            tests = {f"not_null:{model.name}": _any_null(model.not_null)} | {
                f"accepted_values:{model.name}.{column}": ~F.col(column).isin(*values)
                for column, values in model.accepted.items()}
            row = models[model.name].agg(*[F.count_if(bad).alias(f"t{k}") for k, bad in enumerate(tests.values())]).first()
            counts |= dict(zip(tests, row))
    others = {name: rows for name, rows in data_tests(models).items() if not name.startswith(("not_null:", "accepted_values:"))}
    return counts | {name: rows.count() for name, rows in others.items()}


def source_tests(tables: dict[Contract, DataFrame], now: Column | None = None) -> tuple[dict[str, int], dict[str, str]]:
    """Null keys and prices of the published tables, and how fresh each is: pass, warn or error."""
    nulls, ages = {}, {}
    for contract, table in tables.items():
        name = f"{contract.source}.{contract.resource}"
        nulls[f"not_null:{name}"] = table.agg(F.count_if(_any_null(contract.required)).alias("n")).first().n
        warn_days, error_days = contract.freshness_days
        ages[name] = c.freshness(table, "__ingested_at", warn_days, error_days, now).first().status
    return nulls, ages


def build_models(series: DataFrame, bars: DataFrame, rates: DataFrame, holidays: DataFrame, root: str,
                 run_tests: bool = True, benchmark: str = fv.BENCHMARK_ID, buckets: int | None = None,
                 sources: dict[Contract, DataFrame] | None = None, now: Column | None = None, **options) -> Build:
    """All models from staged inputs under ``<root>/<layer>/<published name>.parquet``.

    ``buckets`` hashes prices and returns by asset: the one shuffle at their
    writing then serves every per-asset model after them. ``sources``, the
    published tables by contract, are tested too, as of ``now``.
    """
    build = Build()
    given = Inputs(series, bars, rates, holidays, benchmark, options)
    for model in MODELS:
        build.models[model.name] = write_model(
            model.build(build.models, given), root, model.layer, PUBLISHED_NAMES[model.name], model.sort,
            buckets if model.sort else None)
    if run_tests:
        build.violations = count_violations(build.models)
        nulls, build.freshness = source_tests(sources or {}, now)
        build.violations |= nulls
    return build
