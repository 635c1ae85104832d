"""The reports: performance, simulated investments, volatility, correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse import fixed_values as fv
from bourse.functions.metrics import annualised, growth, lookup, period_start
from bourse.operators.asof import anchored, calendar_index, filled_on
from bourse.operators.pairwise import correlation_matrix
from bourse.operators.ranking import numbered, rank_descending


def _filled_at(names: list[str]) -> list[Column]:
    """Forward-filled price at each anchor day (the column ``day_<name>``), under the given names."""
    price, date = F.col("close_price"), F.col("data_date")
    return [filled_on(price, date, F.col(f"day_{name}")).alias(name) for name in names]


def performance_summary(prices: DataFrame, periods: dict[str, int | None] | None = None,
                        benchmark: str = fv.BENCHMARK_ID, calendar: DataFrame | None = None) -> DataFrame:
    """Return per asset and period on forward-filled prices, against the benchmark, ranked.

    Filled prices are looked up from the observed ones, so the input is
    ``unified_prices`` (the filled table gives the same result) and one
    aggregation per asset answers all periods. ``calendar``, a table with the
    priced days as ``data_date``, saves the scan for them.
    """
    periods = fv.REPORT_PERIODS if periods is None else periods
    priced = prices.filter(F.col("close_price").isNotNull())
    names = [f"at_{p}" for p in periods]
    index = calendar_index(priced if calendar is None else calendar, "data_date")
    days = anchored(priced, index, [period_start(F.col("max_date"), days) for days in periods.values()], [f"day_{n}" for n in names])
    per_asset = days.groupBy("asset_id", "asset_name", "asset_type").agg(
        F.max_by("close_price", "data_date").alias("current_price"), *_filled_at(names))
    rows = F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"at_{p}").alias("start_price")) for p in periods])
    long = per_asset.select("asset_id", "asset_name", "asset_type", "current_price", F.inline(rows))
    returns = long.filter(F.col("start_price") > 0).withColumn(
        "return_pct", growth(F.col("current_price"), F.col("start_price")))
    # One row per period: never more than the periods asked for. Folding the
    # aggregated rows reuses their shuffle where a filter would scan again.
    bench = returns.groupBy("period").agg(
        F.max(F.when(F.col("asset_id") == benchmark, F.col("return_pct"))).alias("btc_return_pct"))
    compared = returns.join(F.broadcast(bench), "period", "left")
    mine, theirs = F.col("return_pct"), F.col("btc_return_pct")
    judged = compared.select(
        "asset_id", "asset_name", "asset_type", "period", "start_price", "current_price", "return_pct",
        "btc_return_pct", (mine - theirs).alias("return_vs_btc"),
        F.when(mine > theirs, "Outperformed").when(mine == theirs, "Matched").otherwise("Underperformed")
         .alias("vs_btc_status"),
    )
    return rank_descending(judged, "return_pct", ("period",), "rank_by_return")


def performance_order() -> list[Column]:
    """Periods from short to long, best return first."""
    return [lookup(F.col("period"), {p: i for i, p in enumerate(fv.REPORT_PERIODS)}, F.lit(99)), F.col("rank_by_return"),
            F.col("asset_id")]


def investment_order(benchmark: str = fv.BENCHMARK_ID) -> list[Column]:
    """Cash before the benchmark before others, lump sum before monthly purchases."""
    return [lookup(F.col("asset"), {fv.CASH_ID: 1, benchmark: 2}, F.lit(3)), F.col("asset"),
            lookup(F.col("strategy"), {"Lump Sum": 1, "DCA": 2}, F.lit(3))]


def volatility_order() -> list[Column]:
    return [F.col("volatility_rank"), F.col("asset_id")]


def correlation_order() -> list[Column]:
    """By first asset, closest companion first."""
    return [F.col("asset_a"), F.desc("correlation"), F.col("asset_b")]


def with_position(report: DataFrame, order: list[Column]) -> DataFrame:
    """A report's rows numbered in the order in which they are shown. Reports have a row an asset, period or pair."""
    return numbered(report, order, "position")


def investment_comparison(prices: DataFrame, benchmark: str | None = None,
                          calendar: DataFrame | None = None) -> DataFrame:
    """Lump sum a year ago against monthly purchases, per asset, on filled prices.

    With ``benchmark``: its two strategies and cash, nothing else.
    """
    months = [f"buy_{k}" for k in range(fv.MONTHLY_PURCHASES)]
    targets = [F.date_sub("max_date", 365), *[F.add_months("max_date", -k) for k in range(len(months))]]
    priced = prices.filter(F.col("close_price").isNotNull())
    index = calendar_index(priced if calendar is None else calendar, "data_date")
    if benchmark is not None:
        priced = priced.filter(F.col("asset_id").isin(benchmark, fv.CASH_ID))
    names = ["year_ago", *months]
    at = anchored(priced, index, targets, [f"day_{n}" for n in names]).groupBy("asset_id").agg(
        F.max_by("close_price", "data_date").alias("current_price"), *_filled_at(names))
    current = F.col("current_price")
    bought = [F.col(m) for m in months]

    def total(columns: list[Column]) -> Column:
        return sum(columns[1:], columns[0])

    def strategy(name: str, invested: float, mean_price: Column, units: Column) -> Column:
        value = units * current
        return F.struct(
            F.lit(name).alias("strategy"),
            F.lit(invested).alias("initial_investment_usd"),
            F.round(mean_price, 2).alias("avg_purchase_price"),
            F.round(current, 2).alias("current_price"),
            F.round(units, 8).alias("btc_amount"),
            F.round(value, 2).alias("current_value_usd"),
            F.round(value - invested, 2).alias("profit_loss_usd"),
            F.round((value / invested - 1) * 100, 2).alias("return_pct"),
        )

    lump = strategy("Lump Sum", fv.LUMP_SUM_USD, F.col("year_ago"),
                    F.try_divide(F.lit(fv.LUMP_SUM_USD), F.col("year_ago")))
    monthly = strategy("DCA", fv.MONTHLY_USD * len(months), total(bought) / len(months),
                       total([F.try_divide(F.lit(fv.MONTHLY_USD), b) for b in bought]))
    result = at.select(F.col("asset_id").alias("asset"), F.inline(F.array(lump, monthly)))
    if benchmark is not None:
        result = result.filter((F.col("asset") == benchmark) | (F.col("strategy") == "Lump Sum"))
    return result


def volatility_comparison(returns: DataFrame) -> DataFrame:
    """Return statistics per asset with the rank by volatility and a category."""
    r = F.col("daily_return")
    stats = returns.filter(r.isNotNull()).groupBy("asset_id", "asset_name", "asset_type").agg(
        F.count(r).alias("num_observations"), F.avg(r).alias("mean"), F.stddev_samp(r).alias("volatility"),
        F.min(r).alias("lowest"), F.max(r).alias("highest"),
    )
    ranked = rank_descending(stats, "volatility", (), "volatility_rank")
    return ranked.select(
        "asset_id", "asset_name", "asset_type",
        lookup(F.col("asset_type"), fv.CLASS_CATEGORY, F.lit("Other")).alias("category"),
        "num_observations",
        F.round(F.col("mean") * 100, 4).alias("avg_daily_return_pct"),
        F.round(F.col("volatility") * 100, 4).alias("daily_volatility_pct"),
        F.round(annualised(F.col("volatility")) * 100, 2).alias("annualized_volatility_pct"),
        F.round(F.col("lowest") * 100, 2).alias("min_daily_return_pct"),
        F.round(F.col("highest") * 100, 2).alias("max_daily_return_pct"),
        "volatility_rank",
    )


def return_correlation(returns: DataFrame, assets: list[str] | None = None, **blocking) -> DataFrame:
    """Correlation of daily returns on common days for all ordered pairs, self included."""
    if assets:
        returns = returns.filter(F.col("asset_id").isin(*assets))
    pairs = correlation_matrix(returns, "asset_id", "data_date", "daily_return", "asset_name", **blocking)
    return pairs.select(F.col("a").alias("asset_a"), F.col("a_label").alias("asset_a_name"),
                        F.col("b").alias("asset_b"), F.col("b_label").alias("asset_b_name"),
                        "correlation", "observation_count")
