"""Headline figures on observed prices: period returns, holding and purchase curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse import fixed_values as fv
from bourse.functions.metrics import annualised, growth, period_start
from bourse.operators.asof import first_on_or_after, last_on_or_before
from bourse.operators.fill import series_window


def window_returns_observed(prices: DataFrame, periods: dict[str, int | None] | None = None) -> DataFrame:
    """Percent return per asset and period up to the earliest of the assets' last days."""
    periods = fv.FIGURE_PERIODS if periods is None else periods
    end = (prices.groupBy("asset_id").agg(F.max("data_date").alias("last"))
                 .agg(F.min("last").alias("last")).scalar())
    price, date = F.col("close_price"), F.col("data_date")
    per_asset = prices.groupBy("asset_id").agg(
        last_on_or_before(price, date, end).alias("end_price"),
        *[first_on_or_after(price, date, period_start(end, days)).alias(f"at_{p}") for p, days in periods.items()],
    )
    rows = F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"at_{p}").alias("start_price")) for p in periods])
    return (per_asset.select("asset_id", "end_price", F.inline(rows))
            .filter(F.col("start_price").isNotNull() & F.col("end_price").isNotNull())
            .select("period", F.col("asset_id").alias("asset"),
                    (growth(F.col("end_price"), F.col("start_price")) * 100).alias("return_pct")))


def holding_value_curve(prices: DataFrame, amount: float = fv.LUMP_SUM_USD) -> DataFrame:
    """Value per day of ``amount`` put into the asset at its first price."""
    first = F.first("close_price").over(
        series_window("asset_id", "data_date").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return prices.select(
        "asset_id", "data_date", "close_price",
        (F.col("close_price") * F.try_divide(F.lit(amount), first)).alias("investment_value"))


def holding_value_summary(curve: DataFrame, amount: float = fv.LUMP_SUM_USD) -> DataFrame:
    """Final value, peak and trough with their first days, and the return."""
    value, date = F.col("investment_value"), F.col("data_date")
    days = F.datediff(date, F.lit("1970-01-01").cast("date"))
    # Among equal extremes the earliest day counts.
    return curve.groupBy("asset_id").agg(
        F.max_by(value, date).alias("final_value"),
        F.max(value).alias("max_value"), F.min(value).alias("min_value"),
        F.max_by(date, F.struct(value, -days)).alias("max_date"),
        F.min_by(date, F.struct(value, days)).alias("min_date"),
    ).withColumn("return_pct", (F.col("final_value") - amount) / amount * 100)


def dca_value_curve(prices: DataFrame, monthly: float = fv.MONTHLY_USD,
                    purchases: int = fv.MONTHLY_PURCHASES) -> DataFrame:
    """One purchase of everything on the first day beside equal monthly purchases.

    Purchase k happens on the first observed day at or after first day + k
    months. A row knows which purchases fall on it from its predecessor's day,
    so one pass per asset does it.
    """
    by_day = series_window("asset_id", "data_date")
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = prices.select(
        "asset_id", "data_date", "close_price",
        F.first("data_date").over(running).alias("_first_day"),
        F.first("close_price").over(running).alias("_first_price"),
        F.lag("data_date").over(by_day).alias("_before"),
    )
    due = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(purchases - 1)), lambda k: F.add_months(F.col("_first_day"), k)),
        lambda day: (day <= F.col("data_date")) & (F.col("_before").isNull() | (day > F.col("_before"))))
    spent = F.size(due) * F.lit(monthly)
    buying = seen.withColumn("_spent", spent).withColumn(
        "_units", F.coalesce(F.try_divide(F.col("_spent"), F.col("close_price")), F.lit(0.0)))
    total = monthly * purchases
    return buying.select(
        "asset_id", "data_date",
        (F.col("close_price") * F.try_divide(F.lit(total), F.col("_first_price"))).alias("lump_sum_value"),
        (F.sum("_units").over(running) * F.col("close_price")).alias("dca_value"),
        F.sum("_spent").over(running).alias("dca_cost"),
    )


def dca_value_summary(curve: DataFrame, monthly: float = fv.MONTHLY_USD,
                      purchases: int = fv.MONTHLY_PURCHASES) -> DataFrame:
    """Final values and returns of both strategies, the winner and its margin."""
    total = monthly * purchases
    date = F.col("data_date")
    final = curve.groupBy("asset_id").agg(
        F.max_by("lump_sum_value", date).alias("final_lump"), F.max_by("dca_value", date).alias("final_dca"))
    lump, dca = (F.col("final_lump") - total) / total * 100, (F.col("final_dca") - total) / total * 100
    return final.withColumns({"lump_return": lump, "dca_return": dca}).withColumns({
        "winner": F.when(F.col("dca_return") > F.col("lump_return"), "DCA").otherwise("Lump Sum"),
        "margin": F.abs(F.col("dca_return") - F.col("lump_return")),
    })


def annualised_volatility(returns: DataFrame) -> DataFrame:
    return returns.groupBy("asset_id").agg(
        (annualised(F.stddev_samp("daily_return")) * 100).alias("annualized_volatility_pct"))


def volatility_ratio(returns: DataFrame, benchmark: str = fv.BENCHMARK_ID,
                     compare: tuple[str, ...] = ("EUR", "GBP")) -> DataFrame:
    """Benchmark volatility over the mean volatility of the compared assets; 0 when that is not positive."""
    wanted = returns.filter(F.col("asset_id").isin(benchmark, *compare))
    v, asset = F.col("annualized_volatility_pct"), F.col("asset_id")
    row = annualised_volatility(wanted).agg(
        F.coalesce(F.max(F.when(asset == benchmark, v)), F.lit(0.0)).alias("benchmark_volatility"),
        F.avg(F.when(asset.isin(*compare), v)).alias("compared_mean"),
    )
    return row.withColumn("ratio", F.when(F.col("compared_mean") > 0,
                                          F.col("benchmark_volatility") / F.col("compared_mean")).otherwise(0.0))
