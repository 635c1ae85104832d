"""Returns, benchmark-relative performance, rolling metrics and gaps.

All windows run per asset over the staged table, which has one row per (asset,
day): a window never holds more rows than the calendar has days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse import fixed_values as fv
from bourse.functions.metrics import change
from bourse.operators.fill import missing_days, series_window

ROLLING_ROWS = (7, 14, 30)


def daily_returns(prices: DataFrame) -> DataFrame:
    """Change against the previous observed row, and the days between them."""
    by_day = series_window("asset_id", "data_date")
    seen = prices.filter(F.col("data_date").isNotNull()).select(
        "asset_id", "asset_name", "asset_type", "data_date", "close_price",
        F.lag("close_price").over(by_day).alias("prev_close_price"),
        F.datediff(F.col("data_date"), F.lag("data_date").over(by_day)).cast("bigint").alias("days_gap"),
        "__batch_id", "__ingested_at",
    )
    return seen.withColumn("daily_return", change(F.col("close_price"), F.col("prev_close_price"))).select(
        "asset_id", "asset_name", "asset_type", "data_date", "close_price", "prev_close_price",
        "daily_return", "days_gap", "__batch_id", "__ingested_at")


def benchmark_relative(returns: DataFrame, benchmark: str = fv.BENCHMARK_ID) -> DataFrame:
    """Each asset's return beside the benchmark's of the same day.

    Grouping bounds the benchmark side by the calendar (one row per day), so it
    is broadcast and the large side is not shuffled by day.
    """
    bench = returns.filter(F.col("asset_id") == benchmark).groupBy("data_date").agg(
        F.max("daily_return").alias("btc_daily_return"))
    others = returns.filter(F.col("asset_id") != benchmark).select(
        "asset_id", "asset_name", "asset_type", "data_date", F.col("daily_return").alias("asset_return"))
    mine, theirs = F.col("asset_return"), F.col("btc_daily_return")
    return others.join(F.broadcast(bench), "data_date", "left").select(
        "asset_id", "asset_name", "asset_type", "data_date", "asset_return", "btc_daily_return",
        (F.coalesce(mine, F.lit(0.0)) - F.coalesce(theirs, F.lit(0.0))).alias("return_vs_btc"),
        F.when(mine > theirs, 1).otherwise(0).alias("outperformed_btc_flag"),
    )


def rolling_metrics(returns: DataFrame) -> DataFrame:
    """Mean, deviation and count over the last 7, 14 and 30 rows, and growth since the first price.

    Every frame shares one partitioning and order: one sort, no further shuffle
    after ``daily_returns``.
    """
    by_day = series_window("asset_id", "data_date")
    columns = []
    for n in ROLLING_ROWS:
        frame = by_day.rowsBetween(-(n - 1), Window.currentRow)
        columns += [
            F.avg("daily_return").over(frame).alias(f"avg_return_{n}d"),
            F.stddev_samp("daily_return").over(frame).alias(f"volatility_{n}d"),
            F.count("daily_return").over(frame).alias(f"obs_count_{n}d"),
        ]
    # The first row of the running frame is the first row of the series.
    first = F.first("close_price").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return returns.select(
        "asset_id", "asset_name", "asset_type", "data_date", "close_price", "daily_return",
        *columns, first.alias("first_price"),
    ).withColumn("cumulative_return_from_start", F.try_divide(F.col("close_price"), F.col("first_price")) - 1)


def fct_rolling_metrics(rolling: DataFrame) -> DataFrame:
    return rolling.drop("first_price")


def data_gaps(prices: DataFrame, dates: DataFrame) -> DataFrame:
    """Days the asset's calendar expects, inside its own range, without a price.

    Candidates come from the intervals between observations, so the work is
    proportional to the gaps. ``detected_at`` is left to the caller.
    """
    kind, asset = F.col("asset_type"), F.col("asset_id")
    expected = (
        F.when(kind.isin("crypto", "fiat"), F.lit(1))
         .when(kind.isin("stock", "index"), F.col("is_us_trading_day"))
         .when((kind == "forex") & asset.like("%GBP%"), F.col("is_uk_trading_day"))
         .when((kind == "forex") & asset.like("%EUR%"), F.col("is_eu_trading_day"))
         .otherwise(F.col("is_us_trading_day"))
    )
    names = ["is_trading_day", "is_us_trading_day", "is_uk_trading_day", "is_eu_trading_day"]
    # The dimension has one row per calendar day, so the broadcast is bounded by the calendar.
    flags = dates.select(F.col("date").alias("missing_date"), *names)
    absent = missing_days(prices, "asset_id", "data_date", ["asset_type"])
    return (absent.withColumnRenamed("data_date", "missing_date").join(F.broadcast(flags), "missing_date")
                  .filter(expected == 1)
                  .select("asset_id", "asset_type", "missing_date", "is_trading_day"))


def failing_gaps(gaps: DataFrame) -> DataFrame:
    """All gaps that fail the build: crypto and forex always, equities on trading days."""
    kind = F.col("asset_type")
    return gaps.filter(kind.isin("crypto", "forex") | (kind.isin("stock", "index") & (F.col("is_trading_day") == 1)))


def critical_gaps(gaps: DataFrame, show: int = 100) -> DataFrame:
    """The first of the failing gaps, for display."""
    return failing_gaps(gaps).orderBy("asset_id", "missing_date").limit(show)
