"""The common price table and the star schema on top of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse import fixed_values as fv
from bourse.functions.metrics import day_of_week, is_weekend, lookup
from bourse.operators.fill import carry_forward

# Column order and types of the common price table.
PRICE_COLUMNS = {
    "asset_id": "string", "asset_name": "string", "asset_type": "string", "data_date": "date",
    "close_price": "double", "open_price": "double", "high_price": "double", "low_price": "double",
    "volume": "double", "vwap": "double", "market_cap_usd": "double", "volume_usd": "double",
    "__batch_id": "string", "__ingested_at": "string",
}


def utc_text(instant: str) -> Column:
    """An instant as ISO text in UTC, whatever the session zone."""
    return F.expr(f"""date_format(to_utc_timestamp({instant}, current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")""")


def _conform(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    if dict(df.dtypes).get("__ingested_at") == "timestamp":
        df = df.withColumn("__ingested_at", utc_text("__ingested_at"))
    return df.selectExpr(*[
        f"cast({f'`{c}`' if c in present else 'null'} as {t}) as `{c}`" for c, t in PRICE_COLUMNS.items()])


def _with_cash(series: DataFrame, benchmark: str, ingested_at: Column) -> DataFrame:
    """Add a cash row at 1.0 beside every benchmark row.

    The benchmark's days are the master calendar. Emitting both rows from one
    scan avoids reading the series twice.
    """
    cash = {
        "asset_id": f"'{fv.CASH_ID}'", "asset_name": f"'{fv.CASH_NAME}'", "asset_type": "'fiat'",
        "data_date": "data_date", "close_price": "1.0D", "open_price": "1.0D", "high_price": "1.0D",
        "low_price": "1.0D", "volume": "0.0D", "__batch_id": "'synthetic'", "__ingested_at": "_cash_stamp",
    }
    own = ", ".join(f"`{c}`" for c in PRICE_COLUMNS)
    beside = ", ".join(f"cast({cash.get(c, 'null')} as {t}) as `{c}`" for c, t in PRICE_COLUMNS.items())
    rows = F.when(F.col("asset_id") == benchmark, F.expr(f"array(struct({own}), struct({beside}))"))
    return series.withColumn("_cash_stamp", ingested_at).select(F.inline(rows.otherwise(F.expr(f"array(struct({own}))"))))


def unified_prices(series: DataFrame, bars: DataFrame | None = None, rates: DataFrame | None = None,
                   benchmark: str = fv.BENCHMARK_ID, cash_ingested_at: Column | None = None) -> DataFrame:
    """Benchmark series, equity bars, currency rates and cash in one table.

    ``series`` holds one row per (asset, day), as staging leaves it.
    """
    stamp = utc_text("current_timestamp()") if cash_ingested_at is None else cash_ingested_at
    parts = [_with_cash(_conform(series), benchmark, stamp)]
    parts += [_conform(p) for p in (bars, rates) if p is not None]
    return reduce(DataFrame.unionByName, parts)


def class_position(column="asset_type"):
    return lookup(F.col(column), fv.CLASS_ORDER, F.lit(len(fv.CLASS_ORDER) + 1))


def dim_assets(prices: DataFrame) -> DataFrame:
    """Distinct assets. Order with ``sorted_assets`` where rows are shown."""
    return prices.select("asset_id", "asset_name", "asset_type").distinct()


def asset_order() -> list[Column]:
    return [class_position(), F.col("asset_id")]


def sorted_assets(assets: DataFrame) -> DataFrame:
    return assets.orderBy(*asset_order())


def _closed_days(holidays: DataFrame) -> DataFrame:
    """One row per closed day with a flag per market."""
    return (holidays.filter(F.col("market_status") == "closed")
            .groupBy(F.col("holiday_date").alias("date"))
            .agg(*[F.bool_or(F.col("market_code") == code).alias(f"_closed_{code.lower()}") for code in fv.HOLIDAYS]))


def dim_dates(prices: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per observed day: calendar parts and trading flags per market."""
    days = prices.select(F.col("data_date").alias("date")).distinct()
    date = F.col("date")

    def open_in(code: str):
        shut = is_weekend(date) | F.coalesce(F.col(f"_closed_{code}"), F.lit(False))
        return F.when(shut, F.lit(0)).otherwise(F.lit(1))

    # The closed days are few; the planner broadcasts them by their size.
    parts = [f"cast({part}(date) as bigint)" for part in ("year", "month", "day", "quarter", "dayofyear")]
    year, month, day, quarter, day_of_year = map(F.expr, parts)
    return days.join(_closed_days(holidays), "date", "left").select(
        "date",
        year.alias("year"), month.alias("month"), day.alias("day"),
        day_of_week(date).alias("day_of_week"),
        quarter.alias("quarter"), day_of_year.alias("day_of_year"),
        open_in("us").alias("is_trading_day"),
        open_in("us").alias("is_us_trading_day"),
        open_in("uk").alias("is_uk_trading_day"),
        open_in("eu").alias("is_eu_trading_day"),
        F.when(day_of_year == 1, 1).otherwise(0).alias("is_year_start"),
        F.date_format(date, "yyyy-MM").alias("year_month"),
        F.concat(F.date_format(date, "yyyy"), F.lit("-Q"), quarter.cast("string")).alias("year_quarter"),
    )


def daily_prices(prices: DataFrame, dates: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Forward-filled prices on every observed calendar day.

    Price, batch and load time are carried independently. With ``assets`` the
    names come from that dimension and unknown assets are dropped.
    """
    names = ["asset_name", "asset_type"]
    source = prices.select("asset_id", *names, "data_date", "close_price", "__batch_id", "__ingested_at")
    if assets is not None:
        source = source.drop(*names)
    filled = carry_forward(source, "asset_id", "data_date", "close_price", ["__batch_id", "__ingested_at"],
                           dates, "date")
    if assets is not None:
        filled = filled.join(assets.select("asset_id", *names), "asset_id")
    return filled.select("asset_id", *names, "data_date", "close_price", "price_source", "__batch_id", "__ingested_at")


def fct_daily_returns(returns: DataFrame) -> DataFrame:
    return returns.select("asset_id", "asset_name", "asset_type", "data_date", "close_price", "daily_return",
                          "__batch_id", "__ingested_at")
