"""Published tables to one clean row per asset and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse import fixed_values as fv
from bourse.functions.metrics import lookup

LINEAGE = ("__batch_id", "__ingested_at")


def _valid(df: DataFrame) -> DataFrame:
    # NaN compares above every number, so it is named.
    return df.filter("data_date is not null and close_price > 0 and not isnan(close_price) and asset_id is not null")


def benchmark_series(raw: DataFrame, asset_id: Column | None = None, asset_name: Column | None = None,
                     tie_break: tuple[str, ...] = ("__ingested_at",)) -> DataFrame:
    """Latest point of each day of a crypto series.

    The latest row decides first and is dropped afterwards if its price is not
    positive. Each task keeps one row per day before the shuffle.
    """
    asset_id = F.lit(fv.BENCHMARK_ID) if asset_id is None else asset_id
    asset_name = F.lit(fv.BENCHMARK_NAME) if asset_name is None else asset_name
    present = set(raw.columns)
    newest_first = Window.partitionBy(asset_id, "data_date").orderBy(
        F.desc_nulls_last("data_timestamp"), *[F.desc_nulls_last(c) for c in tie_break])
    latest = raw.withColumn("_rn", F.row_number().over(newest_first)).filter("_rn = 1")
    lineage = [c if c in present else f"cast(null as string) as {c}" for c in LINEAGE]
    return _valid(latest.select(asset_id.alias("asset_id"), asset_name.alias("asset_name"), *map(F.expr, [
        "data_date", "data_timestamp", "price_usd as close_price", "market_cap_usd", "volume_24h_usd as volume_usd",
        "'crypto' as asset_type", *lineage])))


_BAR = ["data_date", "close as close_price", "open as open_price", "high as high_price", "low as low_price", "volume",
        *LINEAGE]


def stock_bars(raw: DataFrame, equities: dict | None = None) -> DataFrame:
    """Daily equity bars; tickers outside the table keep their code, class ``unknown``."""
    equities = fv.EQUITIES if equities is None else equities
    ticker = F.col("ticker")
    return _valid(raw.select(
        ticker.alias("asset_id"), *map(F.expr, _BAR), "vwap",
        lookup(ticker, {k: v[1] for k, v in equities.items()}, F.lit("unknown")).alias("asset_type"),
        lookup(ticker, {k: v[0] for k, v in equities.items()}, ticker).alias("asset_name"),
    ))


def rate_bars(raw: DataFrame, pairs: dict | None = None) -> DataFrame:
    """Daily currency rates; the id is the pair code without ``C:`` and ``USD``."""
    pairs = fv.RATE_PAIRS if pairs is None else pairs
    ticker = F.col("ticker")
    stripped = F.expr("replace(replace(ticker, 'C:', ''), 'USD', '')")
    return _valid(raw.select(
        lookup(ticker, {k: v[0] for k, v in pairs.items()}, stripped).alias("asset_id"),
        *map(F.expr, [*_BAR, "'fiat' as asset_type", "ticker as raw_ticker"]),
        lookup(ticker, {k: v[1] for k, v in pairs.items()}, ticker).alias("asset_name"),
    ))
