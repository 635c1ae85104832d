"""The given tables seen as raw market data.

Orders are crypto price points (one coin per priority, several points a day),
line items are trades (one equity per brand, one currency pair per return
flag), events are audited batches and token swaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.functions.metrics import lookup
from bourse.operators.flatten import batch_key
from bourse.plans import core, staging

# --- fixed values: how the given codes map to assets ---------------------------
COINS = {"1-URGENT": "BTC", "2-HIGH": "ALT2", "3-MEDIUM": "ALT3", "4-NOT SPECIFIED": "ALT4", "5-LOW": "ALT5"}
PAIRS = {"A": "C:EURUSD", "N": "C:GBPUSD", "R": "C:JPYUSD"}
# Brand#24 is left out (class "unknown"), Brand#25 is an index.
EQUITIES = {f"Brand#{i}": (f"Brand {i}", "stock") for i in range(1, 24)} | {"Brand#25": ("Brand 25 Index", "index")}
HOLIDAYS = [
    (1, 1, "New Year's Day", "closed", "US"), (7, 4, "Independence Day", "closed", "US"),
    (12, 24, "Christmas Eve", "early_close", "US"), (12, 25, "Christmas Day", "closed", "US"),
    (1, 1, "New Year's Day", "closed", "UK"), (12, 25, "Christmas Day", "closed", "UK"),
    (12, 26, "Boxing Day", "closed", "UK"),
    (1, 1, "New Year's Day", "closed", "EU"), (5, 1, "Labour Day", "closed", "EU"),
    (12, 25, "Christmas Day", "closed", "EU"),
]
CASH_STAMP = "1970-01-01T00:00:00"
VALID_UP_TO = 200.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loaded_at(day):
    """Six in the morning after the day, as ISO text."""
    return F.concat(F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), F.lit("T06:00:00"))


def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    coin = lookup(F.col("o_orderpriority"), COINS, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        coin.alias("coin"), day.alias("data_date"), *map(F.expr, [
            "o_orderkey", "o_orderdate as data_timestamp", "o_totalprice as price_usd",
            "o_totalprice * 1000 as market_cap_usd", "cast(o_custkey as double) as volume_24h_usd"]),
        batch_key("coingecko", "market_chart", day, coin).alias("__batch_id"),
        loaded_at(day).alias("__ingested_at"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    coin = F.col("coin")
    return staging.benchmark_series(raw_series(spark, sf_dir), coin, F.concat(F.lit("Coin "), coin),
                                    tie_break=("o_orderkey",))


def _bars(trades: DataFrame, resource: str) -> DataFrame:
    """Daily bars of trades in (order, line, price) order.

    The order is one decimal and the traded value a count of cents: both are
    fixed-width, so the aggregation hashes instead of sorting, and cents add up
    exactly in any order.
    """
    order = F.expr("cast(l_orderkey * 8 + l_linenumber as decimal(20, 0)) * 1000000000000"
                   " + cast(price * 1000000 as bigint)")
    day = F.col("data_date")
    bars = trades.groupBy("ticker", "data_date").agg(
        F.min_by("price", order).alias("open"),
        F.max_by("price", order).alias("close"),
        *map(F.expr, ["max(price) as high", "min(price) as low", "sum(l_quantity) as volume",
                      "sum(cast(round(l_extendedprice * 100) as bigint)) as _cents"]),
    )
    return bars.select(
        "ticker", "data_date", "open", "high", "low", "close", "volume", F.expr("_cents / 100 / volume as vwap"),
        batch_key("massive", resource, day, F.col("ticker")).alias("__batch_id"),
        loaded_at(day).alias("__ingested_at"))


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", "l_extendedprice",
        "to_date(l_shipdate) as data_date", "l_extendedprice / l_quantity as price")


def raw_bars(spark: SparkSession, sf_dir: str, trades: DataFrame | None = None) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_brand as ticker")
    trades = _trades(spark, sf_dir) if trades is None else trades
    return _bars(trades.join(parts, trades["l_partkey"] == parts["p_partkey"]), "stocks")


def raw_rates(spark: SparkSession, sf_dir: str, trades: DataFrame | None = None) -> DataFrame:
    ticker = lookup(F.col("l_returnflag"), PAIRS, F.col("l_returnflag"))
    trades = _trades(spark, sf_dir) if trades is None else trades
    return _bars(trades.withColumn("ticker", ticker), "forex").drop("vwap")


def bars(spark: SparkSession, sf_dir: str, trades: DataFrame | None = None) -> DataFrame:
    return staging.stock_bars(raw_bars(spark, sf_dir, trades), EQUITIES)


def rates(spark: SparkSession, sf_dir: str, trades: DataFrame | None = None) -> DataFrame:
    return staging.rate_bars(raw_rates(spark, sf_dir, trades))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _trades(spark, sf_dir)
    return core.unified_prices(series(spark, sf_dir), bars(spark, sf_dir, trades), rates(spark, sf_dir, trades),
                               cash_ingested_at=F.lit(CASH_STAMP))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed holidays in every year with orders."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    days = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(name).alias("holiday_name"),
                              F.lit(status).alias("market_status"), F.lit(code).alias("market_code"))
                     for m, d, name, status, code in HOLIDAYS])
    return years.select("y", F.inline(days)).select(
        F.make_date("y", "m", "d").alias("holiday_date"), "holiday_name", "market_status", "market_code")


def dates(spark: SparkSession, sf_dir: str, priced: DataFrame | None = None) -> DataFrame:
    """The date dimension; sharing ``priced`` lets both sides reuse its shuffles."""
    return core.dim_dates(prices(spark, sf_dir) if priced is None else priced, holidays(spark, sf_dir))


def ledger(spark: SparkSession, sf_dir: str, limit: float = VALID_UP_TO) -> DataFrame:
    """One audit per event type and day: valid while no value exceeds ``limit``."""
    day = F.to_date("ts")
    worst = F.max("value")
    batches = table(spark, sf_dir, "events").groupBy("event_type", day.alias("day")).agg(
        worst.alias("worst"), F.max("ts").alias("created_at"))
    ok = F.col("worst") <= limit
    failed = F.struct(F.lit("value_bound").alias("name"), F.lit("fail").alias("outcome"),
                      F.concat(F.lit("max "), F.col("worst").cast("string")).alias("diagnostic"))
    return batches.select(
        batch_key("events", F.col("event_type"), F.col("day")).alias("batch_id"),
        F.lit("events").alias("source"), F.col("event_type").alias("resource"),
        F.col("day").cast("timestamp").alias("data_interval_start"),
        F.date_add("day", 1).cast("timestamp").alias("data_interval_end"),
        ok.alias("is_valid"),
        F.when(ok, 2).otherwise(1).alias("checks_passed"), F.when(ok, 0).otherwise(1).alias("checks_failed"),
        F.when(ok, F.array().cast("array<struct<name:string,outcome:string,diagnostic:string>>"))
         .otherwise(F.array(failed)).alias("failed_checks"),
        F.col("created_at"),
    )


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run and step events: one run per event type and day, two steps each.

    A run whose worst value exceeds 300 has not ended; one above the ledger's
    limit failed in its second step.
    """
    runs = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.max("value").alias("worst"))
    run_id = batch_key("run", F.col("event_type"), F.col("day"))
    none = F.lit(None).cast("string")
    final = F.when(F.col("worst") > VALID_UP_TO, "FAILED").otherwise("SUCCESS")

    def change(step, status, at, when=None):
        entry = F.struct(step.alias("step_name"), status.alias("status"), at.alias("at"))
        return entry if when is None else F.when(when, entry)

    ended = F.col("worst") <= 300
    running = F.lit("RUNNING")
    changes = F.array_compact(F.array(
        change(none, running, F.col("t0")),
        change(F.lit("extract"), running, F.col("t0")),
        change(F.lit("extract"), F.lit("SUCCESS"), F.col("t1")),
        change(F.lit("validate"), running, F.col("t1")),
        change(F.lit("validate"), final, F.col("t1"), ended),
        change(none, final, F.col("t1"), ended),
    ))
    return runs.select(
        run_id.alias("run_id"), batch_key("events", F.col("event_type"), F.col("day")).alias("batch_id"),
        F.lit("events").alias("source"), F.col("event_type").alias("resource"), F.inline(changes),
        none.alias("metadata"))


def swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as swaps: raw integer amounts as text, taker and sender."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.round(F.col("value") * 1_000_000).cast("bigint").cast("string").alias("amount0_in"),
        F.concat(F.col("user_id").cast("string"), F.lit("000000000000007")).alias("amount1_in"),
        F.col("event_id").cast("string").alias("amount0_out"),
        F.concat(F.col("event_id").cast("string"), F.repeat(F.lit("0"), F.lit(60))).alias("amount1_out"),
        F.col("user_id").alias("taker"), (F.col("user_id") % 100).alias("tx_from"), "event_type")
