"""Which days still have to be loaded."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.operators.fill import day_range


def missing_loads(requested: DataFrame, existing: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Requested (key, day) rows not present yet.

    ``requested`` has the keys besides ``data_date`` plus ``start_date`` and
    ``end_date`` (both included). An empty result means the load is skipped;
    ``force`` asks for everything.
    """
    others = [k for k in keys if k != "data_date"]
    wanted = requested.select(*others, F.explode(day_range(F.col("start_date"), F.col("end_date"))).alias("data_date"))
    return wanted if force else wanted.join(existing.select(*keys).distinct(), keys, "left_anti")


def window_request(spark, start: date, end: date, tickers: list[str] | None = None) -> DataFrame:
    """One requested range, for one series or for a list of tickers."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("start_date"), F.lit(end).cast("date").alias("end_date"))
    if tickers is None:
        return span
    return span.withColumn("ticker", F.explode(F.array(*map(F.lit, tickers))))
