"""Forward fill and gap detection by intervals.

Each observation owns the days up to the next one. Filling emits those days,
gap detection emits the days in between; both cost one sort per series plus
their own output, with no series-by-calendar product.

Series tables hold one row per (series, day), so a window over one series is
bounded by the number of calendar days however large the table is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_window(key: str, date: str):
    return Window.partitionBy(key).orderBy(date)


def carry_forward(df: DataFrame, key: str, date: str, value: str, carried: list[str], calendar: DataFrame,
                  calendar_date: str, source: str = "price_source") -> DataFrame:
    """Last observation carried forward onto every calendar day.

    ``value`` and the ``carried`` columns are filled independently. Rows before
    the first value are dropped. ``source`` says OBSERVED or IMPUTED.
    """
    order = series_window(key, date)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = calendar.select(F.col(calendar_date).alias(date)).distinct()
    last_day = days.agg(F.max(date)).scalar()

    filled = df.select(
        key, F.col(date).alias("_from"),
        *[c for c in df.columns if c not in (key, date, value, *carried)],
        F.col(value).isNotNull().alias("_observed"),
        *[F.last(c, ignorenulls=True).over(running).alias(c) for c in (value, *carried)],
        F.coalesce(F.date_sub(F.lead(date).over(order), 1), last_day).alias("_to"),
    ).filter(F.col(value).isNotNull())
    spread = filled.withColumn(
        date, F.explode(F.sequence("_from", F.greatest("_from", "_to"))))
    labelled = spread.withColumn(
        source, F.when(F.col("_observed") & (F.col(date) == F.col("_from")), "OBSERVED").otherwise("IMPUTED"))
    # Distinct days: one 4-byte value per calendar day, whatever the table's size.
    return labelled.drop("_from", "_to", "_observed").join(F.broadcast(days), date, "left_semi")


def missing_days(df: DataFrame, key: str, date: str, keep: list[str]) -> DataFrame:
    """Days strictly between neighbouring observations of each series."""
    following = F.lead(date).over(series_window(key, date))
    return (df.select(key, *keep, F.col(date).alias("_from"), following.alias("_next"))
              .filter(F.col("_next") > F.date_add("_from", 1))
              .select(key, *keep, F.explode(F.sequence(F.date_add("_from", 1), F.date_sub("_next", 1))).alias(date)))


def day_range(start: Column, end: Column) -> Column:
    """Every day from ``start`` to ``end``, both included; none when reversed."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
