"""Small numeric and calendar expressions shared by the models."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from bourse.fixed_values import TRADING_DAYS_PER_YEAR


def change(new: Column, old: Column) -> Column:
    """Relative change; null when the old value is null, zero or negative."""
    return F.when(old > 0, (new - old) / old)


def annualised(volatility: Column) -> Column:
    return volatility * F.sqrt(F.lit(TRADING_DAYS_PER_YEAR))


def growth(end: Column, start: Column) -> Column:
    """``end / start - 1`` without raising on a zero start."""
    return F.try_divide(end, start) - 1


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def lookup(key: Column, table: dict, default: Column) -> Column:
    """A literal map lookup for code tables of a handful of entries."""
    if not table:
        return default
    entries = F.expr(f"map({', '.join(map(_literal, chain.from_iterable(table.items())))})")
    return F.coalesce(F.try_element_at(entries, key), default)


def day_of_week(date: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(date) - 1).cast("bigint")


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def period_start(end: Column, days: int | None) -> Column:
    """``days`` before ``end``; None means the first day of that year."""
    return F.trunc(end, "year") if days is None else F.date_sub(end, days)
