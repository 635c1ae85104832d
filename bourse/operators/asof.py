"""As-of lookups as conditional aggregates.

A lookup at k targets is k expressions in one ``groupBy``: values are combined
before the shuffle and no range join is planned, so a hot key costs one row per
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_on_or_after(value: Column, order: Column, target: Column) -> Column:
    """Value of the earliest row at or after ``target``."""
    return F.min_by(value, F.when(order >= target, order))


def last_on_or_before(value: Column, order: Column, target: Column) -> Column:
    """Value of the latest row at or before ``target``."""
    return F.max_by(value, F.when(order <= target, order))


def filled_on(value: Column, order: Column, day: Column) -> Column:
    """First forward-filled value at or after calendar day ``day``.

    That is the value carried into the day, or, for a series that starts
    later, its first value. The filled table itself is never built.
    """
    return F.coalesce(last_on_or_before(value, order, day), F.min_by(value, order))


def calendar_index(calendar: DataFrame, date: str) -> DataFrame:
    """One row: ``days``, the sorted distinct calendar days, and ``max_date``, the last one.

    Its size is bounded by the calendar (one entry a day), not by the rows of
    the source, so the row may be broadcast to every task of a large table.
    The days are combined before the shuffle: each task sends its own set.
    """
    day = F.col(date)
    return calendar.where(day.isNotNull()).agg(F.sort_array(F.collect_set(day)).alias("days"), F.max(day).alias("max_date"))


def _first_at_or_after(days: Column, target: Column) -> Column:
    return F.try_element_at(F.filter(days, lambda d: d >= target), F.lit(1))


def anchored(rows: DataFrame, index: DataFrame, targets: list[Column], names: list[str], date: str = "data_date") -> DataFrame:
    """``rows`` with one constant column a target: the first calendar day at or after it.

    Targets may refer to ``max_date``. Each anchor is a search in the index's
    sorted day array, evaluated once on its single row; the row joins every
    task by broadcast, so the source is not scanned once per anchor.
    """
    found = index.select(F.datediff("max_date", "max_date").alias("_anchors"),
                         *[_first_at_or_after(F.col("days"), target).alias(name) for name, target in zip(names, targets)])
    # An equi-join of one broadcast row, where a key-less join would loop over pairs. A literal key would be folded
    # away, so the key is a day's distance to itself on both sides: 0 for every dated row; undated rows, and all rows
    # of an empty calendar, keep null anchors.
    key = F.datediff(F.col(date), F.col(date)).alias("_anchors")
    return rows.withColumn("_anchors", key).join(F.broadcast(found), "_anchors", "left").drop("_anchors")
