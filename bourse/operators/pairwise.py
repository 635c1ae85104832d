"""Correlation of every pair of series from summed moments.

A self-join on the date would emit every pair of series for every day. Here rows meet in groups of two blocks of series
and a chunk of days. A group is a dense matrix of at most ``block_size`` by ``days_per_chunk`` cells a side, whatever
the length of the histories or the span of the days; matrix products give, for each pair, the number of common days and
the sums of values, squares and products. Spark adds the moments of a pair over the chunks.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ship these functions with the task: workers need NumPy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_SCHEMA = "a string, b string, " + ", ".join(f"{c} double" for c in _SUMS)


def _dense(rows: pd.DataFrame, days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Series names and their values by day, NaN where there is none."""
    names, at = np.unique(rows["series"].to_numpy(str), return_inverse=True)
    out = np.full((len(names), len(days)), np.nan)
    column = np.searchsorted(days, rows["day"].to_numpy())
    if len(np.unique(at.astype(np.int64) * len(days) + column)) < len(rows):
        raise ValueError("correlation needs one row per series and day")
    out[at, column] = rows["v"].to_numpy()
    return names, out


def _moments(group: pd.DataFrame) -> pd.DataFrame:
    """Moments of the pairs of a group: all ordered pairs of one block, or left with right of two."""
    i, j = int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
    days = np.unique(group["day"].to_numpy())
    left, x = _dense(group[group["block"] == i], days)
    right, y = (left, x) if i == j else _dense(group[group["block"] == j], days)
    mx, my = ~np.isnan(x), ~np.isnan(y)
    x, y = np.where(mx, x, 0.0), np.where(my, y, 0.0)
    mx, my = mx.astype(float), my.astype(float)
    sums = (mx @ my.T, x @ my.T, mx @ y.T, (x * x) @ my.T, mx @ (y * y).T, x @ y.T)
    rows, columns = np.nonzero(sums[0])
    return pd.DataFrame({"a": left[rows], "b": right[columns], **{c: s[rows, columns] for c, s in zip(_SUMS, sums)}})


def correlation_matrix(df: DataFrame, key: str, date: str, value: str, label: str | None = None,
                       block_size: int = 256, blocks: int | None = None, days_per_chunk: int = 512) -> DataFrame:
    """All ordered pairs (self included) with a defined correlation on their common days.

    ``df`` has one row per (key, date), which is enforced; rows without a number are left out. ``blocks`` saves counting
    the series where their number is known. Values are shifted by the series mean, which leaves correlation unchanged;
    a variance within the rounding of its sums counts as none.
    """
    v = F.col(value).cast("double")
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    observed = df.filter(v.isNotNull() & ~F.isnan(v)).select(
        F.col(key).alias("series"), day.alias("day"), v.alias("v"), F.col(label or key).alias("label"))
    about = observed.groupBy("series").agg(F.avg("v").alias("m"), F.max("label").alias("label"))
    if blocks is None:
        # A scalar subquery: it runs with the query, not while the plan is built.
        # A rough count will do, so rows without a value need not be left out.
        wanted = F.greatest(F.lit(1), F.ceil(F.approx_count_distinct(key) / block_size)).cast("int")
        n_blocks = df.agg(wanted).scalar()
    else:
        n_blocks = F.lit(blocks)
    block = F.pmod(F.xxhash64("series"), n_blocks).cast("int")
    # Each row joins one group per block: blocks, not series, are paired.
    placed = observed.drop("label").join(about.select("series", "m"), "series").select(
        "series", "day", (F.col("v") - F.col("m")).alias("v"), block.alias("block"),
        F.floor(F.col("day") / days_per_chunk).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("other"))
    paired = placed.select("series", "day", "v", "block", "chunk", F.least("block", "other").alias("bi"),
                           F.greatest("block", "other").alias("bj"))
    sums = paired.groupBy("bi", "bj", "chunk").applyInPandas(_moments, _SCHEMA).groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in _SUMS])
    n, sx, sy, sxx, syy, sxy = map(F.col, _SUMS)
    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
    rounding = F.lit(4 * sys.float_info.epsilon) * n
    defined = sums.filter((n > 1) & (vx > rounding * sxx) & (vy > rounding * syy)).select(
        "a", "b", ((sxy - sx * sy / n) / F.sqrt(vx * vy)).alias("correlation"), n.cast("bigint").alias("observation_count"))
    named = about.select("series", "label")
    left = named.select(F.col("series").alias("a"), F.col("label").alias("a_label"))
    right = named.select(F.col("series").alias("b"), F.col("label").alias("b_label"))
    labelled = defined.join(left, "a").join(right, "b").select(
        "a", "a_label", "b", "b_label", "correlation", "observation_count")
    # Pairs of one block appear both ways round already.
    across = F.pmod(F.xxhash64("a"), n_blocks) != F.pmod(F.xxhash64("b"), n_blocks)
    turned = F.struct(F.col("b").alias("a"), F.col("b_label").alias("a_label"), F.col("a").alias("b"),
                      F.col("a_label").alias("b_label"), "correlation", "observation_count")
    own = F.struct("a", "a_label", "b", "b_label", "correlation", "observation_count")
    return labelled.select(F.inline(F.when(across, F.array(own, turned)).otherwise(F.array(own))))
