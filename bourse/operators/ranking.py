"""Ranking over a whole frame without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def _ranged(counted: DataFrame, within: list[str]) -> DataFrame:
    """Distinct values in parts of about equal size, numbered ``_b`` in rank order within each group.

    The parts come from range partitioning, whose splitters Spark samples from
    the values and samples again where a part came out too large, so dense
    values (millions within a tiny interval) spread over tasks as well as sparse
    ones do. A part is a set of rows of one shuffle output, so every branch that
    reads the exchange sees the same number for a row. The part count is given
    (the session's shuffle partitions), so adaptive execution does not coalesce
    the reads of the branches differently.
    """
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (counted.repartitionByRange(parts, *within, F.col("_v").desc_nulls_last())
            .withColumn("_b", F.spark_partition_id()))


def rank_descending(df: DataFrame, value: str, within: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """``rank()`` by ``value`` descending, nulls last (NaN first, as Spark orders it), per ``within`` group.

    Equal values are counted before any shuffle, so a hot value is one row.
    Distinct values are range partitioned on sampled splitters and ranked inside
    their part; part totals (one row per part and group) are accumulated to
    offset them. The ranks join back on the value, where the planner can split a
    hot value over tasks. Empty input gives empty output.
    """
    within = list(within)
    counted = df.groupBy(*within, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = _ranged(counted, within)
    group = [F.lit(0)] if not within else [F.col(c) for c in within]
    totals = ranged.groupBy(*within, "_b").agg(F.sum("_n").alias("_n")).select(
        *within, "_b",
        F.coalesce(F.sum("_n").over(
            Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_offset"))
    inner = F.coalesce(F.sum("_n").over(
        Window.partitionBy(*within, "_b").orderBy(F.col("_v").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = (ranged.withColumn("_inner", inner)
             .join(totals, [*within, "_b"])
             .select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(within)], "_v",
                     (F.col("_offset") + F.col("_inner") + 1).alias(name)))
    same = F.col(value).eqNullSafe(F.col("_v"))
    for i, c in enumerate(within):
        same = same & (df[c] == F.col(f"_k{i}"))
    return df.join(ranks, same).drop("_v", *[f"_k{i}" for i in range(len(within))])


def numbered(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """``row_number()`` over the whole frame in ``order`` (which must break all ties), without gathering it in one task.

    Rows are range partitioned by splitters sampled from the keys and sorted
    inside their part; an id increasing within each part gives the local
    number. Only the row count of each part (one row a part, bounded by the
    partition count, not by the data) is gathered to form the offsets, which
    join back by broadcast.
    """
    ids = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright(F.col("_id"), 33)
    counts = ids.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    local = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return (ids.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_offset") + local + 1).cast("int")).drop("_id", "_part", "_offset"))
