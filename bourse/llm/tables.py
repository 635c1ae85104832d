"""Written intermediate tables in the shared folder; they cut lineage and survive lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from bourse.session import shared_folder


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write a frame once and read it back."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession, factor: int = 1) -> int:
    """How many parts packed groups are dealt into: it follows the session's shuffle partitions, which follow the data."""
    return max(1, factor * int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def bucketed(df: DataFrame, purpose: str, key: str, buckets: int) -> Iterator[DataFrame]:
    """Write a frame as a table in hash buckets of a long column, for groups and cogroups by it that shuffle no row.

    Rows are not moved to write it: a task writes one file a bucket its keys fall in, so it should take them from
    `keys_of_bucket`. At the end of the block the table and its files go."""
    spark = df.sparkSession
    path, name = shared_folder(spark, purpose), f"{purpose}_{uuid.uuid4().hex}".replace("-", "_")
    try:
        df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def long_hashes(values: np.ndarray) -> np.ndarray:
    """Spark's ``hash`` of longs: Murmur3 with seed 42."""
    u = np.uint32
    bits = values.astype(np.int64).view(np.uint64)
    state = np.full(len(bits), 42, u)
    for word in (bits.astype(u), (bits >> np.uint64(32)).astype(u)):
        word = word * u(0xCC9E2D51)
        word = ((word << u(15)) | (word >> u(17))) * u(0x1B873593)
        state ^= word
        state = ((state << u(13)) | (state >> u(19))) * u(5) + u(0xE6546B64)
    state ^= u(8)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        state = (state ^ (state >> u(shift))) * u(factor)
    return (state ^ (state >> u(16))).view(np.int32)


def keys_of_bucket(task: int, buckets: int) -> Iterator[int]:
    """Longs that no other task gets and that Spark puts into one bucket, the task's number modulo the buckets."""
    for begin in range(0, 1 << 32, 8 * buckets):
        keys = (task << 32) + begin + np.arange(8 * buckets)
        yield from keys[long_hashes(keys) % buckets == task % buckets].tolist()
