"""The published ("bronze") table: staged write, partition publish, scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.contracts import AUDIT_COLUMNS, Contract


def typed(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns in contract order with contract types.

    Types are never inferred: files of one table must agree, and Spark cannot
    merge integer with double files afterwards.
    """
    return df.select(*typed_columns(contract))


def typed_columns(contract: Contract) -> list[Column]:
    return [F.col(c).cast(t).alias(c) for c, t in contract.record_types.items()]


# File moves go through Hadoop's file system, which a classic session reaches and Spark Connect does not.

def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def staging_path(root: str, batch: str) -> str:
    """Outside the table tree, so no table scan can meet an unaudited batch."""
    return f"{root.rstrip('/')}/_staging/{batch}"


def failed_path(root: str, batch: str) -> str:
    """Where a batch that failed its audit is kept as evidence."""
    return staging_path(root, f"failed/{batch}")


def rejected_path(root: str, contract: Contract, batch: str) -> str:
    return f"{root.rstrip('/')}/_rejected/source={contract.source}/resource={contract.resource}/{batch}"


def unreadable_path(root: str, contract: Contract, batch: str) -> str:
    return f"{root.rstrip('/')}/_unreadable/source={contract.source}/resource={contract.resource}/{batch}"


def table_path(root: str, contract: Contract) -> str:
    return f"{root.rstrip('/')}/bronze/source={contract.source}/resource={contract.resource}"


class EmptyBatch(ValueError):
    """There is nothing to stage."""


def stage(records: DataFrame, root: str, batch: str, contract: Contract, allow_empty: bool = False,
          also: tuple[str, ...] = ()) -> DataFrame:
    """Write the batch aside and return it as read back, with the columns ``also`` beside the contract's.

    Audit and publication read the staged files, so the batch is computed once
    and survives lost executors. A failed write leaves nothing behind.
    """
    spark = records.sparkSession
    path = staging_path(root, batch)
    shaped = records.select(*typed_columns(contract), *also)
    try:
        shaped.write.mode("overwrite").parquet(path)
        staged = spark.read.schema(shaped.schema).parquet(path)
        if not allow_empty and staged.isEmpty():
            raise EmptyBatch(f"no records to write for {batch}")
        return staged
    except Exception:
        _delete(spark, path)
        raise


def drop_staged(spark: SparkSession, root: str, batch: str) -> None:
    _delete(spark, staging_path(root, batch))


def keep_failed(spark: SparkSession, root: str, batch: str) -> str:
    """Move a staged batch aside; an older failure of the same batch gives way. Raises if the move fails."""
    target = failed_path(root, batch)
    _delete(spark, target)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    if not system.rename(path(staging_path(root, batch)), path(target)):
        # The staged files are the only evidence of the failure: a cleanup after this must not find them gone.
        raise OSError(f"could not move the staged batch {batch} to {target}")
    return target


def publish(records: DataFrame, root: str, contract: Contract) -> None:
    """Replace exactly the partitions present in ``records``.

    Rebalancing on the partition keys gathers small partitions into few files
    and lets the engine split a partition that is too large for one task.
    """
    keys = contract.partition_keys
    if not keys:
        raise ValueError("the contract names no partition key")
    (typed(records, contract).hint("rebalance", *keys)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(table_path(root, contract)))


def read_published(spark: SparkSession, root: str, contract: Contract, discover: bool = False) -> DataFrame:
    """The published table, columns matched by name over all files.

    Contract columns a file lacks are null; partition filters prune
    directories. The contract is the schema, so no file is opened to plan the
    scan; ``discover`` reads every footer to add columns beyond the contract.
    """
    types = contract.record_types
    if discover:
        scanned = spark.read.option("mergeSchema", True).parquet(table_path(root, contract))
        known = [F.col(c).cast(t).alias(c) for c, t in types.items() if c in set(scanned.columns)]
        return scanned.select(*known, *[c for c in scanned.columns if c not in types])
    schema = ", ".join(f"`{c}` {t}" for c, t in types.items())
    return spark.read.schema(schema).parquet(table_path(root, contract)).select(*types)


def _folder_value(key: str) -> Column:
    """The text of a partition key in a file's path: values are never guessed to be numbers."""
    raw = F.regexp_extract("path", f"/{key}=([^/]*)/", 1)
    value = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(~raw.isin("", "__HIVE_DEFAULT_PARTITION__"), value)


def existing_dates(spark: SparkSession, root: str, contract: Contract, ticker: str | None = None) -> DataFrame:
    """Days already published, per ticker where the contract has one.

    Keys come from the contract, so a table partitioned by day alone is found
    by day alone. Only the file listing is used: one row per file, no content.
    """
    keys = contract.partition_keys
    types = contract.record_types
    if not _exists(spark, table_path(root, contract)):
        return spark.createDataFrame([], ", ".join(f"{k} {types[k]}" for k in keys))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
             .load(table_path(root, contract)))
    found = files.select(*[_folder_value(k).try_cast(types[k]).alias(k) for k in keys])
    if ticker is not None and "ticker" in keys:
        found = found.filter(F.col("ticker") == ticker)
    # A directory whose name is no date gives a null key and is skipped.
    return found.dropna().distinct()


def write_model(df: DataFrame, root: str, layer: str, name: str, sort_within: tuple[str, ...] = (),
                buckets: int | None = None) -> DataFrame:
    """Materialise a model at ``<root>/<layer>/<name>.parquet`` and read it back.

    With ``buckets`` the rows are hashed by the first sort column into that many
    files and registered as table ``<layer>_<name>``: windows, aggregations and
    joins on that column then read co-located rows and need no shuffle.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{layer}/{name}.parquet"
    if buckets:
        key, *order = sort_within
        writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order)
        writer.option("path", path).saveAsTable(f"{layer}_{name}")
        return spark.table(f"{layer}_{name}")
    # Clustered rows make the row-group statistics selective for later filters.
    shaped = df.sortWithinPartitions(*sort_within) if sort_within else df
    shaped.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


__all__ = ["AUDIT_COLUMNS", "EmptyBatch", "drop_staged", "existing_dates", "failed_path", "keep_failed", "publish",
           "read_published", "rejected_path", "stage", "staging_path", "table_path", "typed", "unreadable_path", "write_model"]
