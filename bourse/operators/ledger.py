"""Quality ledger, run state and lineage over append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILED_CHECKS = "array<struct<name:string,outcome:string,diagnostic:string>>"
_IDENTITY = ("source", "resource", "data_interval_start", "data_interval_end")
_OUTCOME = ("is_valid", "checks_passed", "checks_failed", "failed_checks", "created_at")


def current_results(results: DataFrame, age: Column | None = None) -> DataFrame:
    """Every batch once, from an append-only table of its audits.

    Identity columns are those of the first audit, outcome columns those of the
    last. Rows are combined before the shuffle.
    """
    age = F.col("created_at") if age is None else age
    folded = results.groupBy("batch_id").agg(
        F.min_by(F.struct(*_IDENTITY), age).alias("first"), F.max_by(F.struct(*_OUTCOME), age).alias("last"))
    return folded.select("batch_id", "first.*", "last.*")


def upsert_results(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """The ledger after inserting ``new`` by ``batch_id``; ``new`` wins whatever its time."""
    both = ledger.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return current_results(both, F.struct("_new", "created_at"))


def append(rows: DataFrame, path: str) -> None:
    """Add ledger rows or state events to their append-only table."""
    rows.write.mode("append").parquet(path)


def parse_failed_checks(ledger: DataFrame, column: str = "failed_checks") -> DataFrame:
    """The JSON column of failed checks as an array of structs."""
    return ledger.withColumn(column, F.from_json(column, FAILED_CHECKS))


def pass_rate(ledger: DataFrame) -> DataFrame:
    """Runs, passes, failures, pass rate and last run per source and resource."""
    ok = F.col("is_valid")
    return ledger.groupBy("source", "resource").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(ok).alias("passed"),
        F.count_if(~ok).alias("failed"),
        F.round(F.count_if(ok) * 100.0 / F.count(F.lit(1)), 1).cast("double").alias("pass_rate_pct"),
        F.max("created_at").alias("last_run"),
    )


def recent_failures(ledger: DataFrame, show: int = 5, tie_break: str = "batch_id") -> DataFrame:
    """The newest failed batches."""
    return (ledger.filter(~F.col("is_valid"))
                  .orderBy(F.desc_nulls_last("created_at"), tie_break).limit(show)
                  .select("batch_id", "source", "resource", "failed_checks"))


def event(spark, run_id: str, status: str, at: Column | None = None, step: str | None = None,
          batch_id: str | None = None, source: str | None = None, resource: str | None = None,
          metadata: str | None = None) -> DataFrame:
    """One state change to append to the event table. Without ``step`` it concerns the run."""
    values = {"run_id": run_id, "batch_id": batch_id, "source": source, "resource": resource, "step_name": step,
              "status": status}
    return spark.range(1).select(
        *[F.lit(v).cast("string").alias(k) for k, v in values.items()],
        (F.current_timestamp() if at is None else at).cast("timestamp").alias("at"),
        F.lit(metadata).cast("string").alias("metadata"))


def _state(events: DataFrame, keys: list[str], about: tuple[str, ...] = ()) -> DataFrame:
    """Latest status per key and its description; a terminal status ends it and wins a tie in time."""
    ended = F.col("status") != "RUNNING"
    newest = F.struct("at", ended.alias("ended"))
    return events.groupBy(*keys).agg(
        F.max_by("status", newest).alias("status"),
        F.min("at").alias("start_time"),
        F.max(F.when(ended, F.col("at"))).alias("end_time"),
        F.max_by("metadata", newest).alias("metadata"),
        *[F.max(c).alias(c) for c in about],
    ).withColumn("end_time", F.when(F.col("status") != "RUNNING", F.col("end_time")))


def step_state(events: DataFrame) -> DataFrame:
    """Current state of every step of every run."""
    return _state(events.filter(F.col("step_name").isNotNull()), ["run_id", "step_name"])


def run_state(events: DataFrame) -> DataFrame:
    """Current state of every run, with the batch it worked on."""
    runs = events.filter(F.col("step_name").isNull())
    return _state(runs, ["run_id"], ("batch_id", "source", "resource")).drop("metadata")


def _last_of_batch(rows: DataFrame, newest: tuple[str, ...]) -> DataFrame:
    """One row a batch: the newest by the given columns that exist, then by all columns."""
    rest = [c for c in rows.columns if c != "batch_id"]
    order = F.struct(*[c for c in newest if c in rest], *rest)
    last = rows.groupBy("batch_id").agg(F.max_by(F.struct(*rest), order).alias("last"))
    return last.select(F.col("batch_id").alias("__batch_id"), "last.*")


def trace(facts: DataFrame, runs: DataFrame, landing: DataFrame | None = None,
          newest: tuple[str, ...] = ("start_time", "ingestion_date")) -> DataFrame:
    """Fact rows with the last run of their batch and, if given, its last landing file.

    A batch runs again under the same key, and its facts stay one row each.
    """
    found = facts.join(_last_of_batch(runs, newest), "__batch_id", "left")
    if landing is not None:
        found = found.join(_last_of_batch(landing, newest), "__batch_id", "left")
    return found


def landing_files(landing: DataFrame) -> DataFrame:
    """The files each landed batch came from, of ``read_landing(..., with_file=True)``."""
    return landing.select("source", "ingestion_date", "batch_id", "landing_file").distinct()
