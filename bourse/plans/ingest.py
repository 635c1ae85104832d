"""Responses to the published table: skip, flatten, stage, audit, publish, and the books about it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bourse.contracts import Contract
from bourse.operators import checks as c
from bourse.operators import ledger
from bourse.operators.flatten import flatten, has_keys
from bourse.operators.loadplan import missing_loads
from bourse.sources import published
from bourse.sources.landing import UNREADABLE

_REJECTED = "__rejected"


@dataclass(frozen=True)
class Outcome:
    """What a batch did: audit, rows published and rejected, responses that could not be read.

    The rejected records and the unreadable responses themselves are tables beside the published one.
    """

    batch_id: str
    audit: c.AuditResult
    published: int
    rejected: int
    unreadable: int = 0
    rejects: DataFrame | None = None
    unreadable_responses: DataFrame | None = None
    skipped: bool = False


@dataclass(frozen=True)
class Books:
    """Append-only tables that ingestion writes its results and state changes to."""

    root: str

    @property
    def results(self) -> str:
        return f"{self.root.rstrip('/')}/quality_results"

    @property
    def events(self) -> str:
        return f"{self.root.rstrip('/')}/state_events"


def ingest(responses: DataFrame, root: str, contract: Contract, batch_id: str,
           parameters: dict[str, Column | str] | None = None, ingested_at: Column | None = None,
           row_batch_id: Column | None = None, most_unreadable: int | None = 0, books: Books | None = None,
           run_id: str | None = None, requested: DataFrame | None = None, force: bool = False,
           interval: tuple[Column, Column] | None = None) -> Outcome:
    """Publish a batch, or raise ``AuditFailed`` and leave the table as it was.

    The batch is written once to a staging folder; audit and publication read that. Running the same batch again gives
    the same table. Responses that could not be read fail the audit beyond ``most_unreadable`` (None: any number
    passes). Rejected records and unreadable responses are written beside the table, a failed batch is kept aside.

    ``requested`` (as for `missing_loads`) names the days the batch is for: if all are loaded, it is skipped, unless
    ``force``. With ``books`` every run, ended well, skipped or failed, leaves its events, and every audit its result.
    """
    spark = responses.sparkSession
    run_id = run_id or f"{batch_id}-{uuid.uuid4().hex[:12]}"

    def note(status: str, step: str | None = None, metadata: str | None = None) -> None:
        if books:
            ledger.append(ledger.event(spark, run_id, status, step=step, batch_id=batch_id, source=contract.source,
                                       resource=contract.resource, metadata=metadata), books.events)

    note("RUNNING")
    try:
        if requested is not None:
            existing = published.existing_dates(spark, root, contract)
            if missing_loads(requested, existing, contract.partition_keys, force).isEmpty():
                note("SKIPPED", metadata="all requested days are loaded")
                return Outcome(batch_id, c.AuditResult(True, 0, 0, []), 0, 0, skipped=True)
        note("RUNNING", "validate")
        outcome, kept_at = _staged_and_published(
            responses, root, contract, batch_id, parameters, ingested_at, row_batch_id, most_unreadable)
        if books:
            start, end = interval or (None, None)
            ledger.append(quality_result(spark, contract, batch_id, outcome.audit, start, end), books.results)
        if not outcome.audit.is_valid:
            raise c.AuditFailed(outcome.audit, kept_at)
    except Exception as error:
        note("FAILED", "validate", metadata=f"{type(error).__name__}: {error}"[:500])
        note("FAILED")
        raise
    note("SUCCESS", "validate")
    note("SUCCESS")
    return outcome


def _staged_and_published(responses: DataFrame, root: str, contract: Contract, batch_id: str, parameters, ingested_at,
                          row_batch_id, most_unreadable: int | None) -> tuple[Outcome, str | None]:
    """The outcome of a batch, and where it is kept if its audit failed."""
    spark = responses.sparkSession
    lost, unreadable = Observation(), F.col(UNREADABLE).isNotNull()
    watched = UNREADABLE in responses.columns
    readable = responses
    if watched:
        # Counted while the batch is written, so the responses are parsed once.
        readable = responses.observe(lost, F.count_if(unreadable).alias("n")).filter(~unreadable)
    records = flatten(readable, contract, parameters, batch_id if row_batch_id is None else row_batch_id, ingested_at)
    records = records.withColumn(_REJECTED, ~has_keys(contract))
    staged = published.stage(records, root, batch_id, contract, allow_empty=True, also=(_REJECTED,))
    kept, rejects = staged.filter(~F.col(_REJECTED)).drop(_REJECTED), staged.filter(_REJECTED).drop(_REJECTED)
    kept_at = None
    moving = False
    try:
        n_lost = lost.get["n"] if watched else 0
        counts = staged.agg(F.count_if(~F.col(_REJECTED)).alias("kept"), F.count_if(_REJECTED).alias("rejected")).first()
        lost_responses = None
        if n_lost:
            path = published.unreadable_path(root, contract, batch_id)
            # What could be read of it stands beside the text; JSON files can't be read for the text alone.
            responses.filter(unreadable).withColumn("payload", F.to_json("payload")).write.mode("overwrite").parquet(path)
            lost_responses = spark.read.parquet(path)
        rejected = None
        if counts.rejected:
            path = published.rejected_path(root, contract, batch_id)
            rejects.write.mode("overwrite").parquet(path)
            rejected = spark.read.schema(rejects.schema).parquet(path)
        result = c.audit(kept, contract.checks, contract.fail_on_empty)
        if watched and most_unreadable is not None:
            result = c.with_bound(result, "unreadable_responses", n_lost, most_unreadable)
        if result.is_valid and counts.kept:
            published.publish(kept, root, contract)
        if not result.is_valid:
            moving = True
            kept_at = published.keep_failed(spark, root, batch_id)
            moving = False
    finally:
        if not moving:  # a batch whose move aside failed stays staged as the evidence
            published.drop_staged(spark, root, batch_id)
    rows = counts.kept if result.is_valid else 0
    return Outcome(batch_id, result, rows, counts.rejected, n_lost, rejected, lost_responses), kept_at


def quality_result(spark, contract: Contract, batch_id: str, result: c.AuditResult,
                   start: Column | None = None, end: Column | None = None, at: Column | None = None) -> DataFrame:
    """The ledger row of one audit."""
    failed = spark.createDataFrame(
        [(result.is_valid, result.checks_passed, result.checks_failed,
          [(d["name"], d["outcome"], d["diagnostic"]) for d in result.failed_checks])],
        f"is_valid boolean, checks_passed int, checks_failed int, failed_checks {ledger.FAILED_CHECKS}")
    none = F.lit(None).cast("timestamp")
    return failed.select(
        F.lit(batch_id).alias("batch_id"), F.lit(contract.source).alias("source"),
        F.lit(contract.resource).alias("resource"),
        (none if start is None else start).alias("data_interval_start"),
        (none if end is None else end).alias("data_interval_end"),
        "is_valid", "checks_passed", "checks_failed", "failed_checks",
        (F.current_timestamp() if at is None else at).alias("created_at"))


def source_freshness(table: DataFrame, contract: Contract, now: Column | None = None) -> DataFrame:
    """Age of the table's newest load against the contract's two limits."""
    warn_days, error_days = contract.freshness_days
    return c.freshness(table, "__ingested_at", warn_days, error_days, now)
