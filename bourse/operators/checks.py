"""Batch audits: declared checks, one aggregation, a report, a gate."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq}
REPORT_SCHEMA = "name string, metric double, outcome string, diagnostic string"


@dataclass(frozen=True)
class Check:
    """``kind`` picks the metric; ``metric op threshold`` must hold."""

    name: str
    kind: str
    op: str
    threshold: float
    target: str | tuple[str, ...] | None = None


def row_count(op: str, n: float) -> Check:
    return Check(f"row_count {op} {n}", "rows", op, n)


def missing(column: str, op: str = "=", n: float = 0) -> Check:
    return Check(f"missing_count({column}) {op} {n}", "missing", op, n, column)


def bound(column: str, op: str, value: float) -> Check:
    """Every value satisfies ``op value``: the minimum does for > and >=, else the maximum."""
    return Check(f"{column} {op} {value}", "min" if op in (">", ">=") else "max", op, value, column)


def count_where(name: str, predicate: str, op: str = "=", n: float = 0) -> Check:
    """Rows satisfying a SQL predicate."""
    return Check(f"{name} {op} {n}", "where", op, n, predicate)


def duplicates(name: str, keys: tuple[str, ...], op: str = "=", n: float = 0) -> Check:
    """Key values occurring more than once."""
    return Check(f"{name} {op} {n}", "duplicates", op, n, tuple(keys))


def sql_metric(name: str, query: str, op: str = "=", n: float = 0) -> Check:
    """A user query returning one number; ``{table}`` stands for the batch."""
    return Check(f"{name} {op} {n}", "query", op, n, query)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values occurring more than once, with their counts.

    Rows are counted before the shuffle, so a hot key costs one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def _no_number(df: DataFrame, column: str) -> Column:
    """NaN, which Spark orders above every number."""
    floating = df.schema[column].dataType.typeName() in ("double", "float")
    return F.isnan(column) if floating else F.lit(False)


def _metric(df: DataFrame, check: Check) -> Column:
    if check.kind == "rows":
        value = F.count(F.lit(1))
    elif check.kind == "missing":
        value = F.count_if(F.col(check.target).isNull() | _no_number(df, check.target))
    elif check.kind in ("min", "max"):
        extreme = F.min(check.target) if check.kind == "min" else F.max(check.target)
        # A bound holds for numbers only: with a NaN there is no verdict.
        value = F.when(F.count_if(_no_number(df, check.target)) == 0, extreme)
    elif check.kind == "where":
        value = F.count_if(F.expr(check.target))
    else:
        raise ValueError(f"unknown check kind {check.kind!r}")
    return value.cast("double")


def check_report(df: DataFrame, checks) -> DataFrame:
    """One row per check: name, metric, outcome (pass or fail), diagnostic.

    All plain metrics share one aggregation over the batch. A metric without a
    value gives no verdict and counts as failed.
    """
    checks = list(checks)
    if not checks:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    plain = [i for i, c in enumerate(checks) if c.kind not in ("duplicates", "query")]
    # A global aggregation always gives one row, also when no metric is plain.
    row = df.agg(F.lit(0).alias("_"), *[_metric(df, checks[i]).alias(f"m{i}") for i in plain])
    entries = []
    for i, check in enumerate(checks):
        if check.kind == "duplicates":
            value = duplicate_keys(df, check.target).agg(F.count(F.lit(1)).cast("double")).scalar()
        elif check.kind == "query":
            value = df.sparkSession.sql(check.target, table=df).scalar().cast("double")
        else:
            value = F.col(f"m{i}")
        holds = _OPS[check.op](value, F.lit(float(check.threshold)))
        entries.append(F.struct(
            F.lit(check.name).alias("name"),
            value.alias("metric"),
            F.when(holds, "pass").otherwise("fail").alias("outcome"),
            F.when(value.isNull(), "no verdict: metric has no value")
             .when(~holds, F.concat(F.lit("value "), value.cast("string"), F.lit(f" violates {check.op} {check.threshold}")))
             .alias("diagnostic"),
        ))
    return row.select(F.inline(F.array(*entries)))


@dataclass(frozen=True)
class AuditResult:
    is_valid: bool
    checks_passed: int
    checks_failed: int
    failed_checks: list[dict]


class AuditFailed(Exception):
    """Raised by the gate; nothing of the batch has been published.

    ``kept_at`` is the folder that keeps the batch, where there is one.
    """

    def __init__(self, result: AuditResult, kept_at: str | None = None):
        self.result = result
        self.kept_at = kept_at
        names = ", ".join(c["name"] for c in result.failed_checks)
        super().__init__(f"{result.checks_failed} of {result.checks_passed + result.checks_failed} checks failed: {names}")


def summarise(report: DataFrame) -> DataFrame:
    """A report folded to one row: validity, counts, failed checks."""
    failed = F.col("outcome") != "pass"
    return report.agg(
        (F.count_if(failed) == 0).alias("is_valid"),
        F.count_if(~failed).cast("int").alias("checks_passed"),
        F.count_if(failed).cast("int").alias("checks_failed"),
        # At most one entry per declared check.
        F.sort_array(F.collect_list(F.when(failed, F.struct("name", "outcome", "diagnostic")))).alias("failed_checks"),
    )


def audit(df: DataFrame | None, checks, fail_on_empty: bool = False) -> AuditResult:
    """Run the checks. An empty batch passes with no checks unless told otherwise."""
    checks = list(checks)
    if df is None or df.isEmpty():
        if fail_on_empty:
            entry = {"name": "fail_on_empty_data", "outcome": "fail", "diagnostic": "the batch holds no rows"}
            return AuditResult(False, 0, 1, [entry])
        return AuditResult(True, 0, 0, [])
    if not checks:
        return AuditResult(True, 0, 0, [])
    row = summarise(check_report(df, checks)).first()
    return AuditResult(row.is_valid, row.checks_passed, row.checks_failed, [r.asDict() for r in row.failed_checks])


def gate(result: AuditResult) -> AuditResult:
    if not result.is_valid:
        raise AuditFailed(result)
    return result


def with_bound(result: AuditResult, name: str, value: int, most: int) -> AuditResult:
    """The result with one more check: a count that may not exceed ``most``."""
    if value <= most:
        return AuditResult(result.is_valid, result.checks_passed + 1, result.checks_failed, result.failed_checks)
    entry = {"name": f"{name} <= {most}", "outcome": "fail", "diagnostic": f"value {value} violates <= {most}"}
    return AuditResult(False, result.checks_passed, result.checks_failed + 1, [*result.failed_checks, entry])


# --- data tests: each returns the violating rows ------------------------------

def not_null_violations(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a null in any of the columns; one pass for all of them."""
    return df.filter(reduce(operator.or_, [F.col(c).isNull() for c in columns]))


def unique_violations(df: DataFrame, *columns: str) -> DataFrame:
    """Values held by more than one row; rows with a null are not compared."""
    held = reduce(operator.and_, [F.col(c).isNotNull() for c in columns])
    return duplicate_keys(df.filter(held), columns)


def accepted_values_violations(df: DataFrame, column: str, values) -> DataFrame:
    """Values outside the list with their row counts; nulls pass."""
    return (df.filter(~F.col(column).isin(*values))
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def relationship_violations(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null key is missing from the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def freshness(df: DataFrame, loaded_at: str, warn_days: int, error_days: int,
              now: Column | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Age of the newest load against the two limits: pass, warn or error."""
    now = F.current_timestamp() if now is None else now
    day = 86_400
    latest = df.groupBy(*by).agg(F.max(F.col(loaded_at)).alias("max_loaded_at"))
    age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("max_loaded_at").cast("timestamp"))
    return latest.withColumn("age_seconds", age).withColumn(
        "status",
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_days * day), "error")
         .when(F.col("age_seconds") > warn_days * day, "warn")
         .otherwise("pass"),
    )
