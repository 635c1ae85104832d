"""Checks, gate, data tests, freshness, ledger, state and lineage."""

import pytest
from pyspark.sql import functions as F

from bourse.operators import checks as c
from bourse.operators import ledger


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame([(1, 5.0, 4.0), (1, 3.0, 9.0), (2, None, 1.0), (None, 2.0, 1.0)],
                                 "k int, high double, low double")


def outcomes(report):
    return {r.name: (r.metric, r.outcome) for r in report.collect()}


def test_all_kinds_of_check(batch):
    got = outcomes(c.check_report(batch, [
        c.row_count(">", 3), c.missing("high"), c.missing("low"), c.bound("low", ">", 0), c.bound("low", ">=", 1),
        c.bound("high", "<", 5), c.bound("high", "<=", 5), c.count_where("inverted", "high < low"),
        c.duplicates("twice", ("k",)), c.sql_metric("rows", "SELECT count(*) FROM {table} WHERE k = 1", "=", 2)]))
    assert got == {
        "row_count > 3": (4.0, "pass"), "missing_count(high) = 0": (1.0, "fail"), "missing_count(low) = 0": (0.0, "pass"),
        "low > 0": (1.0, "pass"), "low >= 1": (1.0, "pass"), "high < 5": (5.0, "fail"), "high <= 5": (5.0, "pass"),
        "inverted = 0": (1.0, "fail"), "twice = 0": (1.0, "fail"), "rows = 2": (2.0, "pass")}


def test_no_verdict_is_a_failure(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert outcomes(c.check_report(empty, [c.bound("v", ">", 0)])) == {"v > 0": (None, "fail")}


def test_plain_checks_scan_once(batch):
    report = c.check_report(batch, [c.row_count(">", 0), c.missing("low"), c.bound("low", ">", 0)])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_audit_and_gate(batch):
    good = c.audit(batch, [c.row_count(">", 0)])
    assert good.is_valid and good.checks_passed == 1 and c.gate(good) is good
    bad = c.audit(batch, [c.row_count(">", 0), c.row_count(">", 9)])
    assert not bad.is_valid and bad.checks_failed == 1 and bad.failed_checks[0]["name"] == "row_count > 9"
    with pytest.raises(c.AuditFailed, match="row_count > 9"):
        c.gate(bad)


@pytest.mark.parametrize("frame", ["none", "empty"])
def test_empty_batches(batch, frame):
    df = None if frame == "none" else batch.filter("false")
    passed = c.audit(df, [c.row_count(">", 0)])
    assert passed.is_valid and passed.checks_passed == passed.checks_failed == 0
    failed = c.audit(df, [c.row_count(">", 0)], fail_on_empty=True)
    assert not failed.is_valid and failed.checks_failed == 1 and failed.failed_checks[0]["name"] == "fail_on_empty_data"


def test_no_checks_pass(batch):
    assert c.audit(batch, []).is_valid


def test_data_tests(spark, batch, rows):
    assert c.not_null_violations(batch, "k", "high").count() == 2
    assert rows(c.unique_violations(batch, "k")) == [(1, 2)]
    assert rows(c.accepted_values_violations(batch, "k", [1])) == [(2, 1)]
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(c.relationship_violations(batch, "k", parent, "id"), "k") == [(2,)]


@pytest.mark.parametrize("age_days,status", [(1, "pass"), (2, "pass"), (2.5, "warn"), (3, "warn"), (3.5, "error")])
def test_freshness(spark, age_days, status):
    df = spark.sql(f"SELECT timestamp '2026-01-10' - make_dt_interval(0, 0, 0, {age_days * 86400}) AS at")
    assert c.freshness(df, "at", 2, 3, F.lit("2026-01-10")).first().status == status


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.sql("SELECT current_timestamp() AS at").filter("false")
    assert c.freshness(df, "at", 2, 3).first().status == "error"


def results(spark, *entries):
    return spark.createDataFrame(
        [(b, s, "r", None, None, ok, 1, 0 if ok else 1, [] if ok else [("n", "fail", "d")], at) for b, s, ok, at in entries],
        "batch_id string, source string, resource string, data_interval_start timestamp, data_interval_end timestamp, "
        f"is_valid boolean, checks_passed int, checks_failed int, failed_checks {ledger.FAILED_CHECKS}, at string"
    ).withColumn("created_at", F.col("at").cast("timestamp")).drop("at")


def test_ledger_upsert_keeps_identity(spark, rows):
    old = results(spark, ("a", "s", True, "2026-01-01"), ("b", "s", False, "2026-01-05"))
    new = results(spark, ("b", "other", True, "2026-01-02"), ("c", "s", False, "2026-01-03"))
    merged = ledger.upsert_results(old, new)
    assert rows(merged, "batch_id", "source", "is_valid") == [("a", "s", True), ("b", "s", True), ("c", "s", False)]
    again = ledger.upsert_results(merged, new)
    assert rows(again, "batch_id", "is_valid", "created_at") == rows(merged, "batch_id", "is_valid", "created_at")


def test_append_only_ledger(spark, rows, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.append(results(spark, ("a", "s", True, "2026-01-01")), path)
    ledger.append(results(spark, ("a", "s", False, "2026-01-02")), path)
    assert rows(ledger.current_results(spark.read.parquet(path)), "batch_id", "is_valid") == [("a", False)]


def test_pass_rate_and_failures(spark, rows):
    df = results(spark, *[(f"b{i}", "s", i % 3 > 0, f"2026-01-{i + 1:02d}") for i in range(21)])
    assert rows(ledger.pass_rate(df), "total_runs", "passed", "failed", "pass_rate_pct") == [(21, 14, 7, 66.7)]
    assert [r.batch_id for r in ledger.recent_failures(df).collect()] == ["b18", "b15", "b12", "b9", "b6"]


def test_failed_checks_from_json(spark):
    df = spark.createDataFrame([('[{"name":"n","outcome":"fail","diagnostic":null}]',)], "failed_checks string")
    assert ledger.parse_failed_checks(df).first().failed_checks[0].name == "n"


def test_run_and_step_state(spark, rows):
    def at(text):
        return F.lit(text).cast("timestamp")

    parts = [
        ledger.event(spark, "r1", "RUNNING", at("2026-01-01 00:00:00"), batch_id="b", source="s", resource="x"),
        ledger.event(spark, "r1", "RUNNING", at("2026-01-01 00:00:00"), step="extract"),
        ledger.event(spark, "r1", "SUCCESS", at("2026-01-01 00:00:00"), step="extract", metadata="{}"),
        ledger.event(spark, "r1", "RUNNING", at("2026-01-01 00:05:00"), step="load"),
        ledger.event(spark, "r1", "FAILED", at("2026-01-01 00:06:00")),
        ledger.event(spark, "r2", "RUNNING", at("2026-01-02 00:00:00"), batch_id="b2", source="s", resource="x"),
    ]
    events = parts[0]
    for part in parts[1:]:
        events = events.unionByName(part)
    assert rows(ledger.run_state(events), "run_id", "status", "batch_id", F.col("end_time").isNull()) == [
        ("r1", "FAILED", "b", False), ("r2", "RUNNING", "b2", True)]
    assert rows(ledger.step_state(events), "step_name", "status") == [("extract", "SUCCESS"), ("load", "RUNNING")]


def test_trace_keeps_facts_single(spark, rows):
    facts = spark.createDataFrame([("f1", "b1"), ("f2", "b2"), ("f3", "b9")], "id string, __batch_id string")
    runs = spark.createDataFrame([("b1", "r1", "FAILED", 1), ("b1", "r2", "SUCCESS", 2), ("b2", "r3", "SUCCESS", 1)],
                                 "batch_id string, run_id string, status string, start_time int")
    files = spark.createDataFrame([("b1", "2026-01-01", "x"), ("b1", "2026-01-02", "y")], "batch_id string, ingestion_date string, landing_file string")
    assert rows(ledger.trace(facts, runs, files), "id", "run_id", "landing_file") == [
        ("f1", "r2", "y"), ("f2", "r3", None), ("f3", None, None)]
