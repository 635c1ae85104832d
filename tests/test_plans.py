"""Physical plans keep the shape the design relies on."""

import re

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_latest_of_day_is_limited_before_the_shuffle(spark):
    plan = plan_of(spark, "stg_benchmark_series")
    assert plan.count("WindowGroupLimit") == 2
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit .* Partial", plan)


def test_bars_hash_before_the_shuffle(spark):
    plan = plan_of(spark, "stg_bars")
    assert "SortAggregate" not in plan and "partial_min_by" in plan and "partial_max_by" in plan


def test_rolling_windows_share_one_sort(spark):
    plan = plan_of(spark, "fct_rolling_metrics").split("Union")[0]
    # One exchange by asset for returns and rolling windows, one for the final order.
    assert plan.count("Exchange hashpartitioning(asset_id") == 1 and plan.count("Exchange rangepartitioning") == 1


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(spark, "quality_pass_rate")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    taken = plan_of(spark, "relationship_violations")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in taken and "ReadSchema: struct<c_custkey:bigint>" in taken


def test_top_k_reports_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "recent_failures")
    assert "TakeOrderedAndProject" in plan_of(spark, "critical_gaps")


def test_building_reports_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    from bourse.plans import reports
    from registered import inputs

    prices = inputs.prices(spark, SF_DIR)
    spark.sparkContext.setJobGroup("plan-building", "")
    reports.performance_summary(prices), reports.investment_comparison(prices)
    assert not tracker.getJobIdsForGroup("plan-building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_run_state_is_one_aggregation(spark):
    plan = plan_of(spark, "run_state")
    assert "Join" not in plan


def test_correlation_spreads_over_groups(spark):
    from pyspark.sql import functions as F

    from registered import inputs

    days = inputs.prices(spark, SF_DIR).select(F.floor(F.datediff("data_date", F.lit("1970-01-01").cast("date")) / 512)).distinct()
    assert days.count() > 1
    assert "FlatMapGroupsInPandas [bi" in plan_of(spark, "return_correlation")


def test_positions_are_numbered_without_one_task(spark):
    """Report rows are range partitioned; only the row counts of the parts (one row a part), global partial aggregates
    (one row a task, such as the calendar index) and the bucket totals of ranks meet in one task."""
    for name in ("dim_assets", "performance_summary", "investment_benchmark_and_cash", "volatility_comparison", "return_correlation"):
        lines = plan_of(spark, name).splitlines()
        gathered = [lines[k + 1] for k, line in enumerate(lines) if "Exchange SinglePartition" in line]
        assert gathered and all(any(m in line for m in ("output=[_part", "HashAggregate(keys=[]", "HashAggregate(keys=[_b")) for line in gathered), name
        assert "Exchange rangepartitioning" in "\n".join(lines), name


def test_anchors_come_from_one_calendar_row(spark):
    """One broadcast row of calendar days answers every anchor: no subquery, no loop join, a plan of bounded size."""
    for name in ("performance_summary", "investment_comparison"):
        df = QUERIES[name](spark, SF_DIR)
        plan, optimised = plan_of(spark, name), df._jdf.queryExecution().optimizedPlan().toString()
        assert "Subquery" not in plan and "NestedLoop" not in plan
    assert len(QUERIES["investment_comparison"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().splitlines()) < 300
