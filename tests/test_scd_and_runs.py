"""Latest-version lookup, run folding (G2) and latest run groups (V2)."""

from pyspark.sql import functions as F

from tests.conftest import AS_OF, telemetry, ts
from vantage.functions.time import AsOf, calendar_seconds_between, epoch_seconds_between
from vantage.operators.scd import latest_version
from vantage.plans import summary, views

A = AsOf(AS_OF)


def test_latest_version_tiebreak_is_stable(spark):
    rows = [dict(job_id=1, name="a", change_time=ts("2024-01-01 00:00:00")),
            dict(job_id=1, name="b", change_time=ts("2024-01-01 00:00:00")),
            dict(job_id=1, name="old", change_time=ts("2023-01-01 00:00:00")),
            dict(job_id=2, name="x", change_time=None)]
    t = telemetry(spark, jobs=rows)
    for _ in range(3):
        got = {r.job_id: r.name for r in summary.latest_jobs(t).collect()}
        assert got == {1: "b", 2: "x"}


def test_latest_version_one_row_per_key(spark):
    rows = [dict(job_id=k % 7, workspace_id=str(k % 2), change_time=ts(f"2024-01-{1 + k % 28:02d} 00:00:00"))
            for k in range(100)]
    t = telemetry(spark, jobs=rows)
    out = latest_version(t.jobs, ["workspace_id", "job_id"])
    assert out.count() == out.select("workspace_id", "job_id").distinct().count() == 14


def test_latest_version_plan_limits_before_shuffle(spark):
    t = telemetry(spark, jobs=[dict(job_id=1)])
    plan = latest_version(t.jobs, ["workspace_id", "job_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


SPLIT_RUN = [
    dict(run_id=7, period_start_time=ts("2024-01-30 10:00:00"), period_end_time=ts("2024-01-30 10:30:00")),
    dict(run_id=7, period_start_time=ts("2024-01-30 10:30:00"), period_end_time=ts("2024-01-30 11:00:00")),
    dict(run_id=7, period_start_time=ts("2024-01-30 11:00:00"), period_end_time=ts("2024-01-30 11:20:00"),
         result_state="FAILED"),
]


def test_g2_folds_periods_into_one_run(spark):
    t = telemetry(spark, job_run_timeline=SPLIT_RUN, jobs=[dict(job_id=1)])
    (row,) = summary.job_health(t, A).collect()
    assert row.total_runs_30d == 1 and row.failure_count == 1 and row.success_count == 0
    assert row.avg_duration_seconds == 80 * 60  # full span of the run


def test_v2_reports_only_the_last_slice(spark):
    t = telemetry(spark, job_run_timeline=SPLIT_RUN, jobs=[dict(job_id=1)])
    (row,) = views.failing_jobs(t, A).collect()
    assert row.result_state == "FAILED" and row.duration_seconds == 20 * 60


def test_v2_newer_unfinished_run_hides_older_failure(spark):
    newer = [dict(run_id=8, period_start_time=ts("2024-01-30 12:00:00"), period_end_time=ts("2024-01-30 12:10:00"))]
    t = telemetry(spark, job_run_timeline=SPLIT_RUN + newer, jobs=[dict(job_id=1)])
    assert views.failing_jobs(t, A).count() == 0


def test_g2_success_plus_failure_at_most_total(spark):
    rows = []
    for run in range(20):
        state = ["SUCCESS", "FAILED", "CANCELED", None][run % 4]
        rows.append(dict(job_id=run % 3, run_id=run, result_state=state))
    t = telemetry(spark, job_run_timeline=rows)
    for r in summary.job_health(t, A).collect():
        assert r.success_count + r.failure_count <= r.total_runs_30d
        assert r.job_name is None  # no definition -> left join keeps the job


def test_subsecond_duration_flavours(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00.900000"), ts("2024-01-01 00:00:02.100000"))], "a timestamp, b timestamp")
    row = df.select(calendar_seconds_between("a", "b").alias("c"), epoch_seconds_between("a", "b").alias("e")).first()
    assert (row.c, row.e) == (1, 2)


def test_runs_outside_window_are_ignored(spark):
    old = [dict(run_id=1, period_start_time=ts("2023-11-01 00:00:00"), period_end_time=ts("2023-11-01 01:00:00"),
                result_state="FAILED")]
    t = telemetry(spark, job_run_timeline=old)
    assert summary.job_health(t, A).count() == 0
    assert views.failing_jobs(t, A).count() == 0
    assert F is not None
