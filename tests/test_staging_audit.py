"""Staging load and the audit after it."""

import pytest
from pyspark.sql import functions as F

from tillmart.functions.decode import execution_status_text, message_type_text, run_status_text
from tillmart.operators import joblog, quality
from tillmart.plans import jobs
from tillmart.sources import adapters

from tests import golden

FOLDER = "/root/testdata/sf0.001"


def test_staging_appends_per_batch(spark, root):
    source = golden.source(spark)
    assert jobs.run_staging(spark, source, root, "Production", 1) == 70
    assert jobs.run_staging(spark, source, root, "Production", 2, day=golden.TODAY) == 10
    assert jobs.run_staging(spark, source, root, "Production", 3, strict_reference=True) == 70
    stage = jobs.Mart(spark, root).stage_sales
    found = {
        r.batch_id: (r.rows, r.ids)
        for r in stage.groupBy("batch_id")
        .agg(F.count("*").alias("rows"), F.count("sale_id").alias("ids"))
        .collect()
    }
    assert found == {1: (70, 70), 2: (10, 10), 3: (70, 0)}
    assert stage.where("load_timestamp is null or loaded_by <> 'Airflow_Production'").isEmpty()


def test_stage_dims_number_on(spark, root):
    source = golden.source(spark)
    jobs.run_stage_dims(spark, source, root)
    jobs.run_stage_dims(spark, source, root)
    stage = spark.read.parquet(f"{root}/stage_customers")
    assert sorted(r.stage_id for r in stage.collect()) == list(range(1, 11))
    assert {r.load_status for r in stage.collect()} == {"New"}


def test_codes(spark):
    row = spark.range(1).select(
        run_status_text(F.lit(4)),
        run_status_text(F.lit(9)),
        execution_status_text(F.lit(6)),
        message_type_text(F.lit(110)),
        message_type_text(F.lit(60)),
    ).first()
    assert tuple(row) == ("In Progress", None, "Ended Unexpectedly", "WARNING", "60")


def test_durations(spark):
    frame = spark.sql(
        """select timestamp_ntz'2024-03-30 23:59:59.900' start_time,
                  timestamp_ntz'2024-03-31 03:00:01.100' end_time, 1 execution_id,
                  11 instance_id, 10203 run_duration, 0 run_status, 20240331 run_date, 305 run_time"""
    )
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert joblog.execution_durations(frame).first().duration_seconds == 3 * 3600 + 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert joblog.run_durations(frame).first().duration_seconds == 3723
    assert joblog.printable_history(frame).first().run_datetime == "20240331 00:03:05"


def test_latest_run_since(spark):
    history, listed = adapters.job_history(spark, FOLDER), adapters.jobs(spark, FOLDER)
    since = joblog.latest_run_per_job(history, listed, since="2024-01-29 12:00:00")
    every = joblog.latest_run_per_job(history, listed)
    assert 0 < since.count() < every.count()


def test_audit(spark):
    logs = jobs.Logs.from_parquet(spark, FOLDER)
    stage = golden.sales(spark)
    with pytest.raises(quality.CheckFailed, match="ended as"):
        jobs.run_audit(logs, stage, "2024-01-30", "2024-02-15")
    with pytest.raises(quality.CheckFailed, match="no execution"):
        jobs.run_audit(logs, stage, "2030-01-01", "2024-02-15")
    found = jobs.run_audit(logs, stage, "2024-01-30", "2024-02-15", fail_on_error=False)
    assert all(len(r.errors) <= 5 for r in found["failures"].collect())
    assert not found["stage_rows"].first().passed
    assert found["latest_messages"].count() == 20
    report = found["day_report"].collect()
    assert report and {r.rows_loaded for r in report} == {0}
    latest = {r.operation_id for r in found["latest_execution"].collect()}
    counted = {r.operation_id for r in found["message_type_counts"].collect()}
    everyone = logs.messages.select("operation_id").distinct().count()
    assert counted <= latest and 0 < len(counted) < everyone
    good = logs.executions.withColumn("status", F.lit(7))
    jobs.run_audit(jobs.Logs(good, logs.messages), stage, "2024-01-30", "2024-02-15")


def test_purge(spark):
    executions = adapters.executions(spark, FOLDER)
    old = joblog.purge(executions, "2024-02-15 00:00:00").first()[0]
    kept = joblog.purge(executions, "2024-02-15 00:00:00", dry_run=False).count()
    assert old > 0 and old + kept == executions.count()
