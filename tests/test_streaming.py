"""The run tracker over several micro-batches."""

import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tillmart.operators import joblog
from tillmart.plans import catalog
from tillmart.sources import adapters, tables
from tillmart.streaming import run_status

FOLDER = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
EVENTS = "run_id bigint, instance_id bigint, status int, event_time timestamp"
CHANGES = "run_id bigint, instance_id bigint, status int, status_text string, event_time timestamp"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


# One list per arriving file. Run 1 ends in time; run 2 never ends; run 3 ends
# after its deadline; run 9 only moves the clock.
FILES = [
    [(1, 1, 4, at(0)), (2, 2, 4, at(5)), (3, 3, 4, at(10)), (1, 4, 4, at(20))],
    [(1, 5, 1, at(1800)), (3, 6, 2, at(1900))],
    [(9, 7, 4, at(5000))],
    [(3, 8, 1, at(6000)), (9, 9, 1, at(6100))],
    [(9, 10, 1, at(9000))],
]


def run_over(spark, root, files, **options):
    source, changes = f"{root}/in", f"{root}/changes"
    for number, rows in enumerate(files):
        frame = spark.createDataFrame(rows, EVENTS).coalesce(1)
        frame.write.mode("append").parquet(source)
        events = spark.readStream.schema(frame.schema).parquet(source)
        query = run_status.write_changes(
            run_status.track_runs(events, **options), changes, f"{root}/ckpt", once=True
        )
        query.awaitTermination()
        assert query.exception() is None, number
    return spark.read.parquet(changes)


def test_changes_and_timeouts(spark, root):
    changes = run_over(spark, root, FILES, delay="0 seconds").orderBy("event_time").collect()
    per_run = {}
    for row in (r for r in changes if r.changed):
        per_run.setdefault(row.run_id, []).append(row.status_text)
    assert per_run[1] == ["In Progress", "Succeeded"]
    assert per_run[2] == ["In Progress", "TIMEOUT"]
    assert per_run[3] == ["In Progress", "Retry", "TIMEOUT", "Succeeded"]

    everything = spark.read.schema(EVENTS).parquet(f"{root}/in")
    batch = run_status.run_timeouts(everything, F.lit(at(9000)))
    streamed = {r.run_id for r in changes if r.status_text == "TIMEOUT"}
    assert {r.run_id for r in batch.collect()} == streamed == {2, 3}


def test_timeouts_over_more_than_the_kept_span(spark, root):
    """Runs that speak again after they were forgotten: stream and batch still agree."""
    day = 24 * 3600
    files = [
        # Run 1 ends in time, run 2 never does, run 3 ends late.
        [(1, 1, 4, at(0)), (2, 2, 4, at(5)), (3, 3, 4, at(10)), (1, 4, 1, at(1800))],
        [(3, 5, 1, at(9000)), (8, 6, 4, at(9000)), (8, 7, 1, at(9100))],
        [(9, 8, 1, at(9 * day))],
        [(9, 9, 1, at(9 * day + 10))],
        [(1, 10, 4, at(10 * day)), (2, 11, 4, at(10 * day)), (3, 12, 4, at(10 * day))],
        [(9, 13, 1, at(12 * day))],
        [(9, 14, 1, at(12 * day + 10))],
    ]
    changes = run_over(spark, root, files, delay="0 seconds")
    everything = spark.read.schema(EVENTS).parquet(f"{root}/in")
    batch = run_status.run_timeouts(everything, F.lit(at(12 * day)))
    streamed = run_status.timed_out_runs(changes)
    assert {(r.run_id, r.deadline) for r in streamed.collect()} == {
        (r.run_id, r.deadline) for r in batch.collect()
    }
    assert {r.run_id for r in streamed.collect()} == {2, 3}
    # Run 1 was forgotten and is reported again, which the log can tell.
    again = changes.where("status_text = 'TIMEOUT'").groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in again} == {1: 1, 2: 2, 3: 2}


def test_busy_run_equals_batch(spark, root):
    """One run with a third of all events; the newest status equals the batch answer."""
    rows = [
        (1 if i % 3 == 0 else i % 40 + 2, i, (i * 7) % 5, at(i)) for i in range(3000)
    ]
    files = [rows[:1000], rows[1000:2000], rows[2000:]]
    changes = run_over(spark, root, files)
    latest = run_status.current_status(changes)
    batch = joblog.latest_status(
        spark.createDataFrame(rows, EVENTS), "run_id", "instance_id", "status"
    )
    assert {(r.run_id, r.instance_id, r.status) for r in latest.collect()} == {
        (r.run_id, r.last_instance_id, r.last_status) for r in batch.collect()
    }


def test_status_does_not_depend_on_the_batches(spark, root):
    """The events of the given table in several files in any order, one per batch."""
    events = catalog._run_events(adapters.table(spark, FOLDER, "events"))
    one_by_one = f"{root}/events.parquet"
    events.repartition(3).write.parquet(one_by_one)
    cut = run_status.event_stream(spark, root, "events", files_per_batch=1)
    query = run_status.write_changes(
        run_status.status_log(cut), f"{root}/changes", f"{root}/ckpt", once=True
    )
    query.awaitTermination()
    latest = run_status.current_status(spark.read.parquet(f"{root}/changes"))
    batch = joblog.latest_status(events, "run_id", "instance_id", "status")
    assert {(r.run_id, r.instance_id, r.status) for r in latest.collect()} == {
        (r.run_id, r.last_instance_id, r.last_status) for r in batch.collect()
    }


def test_timeout_on_the_wall_clock(spark, root):
    """Under processing time a run is reported although no newer event arrives."""
    source, folder = f"{root}/in", f"{root}/changes"
    frame = spark.createDataFrame(FILES[0], EVENTS).coalesce(1)
    frame.write.parquet(source)
    events = spark.readStream.schema(frame.schema).parquet(source)
    query = run_status.write_changes(
        run_status.track_runs(events, clock="ProcessingTime"),
        folder,
        f"{root}/ckpt",
        poll_seconds=1,
    )
    overdue, give_up = set(), time.time() + 60
    try:
        while overdue != {1, 2, 3} and time.time() < give_up:
            time.sleep(2)
            if query.lastProgress is not None and tables.exists(spark, f"{folder}/_spark_metadata"):
                found = spark.read.schema(CHANGES).parquet(folder)
                overdue = {r.run_id for r in found.where("status_text = 'TIMEOUT'").collect()}
    finally:
        query.stop()
    assert overdue == {1, 2, 3}


def test_latest_status_on_a_stream(spark, root):
    """The batch aggregate runs unchanged on a stream in update mode."""
    frame = spark.createDataFrame([row for rows in FILES for row in rows], EVENTS)
    frame.repartition(4).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = (
        joblog.latest_status(stream, "run_id", "instance_id", "status")
        .writeStream.outputMode("update")
        .format("memory")
        .queryName("latest_status")
        .option("checkpointLocation", f"{root}/ckpt")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    newest = spark.table("latest_status").groupBy("run_id").agg(
        F.max("last_instance_id").alias("n")
    )
    assert {r.run_id: r.n for r in newest.collect()} == {1: 5, 2: 2, 3: 8, 9: 10}
