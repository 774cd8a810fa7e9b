"""Run tracking on a stream of status events.

Reports a run when its newest event moves on, marked when its status changed, and
once more, as TIMEOUT, when it has not ended within an hour of its start. Events later
than the watermark allows are dropped there. The newest status needs no state: it is
read from ``status_log``, in which no event is too late and batches do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tillmart.functions.decode import RUN_ENDED, run_status_text
from tillmart.functions.timefmt import plus_seconds

# Seconds a run may take, seconds between two looks at the source.
TIMEOUT_SECONDS = 3600
POLL_SECONDS = 10

FORGET_SECONDS = 7 * 24 * 3600
FILES_PER_BATCH = 1000
TIMEOUT = "TIMEOUT"

# Moments cross into Python as microseconds, so no time zone is involved there.
_COMBINED = (
    "run_id bigint, instance_id bigint, status int, "
    "event_us bigint, started_us bigint, ended_us bigint"
)
_CHANGES = (
    "run_id bigint, instance_id bigint, status int, event_us bigint, ended_us bigint, "
    "changed boolean, timed_out boolean"
)
_STATE = (
    "instance_id bigint, status int, started_us bigint, ended_us bigint, "
    "timer_ms bigint, timed_out boolean"
)


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reduce each batch to one row per run before the shuffle.

    Without it all events of a busy run would travel to, and be read by, one task.
    """
    for batch in batches:
        if batch.empty:
            continue
        ended = batch["event_us"].where(batch["status"].isin(RUN_ENDED)).astype("Int64")
        runs = batch.assign(ended=ended).sort_values("instance_id").groupby("run_id", sort=False)
        yield (
            runs.agg(
                instance_id=("instance_id", "last"),
                status=("status", "last"),
                event_us=("event_us", "max"),
                started_us=("event_us", "min"),
                ended_us=("ended", "min"),
            )
            .reset_index()
            .loc[:, ["run_id", "instance_id", "status", "event_us", "started_us", "ended_us"]]
        )


def _least(old: int | None, values: pd.Series) -> int | None:
    low = values.min()
    if pd.isna(low):
        return old
    return int(low) if old is None else min(old, int(low))


class RunWatch(StatefulProcessor):
    """State of one run: newest status, start, end and the timer that is set."""

    def __init__(self, timeout_seconds: int, forget_seconds: int):
        self.timeout_us = timeout_seconds * 1_000_000
        self.forget_us = forget_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.state.exists()
        instance = status = started = ended = timer = moment = None
        timed_out = False
        if known:
            instance, status, started, ended, timer, timed_out = self.state.get()
        old_status, old_ended = status, ended
        for batch in rows:
            newest = batch.loc[batch["instance_id"].idxmax()]
            if instance is None or newest["instance_id"] > instance:
                instance, status = int(newest["instance_id"]), int(newest["status"])
                moment = int(newest["event_us"])
            started = _least(started, batch["started_us"])
            ended = _least(ended, batch["ended_us"])

        deadline = started + self.timeout_us
        if ended is not None and ended > deadline and not timed_out:
            timed_out = True
            yield self._change(key, instance, None, deadline, ended)
        if moment is not None or ended != old_ended:
            # Only a late event brings an end without being the newest.
            at = moment if moment is not None else ended
            changed = not known or status != old_status
            yield self._change(key, instance, status, at, ended, changed)
        self._store(instance, status, started, ended, timer, timed_out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        instance, status, started, ended, _, timed_out = self.state.get()
        if ended is not None or timed_out:
            self.state.clear()
            return
        self._store(instance, status, started, ended, None, True)
        yield self._change(key, instance, None, started + self.timeout_us, None)

    def close(self) -> None:
        pass

    def _store(self, instance, status, started, ended, timer, timed_out) -> None:
        """Keep the run and set its one timer: the deadline, or when to forget it."""
        wake = started + self.timeout_us
        if ended is not None or timed_out:
            wake = max(wake, ended or 0) + self.forget_us
        wake_ms = wake // 1000
        if wake_ms != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wake_ms)
        self.state.update((instance, status, started, ended, wake_ms, timed_out))

    @staticmethod
    def _change(
        key,
        instance: int,
        status: int | None,
        moment_us: int,
        ended_us: int | None,
        changed: bool = True,
    ) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "run_id": [key[0]],
                "instance_id": [instance],
                "status": pd.array([status], dtype="Int32"),
                "event_us": [moment_us],
                "ended_us": pd.array([ended_us], dtype="Int64"),
                "changed": [changed],
                "timed_out": [status is None],
            }
        )


def _status_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("run_id").cast("bigint").alias("run_id"),
        F.col("instance_id").cast("bigint").alias("instance_id"),
        F.col("status").cast("int").alias("status"),
        F.col("event_time").cast("timestamp").alias("event_time"),
    ).where(F.col("status").isNotNull() & F.col("run_id").isNotNull())


def status_log(events: DataFrame) -> DataFrame:
    """Narrow log of all status events, built without state; read by ``current_status``."""
    return _status_events(events).withColumn("status_text", run_status_text(F.col("status")))


def track_runs(
    events: DataFrame,
    timeout_seconds: int = TIMEOUT_SECONDS,
    delay: str = "10 minutes",
    clock: str = "EventTime",
    forget_seconds: int = FORGET_SECONDS,
) -> DataFrame:
    """Log of changes from a stream with the columns run_id, instance_id, status, event_time.

    A row per batch and run whose newest event moved on; ``changed`` marks a new status,
    ``ended_at`` is the first end known so far.

    Under ``clock="EventTime"`` a timeout shows when newer events move the
    watermark on; ``"ProcessingTime"`` shows it on a quiet stream too. A run is
    forgotten ``forget_seconds`` after it ended or timed out, which bounds the
    state by the runs of that span. One that speaks again later starts anew here and may
    be reported as TIMEOUT again; the log still holds its first end or timeout, by which
    ``timed_out_runs`` decides. Sets the state store of the session to RocksDB.
    """
    spark = events.sparkSession
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    known = _status_events(events).select(
        "run_id", "instance_id", "status", F.unix_micros("event_time").alias("event_us")
    )
    changes = (
        known.mapInPandas(_combine, _COMBINED)
        .withColumn("event_time", F.timestamp_micros("event_us"))
        .withWatermark("event_time", delay)
        .groupBy("run_id")
        .transformWithStateInPandas(
            RunWatch(timeout_seconds, forget_seconds),
            outputStructType=_CHANGES,
            outputMode="Append",
            timeMode=clock,
        )
    )
    text = F.when(F.col("timed_out"), TIMEOUT).otherwise(run_status_text(F.col("status")))
    return changes.select(
        "run_id",
        "instance_id",
        "status",
        text.alias("status_text"),
        F.timestamp_micros("event_us").alias("event_time"),
        F.timestamp_micros("ended_us").alias("ended_at"),
        "changed",
    )


def write_changes(
    changes: DataFrame,
    folder: str,
    checkpoint: str,
    once: bool = False,
    poll_seconds: int = POLL_SECONDS,
) -> StreamingQuery:
    """Append the changes to a parquet folder, each exactly once.

    ``once`` stops after the events at hand. It suits event time only: with
    processing time there is always another timer to wait for.
    """
    writer = (
        changes.writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def current_status(changes: DataFrame) -> DataFrame:
    """Newest status of every run in a status log or a change log."""
    return (
        changes.where(F.col("status").isNotNull())
        .groupBy("run_id")
        .agg(
            F.max("instance_id").alias("instance_id"),
            F.max_by("status", "instance_id").alias("status"),
        )
        .withColumn("status_text", run_status_text(F.col("status")))
    )


def timed_out_runs(changes: DataFrame) -> DataFrame:
    """Runs of a change log that had not ended when their first deadline passed."""
    late = F.when(F.col("status_text") == TIMEOUT, F.col("event_time"))
    return (
        changes.groupBy("run_id")
        .agg(F.min(late).alias("deadline"), F.min("ended_at").alias("_ended"))
        .where(
            F.col("deadline").isNotNull()
            & (F.col("_ended").isNull() | (F.col("_ended") > F.col("deadline")))
        )
        .select("run_id", "deadline")
    )


def run_timeouts(
    events: DataFrame, as_of, timeout_seconds: int = TIMEOUT_SECONDS
) -> DataFrame:
    """Batch form: runs without an end within the limit, as known at ``as_of``."""
    ended = F.when(F.col("status").isin(*RUN_ENDED), F.col("event_time"))
    return (
        events.where(F.col("status").isNotNull())
        .groupBy("run_id")
        .agg(F.min("event_time").alias("started"), F.min(ended).alias("ended"))
        .withColumn("deadline", plus_seconds(F.col("started"), F.lit(timeout_seconds)))
        .where(
            (F.col("deadline") <= as_of)
            & (F.col("ended").isNull() | (F.col("ended") > F.col("deadline")))
        )
        .select("run_id", "started", "deadline")
    )


def event_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream over the parquet files of one table; the schema is read once, up front.

    A batch takes at most ``files_per_batch`` files; the others wait for the next one.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # The file source wants a folder or a pattern; this pattern matches the one name.
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parque[t]")
