"""The run log: one row per run, opened, updated and completed."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.sources import versions

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"


def started_runs(log: DataFrame) -> DataFrame:
    """Runs as the opening call leaves them."""
    return log.where((F.col("status") == STARTED) & F.col("end_time").isNull()).select(
        "log_id", "dag_id", "task_id", "execution_date", "status"
    )


def update_runs(log: DataFrame, updates: DataFrame) -> DataFrame:
    """Log after ``updates`` (log_id, status, rows_loaded, error_message, end_time).

    A NULL row count keeps the old one; a NULL error message clears the old one.
    ``log_id`` is unique on both sides.
    """
    change = updates.select(
        "log_id",
        F.struct("status", "rows_loaded", "error_message", "end_time").alias("_new"),
    )
    hit = F.col("_new").isNotNull()

    def changed(name: str) -> Column:
        return F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(name))

    return (
        log.join(change, "log_id", "left")
        .withColumns(
            {
                "rows_loaded": F.coalesce(F.col("_new.rows_loaded"), F.col("rows_loaded")),
                "status": changed("status"),
                "error_message": changed("error_message"),
                "end_time": changed("end_time"),
            }
        )
        .select(*log.columns)
    )


def complete_runs(
    log: DataFrame, completed: DataFrame, end_time: Column | None = None
) -> DataFrame:
    """Log after the runs in ``completed`` (log_id, rows_loaded) succeeded."""
    done = completed.select(
        "log_id", F.col("rows_loaded").alias("_rows"), F.lit(True).alias("_done")
    )
    ended = F.current_timestamp() if end_time is None else end_time
    return (
        log.join(done, "log_id", "left")
        .withColumns(
            {
                "status": F.when(F.col("_done"), SUCCESS).otherwise(F.col("status")),
                "rows_loaded": F.when(F.col("_done"), F.col("_rows")).otherwise(
                    F.col("rows_loaded")
                ),
                "end_time": F.when(F.col("_done"), ended).otherwise(F.col("end_time")),
            }
        )
        .select(*log.columns)
    )


# --- the stored log --------------------------------------------------------
# A file table has no row update. Each call appends one entry with a version
# number; the log is the newest entry of every run. Once there are `COMPACT_AT` new
# entries they are merged with the last snapshot into a new one, sorted by run, whose version
# file names the entries it holds. Entries merged before that are deleted, so a reader
# that has just looked up the older version still finds its files.

COMPACT_AT = 64
_FOLDERS = {"snapshot": ("snapshot", "")}


def start_run(
    spark: SparkSession,
    path: str,
    job: str,
    task: str,
    day: date | str,
    at: datetime,
    status: str = STARTED,
    rows_extracted: int | None = None,
    rows_loaded: int | None = None,
    error_message: str | None = None,
) -> int:
    """Append the opening entry and return the id of the run."""
    log_id = int(at.timestamp() * 1_000_000)
    opening = spark.range(1).select(
        F.lit(log_id).cast("bigint").alias("log_id"),
        F.lit(job).alias("dag_id"),
        F.lit(task).alias("task_id"),
        F.lit(str(day)).cast("date").alias("execution_date"),
        F.lit(at).cast("timestamp").alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
        F.lit(status).alias("status"),
        F.lit(rows_extracted).cast("bigint").alias("rows_extracted"),
        F.lit(rows_loaded).cast("bigint").alias("rows_loaded"),
        F.lit(error_message).cast("string").alias("error_message"),
        F.lit(at).cast("timestamp").alias("created_at"),
    )
    _append(opening, path, 0)
    return log_id


def update_run(
    spark: SparkSession,
    path: str,
    log_id: int,
    status: str,
    at: datetime,
    rows_loaded: int | None = None,
    error_message: str | None = None,
    rows_extracted: int | None = None,
) -> None:
    """Append a new version of one run."""
    latest, version = _latest(spark, path, log_id)
    change = spark.range(1).select(
        F.lit(log_id).cast("bigint").alias("log_id"),
        F.lit(status).alias("status"),
        F.lit(rows_loaded).cast("bigint").alias("rows_loaded"),
        F.lit(error_message).cast("string").alias("error_message"),
        F.lit(at).cast("timestamp").alias("end_time"),
    )
    updated = update_runs(latest, change).withColumn(
        "rows_extracted",
        F.coalesce(F.lit(rows_extracted).cast("bigint"), F.col("rows_extracted")),
    )
    _append(updated, path, version + 1)


def complete_run(
    spark: SparkSession, path: str, log_id: int, rows_loaded: int, rows_extracted: int, at: datetime
) -> None:
    """Append the version of a run that succeeded."""
    latest, version = _latest(spark, path, log_id)
    done = spark.range(1).select(
        F.lit(log_id).cast("bigint").alias("log_id"),
        F.lit(rows_loaded).cast("bigint").alias("rows_loaded"),
    )
    completed = complete_runs(latest, done, F.lit(at).cast("timestamp"))
    rows = completed.withColumn("rows_extracted", F.lit(rows_extracted).cast("bigint"))
    _append(rows, path, version + 1)


def _latest(spark: SparkSession, path: str, log_id: int) -> tuple[DataFrame, int]:
    """Newest entry of a run and its version."""
    entries = _entries(spark, path).where(F.col("log_id") == log_id)
    version = entries.agg(F.max("version")).first()[0]
    if version is None:
        raise ValueError(f"no run {log_id} in the log")
    return entries.where(F.col("version") == version).drop("version"), version


def _append(rows: DataFrame, path: str, version: int) -> None:
    (
        schemas.enforce(rows, schemas.ETL_LOG)
        .withColumn("version", F.lit(version))
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{path}/entries")
    )
    if len(_new_entries(rows.sparkSession, path, versions.read(rows.sparkSession, path))) >= COMPACT_AT:
        compact(rows.sparkSession, path)


def _new_entries(spark: SparkSession, path: str, state: versions.Version) -> list[str]:
    merged = {name for names in state.parts("snapshot").values() for name in names}
    return [n for n in versions.names(spark, f"{path}/entries") if n.startswith("part-") and n not in merged]


def _entries(spark: SparkSession, path: str, state: versions.Version | None = None, more=None) -> DataFrame:
    """Snapshot and newer entries, with their versions."""
    state = versions.read(spark, path) if state is None else state
    more = _new_entries(spark, path, state) if more is None else more
    paths = [f"{path}/snapshot/load={load}" for load in state.parts("snapshot")]
    paths += [f"{path}/entries/{name}" for name in more]
    schema = schemas.frame_schema(schemas.ETL_LOG).add("version", "integer")
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def compact(spark: SparkSession, path: str) -> None:
    """Merge new entries into the snapshot; another one that does so meanwhile wins."""
    state = versions.read(spark, path)
    more = _new_entries(spark, path, state)
    if not more:
        return
    load = versions.new_load(state)
    newest = _newest(_entries(spark, path, state, more))
    ordered = newest.repartitionByRange("log_id").sortWithinPartitions("log_id")
    ordered.write.parquet(f"{path}/snapshot/load={load}")
    done = versions.Version(state.number, {"snapshot": {load: more}}, {"snapshot": {load: len(more)}})
    try:
        versions.commit(spark, path, done.next())
    except versions.LoadConflict:
        return
    for names in state.parts("snapshot").values():
        for name in names:
            versions.delete(spark, f"{path}/entries/{name}")
    versions.clean(spark, path, _FOLDERS)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Newest entry of every run."""
    return _newest(_entries(spark, path)).drop("version")


def _newest(entries: DataFrame) -> DataFrame:
    return (
        entries.groupBy("log_id")
        .agg(F.max_by(F.struct(*entries.columns), "version").alias("_row"))
        .select("_row.*")
    )
