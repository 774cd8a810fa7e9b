"""Analytics over job history, executions, activity and messages."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.functions.decode import (
    ERROR_MESSAGE,
    INFO_MESSAGE,
    WARNING_MESSAGE,
    execution_status_text,
    message_type_text,
    run_status_text,
    step_text,
)
from tillmart.functions.money import row_count
from tillmart.functions.timefmt import (
    as_date,
    as_timestamp,
    hhmmss_to_seconds,
    run_datetime_text,
    seconds_between,
)

# Sizes of the listings, length of a shown message, days a log is kept.
ERRORS_SHOWN = 5
COMPONENTS_SHOWN = 10
MESSAGES_SHOWN = 20
MESSAGE_LENGTH = 200
RETENTION_DAYS = 30


def status_counts(history: DataFrame, column: str, text) -> DataFrame:
    """Rows per status code with its text."""
    return (
        history.groupBy(column)
        .agg(row_count().alias("n"))
        .select(column, text(F.col(column)).alias("status_text"), "n")
    )


def run_status_counts(history: DataFrame) -> DataFrame:
    return status_counts(history, "run_status", run_status_text)


def execution_status_counts(executions: DataFrame) -> DataFrame:
    return status_counts(executions, "status", execution_status_text)


def run_durations(history: DataFrame) -> DataFrame:
    return history.select(
        "instance_id", hhmmss_to_seconds(F.col("run_duration")).alias("duration_seconds")
    )


def printable_history(history: DataFrame) -> DataFrame:
    return history.select(
        "instance_id",
        run_status_text(F.col("run_status")).alias("status_text"),
        run_datetime_text(F.col("run_date"), F.col("run_time")).alias("run_datetime"),
    )


def duration_seconds() -> Column:
    return seconds_between(F.col("start_time"), F.col("end_time"))


def execution_durations(executions: DataFrame) -> DataFrame:
    return executions.select("execution_id", duration_seconds().alias("duration_seconds"))


def _newest(df: DataFrame, groups: list[str], number: str) -> DataFrame:
    """Rows with the largest ``number`` of their group; ``number`` is unique in the log.

    The numbers are found by a hash aggregate over two or three narrow columns,
    and only the winners' rows are read in full. That keeps long messages out of
    sorts and shuffles.
    """
    winners = df.groupBy(*groups).agg(F.max(number).alias(number)).select(number)
    return df.join(winners, number, "left_semi")


def latest_run_per_job(
    history: DataFrame, jobs: DataFrame, since: datetime | str | None = None
) -> DataFrame:
    """Newest outcome (step 0) of every known job.

    ``since`` leaves out outcomes of runs that began before it, so a monitor does
    not report an earlier run.
    """
    outcomes = history.where(F.col("step_id") == 0)
    if since is not None:
        started = F.col("run_date").cast("bigint") * 1_000_000 + F.col("run_time")
        first = F.date_format(as_timestamp(since), "yyyyMMddHHmmss").cast("bigint")
        outcomes = outcomes.where(started >= first)
    newest = _newest(outcomes, ["job_name"], "instance_id")
    return newest.join(jobs.select("job_name"), "job_name").select(
        "job_name",
        "instance_id",
        "run_status",
        run_status_text(F.col("run_status")).alias("status_text"),
        "message",
    )


def latest_execution(
    executions: DataFrame,
    day: date | str,
    folder: str | None = None,
    project: str | None = None,
    package: str | None = None,
) -> DataFrame:
    """Newest execution that began on ``day``, per folder, project and package."""
    picked = executions.where(F.col("start_time").cast("date") == as_date(day))
    for column, wanted in (
        ("folder_name", folder),
        ("project_name", project),
        ("package_name", package),
    ):
        if wanted is not None:
            picked = picked.where(F.col(column) == wanted)
    return newest_of_days(picked).withColumns(
        {
            "status_text": execution_status_text(F.col("status")),
            "duration_seconds": duration_seconds(),
        }
    )


def newest_of_days(executions: DataFrame) -> DataFrame:
    """Newest execution of each day, folder, project and package."""
    dated = executions.withColumn("_day", F.col("start_time").cast("date"))
    by = ["_day", "folder_name", "project_name", "package_name"]
    return _newest(dated, by, "execution_id").drop("_day")


def in_folders(executions: DataFrame, folders: DataFrame) -> DataFrame:
    """Executions of the given folders, joined on the folder's name."""
    return executions.join(folders.select("folder_name"), "folder_name")


def newest_session(activity: DataFrame) -> DataFrame:
    """Activity of the session with the highest id."""
    newest = activity.agg(F.max("session_id")).scalar()
    return activity.where(F.col("session_id") == newest)


def is_running() -> Column:
    return F.col("start_execution_date").isNotNull() & F.col("stop_execution_date").isNull()


def running_jobs(activity: DataFrame, jobs: DataFrame) -> DataFrame:
    """Known jobs that run in the newest session."""
    running = newest_session(activity).where(is_running()).select("job_name").distinct()
    return jobs.select("job_name").join(running, "job_name", "left_semi")


def session_activity(activity: DataFrame) -> DataFrame:
    return newest_session(activity).select("job_name", "run_requested_date")


def current_steps(activity: DataFrame) -> DataFrame:
    return newest_session(activity).select(
        "job_name",
        "run_requested_date",
        step_text(F.col("last_executed_step_id")).alias("current_step"),
    )


def of_operations(messages: DataFrame, executions: DataFrame) -> DataFrame:
    """Messages of the operations of the given executions."""
    return messages.join(executions.select("operation_id"), "operation_id", "left_semi")


def message_type_counts(messages: DataFrame, operation_id: int | None = None) -> DataFrame:
    """Errors, warnings and infos of every operation, or of one."""
    if operation_id is not None:
        messages = messages.where(F.col("operation_id") == operation_id)

    def count_of(code: int) -> Column:
        return F.count_if(F.col("message_type") == code)

    return messages.groupBy("operation_id").agg(
        count_of(ERROR_MESSAGE).alias("error_count"),
        count_of(WARNING_MESSAGE).alias("warning_count"),
        count_of(INFO_MESSAGE).alias("info_count"),
    )


COMPONENT = ["package_path", "execution_path", "subcomponent_name", "message_type"]


def component_stats(
    messages: DataFrame, operation_id: int | None = None, n: int = COMPONENTS_SHOWN
) -> DataFrame:
    """Components with the most messages."""
    picked = messages
    if operation_id is not None:
        picked = messages.where(F.col("operation_id") == operation_id)
    return (
        picked.groupBy(*COMPONENT)
        .agg(row_count().alias("message_count"))
        .orderBy(F.desc("message_count"), *COMPONENT)
        .limit(n)
    )


def latest_messages(
    messages: DataFrame, operation_id: int | None = None, n: int = MESSAGES_SHOWN
) -> DataFrame:
    """Newest info, warning and error messages, cut to the length a log line shows."""
    picked = messages.where(
        F.col("message_type").isin(INFO_MESSAGE, WARNING_MESSAGE, ERROR_MESSAGE)
    )
    if operation_id is not None:
        picked = picked.where(F.col("operation_id") == operation_id)
    return (
        picked.orderBy(
            F.desc("message_time"), "operation_id", "message_source_name", "message_type", "message"
        )
        .limit(n)
        .select(
            "message_time",
            message_type_text(F.col("message_type")).alias("type"),
            "message_source_name",
            F.substring("message", 1, MESSAGE_LENGTH).alias("message"),
        )
    )


def newest_errors(messages: DataFrame, n: int = ERRORS_SHOWN) -> DataFrame:
    """The n newest errors of every operation.

    The rank filter is applied per task before the shuffle, so an operation with
    very many errors sends n rows per task and no more.
    """
    newest_first = Window.partitionBy("operation_id").orderBy(F.desc("message_time"), "message")
    return (
        messages.where(F.col("message_type") == ERROR_MESSAGE)
        .select("operation_id", "message_time", "message")
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def messages_by_source(messages: DataFrame, prefix: str) -> DataFrame:
    """Messages per source whose name starts with ``prefix``."""
    return (
        messages.where(F.col("message_source_name").startswith(prefix))
        .groupBy("message_source_name")
        .agg(row_count().alias("n"))
    )


def past_retention(
    executions: DataFrame, as_of: datetime | str, days: int = RETENTION_DAYS
) -> Column:
    cutoff = datetime.fromisoformat(str(as_of)) - timedelta(days=days)
    kind = executions.schema["start_time"].dataType.simpleString()
    return F.col("start_time") < as_timestamp(cutoff, kind)


def retention_candidates(
    executions: DataFrame, as_of: datetime | str, days: int = RETENTION_DAYS
) -> DataFrame:
    return executions.where(past_retention(executions, as_of, days)).agg(
        row_count().alias("executions_to_cleanup")
    )


def purge(
    executions: DataFrame, as_of: datetime | str, days: int = RETENTION_DAYS, dry_run: bool = True
) -> DataFrame:
    """Number of executions past retention, or with ``dry_run=False`` the ones to keep."""
    if dry_run:
        return retention_candidates(executions, as_of, days)
    old = past_retention(executions, as_of, days)
    return executions.where(~F.coalesce(old, F.lit(False)))


def run_report(executions: DataFrame, messages: DataFrame, loaded: DataFrame) -> DataFrame:
    """Newest execution of every operation: what ran when, its errors, the rows of its day.

    ``loaded`` has the rows a load brought, by ``sale_date``. The executions are narrow, so
    the newest is picked in one pass, without a second look at the table.
    """
    newest = (
        executions.groupBy("operation_id")
        .agg(
            F.max_by(
                F.struct(
                    "execution_id",
                    "folder_name",
                    "project_name",
                    "package_name",
                    "status",
                    "start_time",
                    "end_time",
                ),
                "execution_id",
            ).alias("_run")
        )
        .select("operation_id", "_run.*")
        .withColumn("execution_date", F.col("start_time").cast("date"))
    )
    errors = message_type_counts(messages).select("operation_id", "error_count")
    rows = loaded.groupBy(F.col("sale_date").alias("execution_date")).agg(
        row_count().alias("rows_loaded")
    )
    return (
        newest.join(errors, "operation_id", "left")
        .join(rows, "execution_date", "left")
        .select(
            "operation_id",
            "execution_id",
            "execution_date",
            "folder_name",
            "project_name",
            "package_name",
            execution_status_text(F.col("status")).alias("status_text"),
            duration_seconds().alias("duration_seconds"),
            F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
            F.coalesce("error_count", F.lit(0)).alias("error_count"),
        )
    )


def day_report(latest: DataFrame, loaded: DataFrame, day: date | str) -> DataFrame:
    """One line per newest execution of a day, with the number of rows loaded that day."""
    rows = loaded.agg(row_count().alias("rows")).scalar()
    return latest.select(
        as_date(day).alias("execution_date"),
        "execution_id",
        "folder_name",
        "project_name",
        "package_name",
        "duration_seconds",
        rows.alias("rows_loaded"),
        "status_text",
    )


def jobs_with_category(jobs: DataFrame, categories: DataFrame) -> DataFrame:
    """Every job with its category's name, NULL when it has none."""
    return jobs.join(categories, "category_id", "left").select("job_name", "category_name")


def latest_status(events: DataFrame, run: str, order: str, status: str) -> DataFrame:
    """Newest status of every run; the same call works on a batch and on a stream."""
    return events.groupBy(run).agg(
        F.max_by(status, order).alias(f"last_{status}"), F.max(order).alias(f"last_{order}")
    )
