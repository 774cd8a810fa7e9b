"""The query catalogue: one function per query key, all over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.money import row_count
from tillmart.functions.timefmt import as_date, as_timestamp, plus_seconds
from tillmart.operators import (
    dims,
    facts,
    joblog,
    lookups,
    quality,
    runlog,
    staging,
    summary,
    views,
)
from tillmart.plans import jobs
from tillmart.session import scratch_dir
from tillmart.sources import adapters, extracts
from tillmart.sources.adapters import table
from tillmart.streaming import run_status

DAY = "1997-06-15"
RANGE_START, RANGE_END = "1997-06-01", "1997-06-30"
LOG_AS_OF = "2024-02-15 00:00:00"
LOG_DAY = "2024-01-30"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs ---------------------------------------------------------


def _dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return dims.new_dim(adapters.customers(spark, folder), "customer_id", "customer_key")


def _dim_products(spark: SparkSession, folder: str) -> DataFrame:
    source = extracts.extract_products(adapters.products(spark, folder))
    return dims.new_dim(source, "product_id", "product_key")


def _fact(spark: SparkSession, folder: str, dim_c: DataFrame, dim_p: DataFrame) -> DataFrame:
    return facts.fact_rows(adapters.sales(spark, folder), dim_c, dim_p)


def _mart(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    dim_c, dim_p = _dim_customers(spark, folder), _dim_products(spark, folder)
    return _fact(spark, folder, dim_c, dim_p), dim_c, dim_p


def _keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Sales behind the key lookup, of which some have no row in a dimension."""
    dim_c, dim_p = _dim_customers(spark, folder), _dim_products(spark, folder)
    return facts.lookup_keys(adapters.unmatched_sales(spark, folder), dim_c, dim_p)


# --- extracts --------------------------------------------------------------


@query
def src_customers(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.extract_customers(adapters.customers(spark, folder))


@query
def src_products(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.extract_products(adapters.products(spark, folder))


@query
def src_sales_scan(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.scan_sales(adapters.sales(spark, folder))


@query
def sales_by_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.sales_by_date_range(
        adapters.sales(spark, folder),
        adapters.customers(spark, folder),
        adapters.products(spark, folder),
        RANGE_START,
        RANGE_END,
    )


@query
def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return extracts.row_counts(
        {
            "customers": adapters.customers(spark, folder),
            "products": adapters.products(spark, folder),
            "sales": adapters.sales(spark, folder),
        }
    )


# --- dimensions ------------------------------------------------------------


@query
def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _dim_customers(spark, folder)


@query
def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return _dim_products(spark, folder)


@query
def dim_key_map(spark: SparkSession, folder: str) -> DataFrame:
    return dims.key_map(_dim_products(spark, folder), "product_id", "product_key")


@query
def dim_surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    ids = adapters.customers(spark, folder).select("customer_id")
    even = ids.where(F.col("customer_id") % 2 == 0)
    given = dims.dense_index(even, "customer_id", "customer_key")
    # The customer with the largest key leaves and comes back: it gets a new key.
    highest = dims.highest_key(given, "customer_key")
    existing = given.where(F.col("customer_key") < highest)
    return dims.assign_keys(ids, "customer_id", "customer_key", existing, highest)


# --- facts -----------------------------------------------------------------


@query
def fact_load(spark: SparkSession, folder: str) -> DataFrame:
    sales = adapters.unmatched_sales(spark, folder)
    return facts.fact_rows(sales, _dim_customers(spark, folder), _dim_products(spark, folder))


@query
def fact_rejects(spark: SparkSession, folder: str) -> DataFrame:
    sales = adapters.unmatched_sales(spark, folder)
    return facts.fact_rejects(sales, _dim_customers(spark, folder), _dim_products(spark, folder))


@query
def fact_replace_by_date(spark: SparkSession, folder: str) -> DataFrame:
    sales = adapters.sales(spark, folder).select("sale_id", "sale_date", "quantity", "total_amount")
    existing = sales.withColumn("quantity", F.col("quantity") + 1)
    incoming = extracts.sales_between(sales, "1997-06-10", "1997-06-20")
    return facts.replace_by_date(existing, incoming)


# --- summaries -------------------------------------------------------------


@query
def vw_daily_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summary.daily_sales(adapters.sales(spark, folder))


@query
def daily_product_revenue(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return summary.product_revenue(fact, dim_p, DAY)


@query
def top_product_one_day(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return summary.top_product(summary.product_revenue(fact, dim_p, DAY))


@query
def top_product_per_day(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return summary.top_product_per_day(fact, dim_p)


@query
def daily_summary_one_day(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return summary.daily_summary(fact, dim_p, DAY)


@query
def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return summary.daily_summary(fact, dim_p)


@query
def summary_upsert(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    columns = ["summary_date", "total_orders", "total_revenue", "top_product_id"]
    every = summary.daily_summary(fact, dim_p).select(*columns)
    existing = every.where(F.col("summary_date") < as_date("1998-01-01")).withColumn(
        "total_revenue", F.lit(0).cast("decimal(38,2)")
    )
    incoming = every.where(F.col("summary_date") >= as_date("1997-01-01"))
    return summary.upsert(existing, incoming, ["summary_date"])


@query
def summary_stats(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return summary.summary_stats(summary.daily_summary(fact, dim_p, DAY), DAY)


# --- views -----------------------------------------------------------------


@query
def vw_sales_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return views.sales_analysis(*_mart(spark, folder))


@query
def vw_top_products(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return views.top_products(fact, dim_p)


@query
def top_products_10(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    return views.top_n(
        views.top_products(fact, dim_p), "total_revenue", 10, ["product_name", "category"]
    )


@query
def vw_customer_ltv(spark: SparkSession, folder: str) -> DataFrame:
    fact, dim_c, _ = _mart(spark, folder)
    return views.customer_value(fact, dim_c)


# --- staging ---------------------------------------------------------------


@query
def derived_audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    sales = adapters.sales(spark, folder).select("sale_id")
    return staging.add_audit_columns(sales, "Production", 1).drop("load_timestamp")


@query
def stage_sales(spark: SparkSession, folder: str) -> DataFrame:
    audited = staging.add_audit_columns(
        extracts.scan_sales(adapters.sales(spark, folder)), "Production", 1
    )
    return staging.to_stage_sales(audited, strict_reference=True).drop("load_timestamp")


@query
def stage_customers(spark: SparkSession, folder: str) -> DataFrame:
    return staging.to_stage_customers(adapters.customers(spark, folder)).drop("loaded_at")


@query
def stage_products(spark: SparkSession, folder: str) -> DataFrame:
    return staging.to_stage_products(adapters.products(spark, folder)).drop("loaded_at")


@query
def stage_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return quality.stage_row_count(adapters.sales(spark, folder), DAY)


# --- quality ---------------------------------------------------------------


@query
def load_verification(spark: SparkSession, folder: str) -> DataFrame:
    return quality.load_verification(
        adapters.sales(spark, folder), DAY, "sale_id", "last_sale_id"
    )


@query
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    keyed = _keyed(spark, folder)
    fact = keyed.where(F.col("customer_key").isNotNull() & F.col("product_key").isNotNull())
    by_day = summary.daily_summary(fact, _dim_products(spark, folder), DAY)
    checks = quality.report(quality.check_facts(keyed, DAY), quality.check_summary(by_day, DAY))
    return checks.select("check_name", "expected", "actual", "passed")


@query
def dq_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_key_counts(_keyed(spark, folder))


@query
def dq_missing_summaries(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, dim_p = _mart(spark, folder)
    behind = summary.daily_summary(adapters.summarised_facts(fact), dim_p)
    return quality.missing_summaries(fact, behind)


@query
def dq_constraints(spark: SparkSession, folder: str) -> DataFrame:
    sales = adapters.flawed_sales(spark, folder)
    customers, products = adapters.customers(spark, folder), adapters.products(spark, folder)
    return (
        quality.constraint_violations(
            sales,
            "sales",
            "sale_id",
            ["customer_id", "product_id", "quantity", "unit_price", "total_amount", "sale_date"],
            {"customer_id": customers, "product_id": products},
        )
        .unionByName(
            quality.constraint_violations(
                customers, "customers", "customer_id", ["customer_name"]
            )
        )
        .unionByName(
            quality.constraint_violations(
                products, "products", "product_id", ["product_name", "unit_price"]
            )
        )
    )


# --- the stored mart -------------------------------------------------------

FIRST_LOAD, SECOND_LOAD = "2024-05-01 00:00:00", "2024-05-02 00:00:00"
_STORED: dict[tuple[str, str], str] = {}


def _stored_mart(spark: SparkSession, folder: str) -> jobs.Mart:
    """A mart in the scratch folder, built once per session and folder for all `mart_` queries.

    All dates are loaded, then a month of them again: once by a load that dies before it
    commits, once more with the same stamp.
    """
    known = (spark.sparkContext.applicationId, folder)
    if known not in _STORED:
        _STORED[known] = _build_mart(spark, folder, scratch_dir(spark, "mart"))
    return jobs.Mart(spark, _STORED[known])


def _extracted_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The sales with a date, joined once and written; a load of some dates then only scans them."""
    path = scratch_dir(spark, "sales")
    sales = adapters.unmatched_sales(spark, folder).where("sale_date is not null")
    sales.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(sales.schema).parquet(path)


def _build_mart(spark: SparkSession, folder: str, root: str) -> str:
    source = jobs.Source(
        adapters.customers(spark, folder),
        adapters.products(spark, folder),
        _extracted_sales(spark, folder),
    )
    first, second = (
        datetime.fromisoformat(at).replace(tzinfo=timezone.utc) for at in (FIRST_LOAD, SECOND_LOAD)
    )
    range_ = source.sales.agg(F.min("sale_date"), F.max("sale_date")).first()
    if range_[0] is not None:
        jobs.run_range(spark, source, root, range_[0], range_[1], first)
    dead = jobs.Load(spark, root)
    jobs.load_dims(source, dead, second)
    jobs.load_facts(source, dead, RANGE_START, RANGE_END, second)
    jobs.run_range(spark, source, root, RANGE_START, RANGE_END, second)
    return root


def _stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@query
def mart_facts(spark: SparkSession, folder: str) -> DataFrame:
    fact = _stored_mart(spark, folder).fact_sales
    return fact.select(*facts.FACT_COLUMNS, _stamp("loaded_at"))


@query
def mart_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries as stored: a month loaded again keeps its ``loaded_at``."""
    stored = _stored_mart(spark, folder).sales_summary_daily
    return stored.withColumns({n: _stamp(n) for n in ("loaded_at", "updated_at")})


@query
def mart_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects as stored, those of a date from its last load, with the counts of the run log beside them."""
    mart = _stored_mart(spark, folder)
    runs = mart.etl_log.groupBy("execution_date").agg(
        F.max("status").alias("status"),
        F.max(F.col("rows_extracted") - F.col("rows_loaded")).alias("rows_rejected"),
    )
    second = F.col("loaded_at") == F.lit(SECOND_LOAD).cast("timestamp")
    first_day = runs.agg(F.min("execution_date").alias("_first"))
    return (
        mart.fact_rejects.join(F.broadcast(first_day))
        .withColumn("execution_date", F.when(second, F.lit(RANGE_START).cast("date")).otherwise(F.col("_first")))
        .drop("_first")
        .join(runs, "execution_date")
        .withColumn("loaded_at", _stamp("loaded_at"))
    )


@query
def mart_daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary from the kept sums, without a scan of the facts."""
    mart = _stored_mart(spark, folder)
    return summary.summary_of_sums(mart.daily_sums, mart.dim_products)


@query
def mart_top_product_per_day(spark: SparkSession, folder: str) -> DataFrame:
    mart = _stored_mart(spark, folder)
    return summary.top_product_of_sums(mart.daily_sums, mart.dim_products)


@query
def mart_top_products(spark: SparkSession, folder: str) -> DataFrame:
    mart = _stored_mart(spark, folder)
    return views.top_products_of_sums(mart.daily_sums, mart.dim_products)


@query
def mart_customer_ltv(spark: SparkSession, folder: str) -> DataFrame:
    mart = _stored_mart(spark, folder)
    return views.customer_value_of_sums(mart.daily_sums, mart.dim_customers)


@query
def mart_stage(spark: SparkSession, folder: str) -> DataFrame:
    """The staging table after a batch of all sales and one of a single day."""
    root = scratch_dir(spark, "mart")
    source = jobs.Source.from_parquet(spark, folder)
    jobs.run_staging(spark, source, root, "Production", 1)
    jobs.run_staging(spark, source, root, "Test", 2, day=DAY)
    return jobs.Mart(spark, root).stage_sales.drop("load_timestamp")


# --- run log ---------------------------------------------------------------


@query
def run_log_started(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.started_runs(adapters.run_log(spark, folder))


@query
def run_log_updated(spark: SparkSession, folder: str) -> DataFrame:
    log = adapters.run_log(spark, folder)
    failed = F.col("log_id") % 4 == 0
    updates = log.where(F.col("log_id") % 2 == 0).select(
        "log_id",
        F.when(failed, runlog.FAILED).otherwise(runlog.SUCCESS).alias("status"),
        F.when(~failed, F.col("log_id") % 700).alias("rows_loaded"),
        F.when(failed, "step failed").alias("error_message"),
        plus_seconds(F.col("start_time"), F.lit(60)).alias("end_time"),
    )
    return runlog.update_runs(log, updates).select(
        "log_id", "status", "rows_loaded", "error_message", "end_time"
    )


@query
def run_log_completed(spark: SparkSession, folder: str) -> DataFrame:
    log = adapters.run_log(spark, folder)
    completed = log.where(F.col("log_id") % 5 == 0).select(
        "log_id", F.col("rows_extracted").alias("rows_loaded")
    )
    done = runlog.complete_runs(log, completed, plus_seconds(F.col("start_time"), F.lit(60)))
    return done.select("log_id", "status", "rows_loaded")


# --- job log ---------------------------------------------------------------


@query
def decode_run_status(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.run_status_counts(adapters.job_history(spark, folder))


@query
def decode_exec_status(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.execution_status_counts(adapters.executions(spark, folder))


@query
def run_duration_seconds(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.run_durations(adapters.job_history(spark, folder))


@query
def run_datetime(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.printable_history(adapters.job_history(spark, folder))


@query
def execution_durations(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.execution_durations(adapters.executions(spark, folder))


@query
def latest_run_per_job(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.latest_run_per_job(
        adapters.job_history(spark, folder), adapters.jobs(spark, folder)
    )


@query
def latest_execution(spark: SparkSession, folder: str) -> DataFrame:
    newest = joblog.latest_execution(adapters.executions(spark, folder), LOG_DAY)
    ours = adapters.folders(spark, folder).where(F.col("owner") != "EUROPE")
    return joblog.in_folders(newest, ours).select(
        "execution_id",
        "folder_name",
        "project_name",
        "package_name",
        "status",
        "status_text",
        "start_time",
        "end_time",
        "duration_seconds",
    )


@query
def runs_in_progress(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.running_jobs(adapters.job_activity(spark, folder), adapters.jobs(spark, folder))


@query
def current_session_activity(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.session_activity(adapters.job_activity(spark, folder))


@query
def activity_step_text(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.current_steps(adapters.job_activity(spark, folder))


@query
def message_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.message_type_counts(adapters.messages(spark, folder))


@query
def component_stats(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.component_stats(adapters.messages(spark, folder))


@query
def latest_messages(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.latest_messages(adapters.messages(spark, folder))


@query
def execution_errors(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.newest_errors(adapters.messages(spark, folder))


@query
def messages_by_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.messages_by_source(adapters.messages(spark, folder), "s")


@query
def retention_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.retention_candidates(adapters.executions(spark, folder), LOG_AS_OF)


_LOGGED: dict[tuple[str, str], str] = {}


def _logged(spark: SparkSession, folder: str) -> jobs.Mart:
    """Executions stored in three increments, once per session and folder."""
    known = (spark.sparkContext.applicationId, folder)
    if known not in _LOGGED:
        root = scratch_dir(spark, "logs")
        executions = adapters.executions(spark, folder)
        high = executions.agg(F.max("execution_id")).first()[0] or 0
        for third in (1, 2, 3):
            jobs.run_log_increment(spark, executions.where(F.col("execution_id") <= high * third // 3), root)
        _LOGGED[known] = root
    return jobs.Mart(spark, _LOGGED[known])


@query
def log_latest_execution(spark: SparkSession, folder: str) -> DataFrame:
    """`latest_execution` from the rows kept for the day, after three increments."""
    newest = _logged(spark, folder).latest_executions(LOG_DAY)
    moments = {c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")}
    return newest.drop("operation_id").withColumns(moments)


@query
def log_retention(spark: SparkSession, folder: str) -> DataFrame:
    """What a retention run would drop of the stored executions, and what would stay."""
    mart = _logged(spark, folder)
    dropped = jobs.run_log_retention(spark, mart.root, LOG_AS_OF)
    stored = mart.executions_between(None, None).agg(row_count().alias("_rows"))
    return stored.select(
        F.lit(dropped).cast("bigint").alias("dropped"), (F.col("_rows") - dropped).alias("kept")
    )


@query
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.run_report(
        adapters.executions(spark, folder),
        adapters.messages(spark, folder),
        adapters.events_per_day(spark, folder),
    )


@query
def jobs_with_category(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.jobs_with_category(
        adapters.jobs(spark, folder), adapters.categories(spark, folder)
    )


@query
def hierarchy_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.hierarchy_rollup(
        table(spark, folder, "customer"),
        table(spark, folder, "nation"),
        table(spark, folder, "region"),
    )


@query
def nested_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.members_of(
        table(spark, folder, "customer"),
        table(spark, folder, "nation"),
        table(spark, folder, "region"),
        "NATION_3",
        "EUROPE",
    )


@query
def run_status_batch(spark: SparkSession, folder: str) -> DataFrame:
    return joblog.latest_status(
        table(spark, folder, "events"), "user_id", "event_id", "event_type"
    )


def _run_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("instance_id"),
        adapters.run_status_code().alias("status"),
        F.col("ts").alias("event_time"),
    )


@query
def run_timeouts(spark: SparkSession, folder: str) -> DataFrame:
    events = _run_events(table(spark, folder, "events"))
    return run_status.run_timeouts(events, as_timestamp(LOG_AS_OF))


def _log_of(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """The log a stream leaves when it has run to the end of its source."""
    target = scratch_dir(spark, "run-log")
    written = run_status.write_changes(stream, f"{target}/log", f"{target}/checkpoint", once=True)
    written.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{target}/log")


@query
def run_status_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Newest status of every run, from all events as a stream."""
    events = _run_events(run_status.event_stream(spark, folder, "events"))
    return run_status.current_status(_log_of(spark, run_status.status_log(events)))


@query
def run_timeouts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Timed out runs, from all events as a stream."""
    events = _run_events(run_status.event_stream(spark, folder, "events"))
    return run_status.timed_out_runs(_log_of(spark, run_status.track_runs(events)))
