"""The relations of the mart, read from the given parquet tables.

Every function takes the session and the folder of the tables. Nothing is
renamed or cast beyond what the relation needs, so column pruning and filters
reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.functions.timefmt import plus_seconds


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").cast("bigint").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(
                F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")
            ).alias("email"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.lit("2020-01-01").cast("date").alias("created_date"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("p_size").cast("int").alias("stock_quantity"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    part = table(spark, folder, "part")
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(part, line.l_partkey == part.p_partkey)
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("sale_id"),
            F.col("o_custkey").cast("bigint").alias("customer_id"),
            F.col("l_partkey").cast("bigint").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("p_retailprice").alias("unit_price"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("o_orderdate").cast("date").alias("sale_date"),
        )
        # The raw amounts are checked: one that would lose digits fails the job.
        .transform(schemas.conform, schemas.SALES)
    )


def unmatched_sales(spark: SparkSession, folder: str) -> DataFrame:
    """All sales, of which those of some customers and products carry an unknown id."""

    def unknown(name: str, every: int) -> Column:
        return F.when(F.col(name) % every == 0, -F.col(name)).otherwise(F.col(name)).alias(name)

    given = sales(spark, folder)
    changed = {"customer_id": unknown("customer_id", 7), "product_id": unknown("product_id", 11)}
    return given.withColumns(changed)


def flawed_sales(spark: SparkSession, folder: str) -> DataFrame:
    """As ``unmatched_sales``, also with repeated sale ids and missing values."""
    sale, line = F.col("sale_id"), F.col("sale_id") % 10
    return unmatched_sales(spark, folder).withColumns(
        {
            "sale_id": F.when(line == 7, sale - 1).otherwise(sale),
            "quantity": F.when(line != 5, F.col("quantity")),
            "product_id": F.when(line != 4, F.col("product_id")),
        }
    )


def _event_code(codes: dict[str, int], other: int | None = None) -> Column:
    kind = F.col("event_type")
    chain = None
    for name, code in codes.items():
        chain = F.when(kind == name, code) if chain is None else chain.when(kind == name, code)
    return chain if other is None else chain.otherwise(other)


def _after_value_seconds() -> Column:
    return plus_seconds(F.col("ts"), F.floor("value").cast("int"))


def _named(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


RUN_STATUS_OF_EVENT = {"error": 0, "purchase": 1, "signup": 2, "view": 3, "click": 4}


def run_status_code() -> Column:
    return _event_code(RUN_STATUS_OF_EVENT)


def job_history(spark: SparkSession, folder: str) -> DataFrame:
    ts, length = F.col("ts"), F.floor(F.col("value") * 37).cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("instance_id"),
        _named("job_", F.col("user_id")).alias("job_name"),
        (F.col("event_id") % 2).cast("int").alias("step_id"),
        run_status_code().alias("run_status"),
        (F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)).cast("int").alias("run_date"),
        (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).cast("int").alias("run_time"),
        (
            F.floor(length / 3600) * 10000
            + F.floor((length % 3600) / 60) * 100
            + length % 60
        )
        .cast("int")
        .alias("run_duration"),
        F.col("props").alias("message"),
    )


def executions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("execution_id"),
        F.col("user_id").alias("operation_id"),
        _named("folder_", F.col("user_id") % 4).alias("folder_name"),
        _named("project_", F.col("user_id") % 5).alias("project_name"),
        _named("package_", F.col("user_id") % 3).alias("package_name"),
        _event_code({"error": 4, "click": 2, "view": 9, "signup": 3}, other=7).alias("status"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_type") != "click", _after_value_seconds()).alias("end_time"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("operation_id"),
        F.col("ts").alias("message_time"),
        _event_code({"error": 120, "signup": 110, "view": 70, "click": 60}, other=50).alias(
            "message_type"
        ),
        F.col("event_type").alias("message_source_name"),
        F.col("props").alias("message"),
        F.lit("Package").alias("package_path"),
        _named("Package/", F.col("event_type")).alias("execution_path"),
        _named("part_", F.col("user_id") % 7).alias("subcomponent_name"),
    )


def events_per_day(spark: SparkSession, folder: str) -> DataFrame:
    """The rows an execution's day brought, for reports over the event table."""
    return table(spark, folder, "events").select(F.col("ts").cast("date").alias("sale_date"))


def job_activity(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        _named("job_", F.col("user_id")).alias("job_name"),
        F.floor(F.col("event_id") / 1000).cast("int").alias("session_id"),
        F.col("ts").alias("run_requested_date"),
        F.when(kind != "signup", F.col("ts")).alias("start_execution_date"),
        F.when(~kind.isin("signup", "click"), _after_value_seconds()).alias(
            "stop_execution_date"
        ),
        (F.col("event_id") % 4).cast("int").alias("last_executed_step_id"),
    )


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.select(
        _named("job_", F.col("user_id")).alias("job_name"),
        (F.col("user_id") % 7).cast("int").alias("category_id"),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        F.col("r_regionkey").alias("category_id"), F.col("r_name").alias("category_name")
    )


def folders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        _named("folder_", F.col("r_regionkey")).alias("folder_name"),
        F.col("r_name").alias("owner"),
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, folder, "events").select(
        event.alias("log_id"),
        F.col("event_type").alias("dag_id"),
        _named("task_", F.col("user_id") % 4).alias("task_id"),
        F.col("ts").cast("date").alias("execution_date"),
        F.col("ts").alias("start_time"),
        F.when(event % 5 == 1, plus_seconds(F.col("ts"), F.lit(30))).alias("end_time"),
        F.when(event % 5 == 1, "SUCCESS")
        .when(event % 5 == 2, "FAILED")
        .otherwise("STARTED")
        .alias("status"),
        (event % 1000).cast("bigint").alias("rows_extracted"),
        F.when(event % 3 != 0, (event % 900).cast("bigint")).alias("rows_loaded"),
        F.lit(None).cast("string").alias("error_message"),
    )


def summarised_facts(fact: DataFrame) -> DataFrame:
    """The facts that a summary has seen which has not caught up with the last year."""
    return fact.where(F.col("sale_date") < F.lit("1998-01-01").cast("date"))
