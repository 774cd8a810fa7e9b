"""Bad input: it is rejected, reported or leaves the last good state."""

from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.operators import dims, facts, quality, runlog, staging, summary
from tillmart.plans import jobs
from tillmart.sources import jdbc

from tests import golden

NO_SALES_DAY = "1994-12-31"


def test_orphans_are_left_out_and_logged(spark, root):
    source = golden.source(spark)
    short = replace(source, customers=source.customers.where("customer_id <> 5"))
    result = jobs.run_daily(spark, short, root, golden.TODAY)
    assert (result["rows_extracted"], result["rows_loaded"]) == (10, 8)
    assert jobs.Mart(spark, root).sales_summary_daily.first().unique_customers == 4


def test_date_with_only_orphans_is_emptied(spark, root):
    source = golden.source(spark)
    jobs.run_range(spark, source, root, "2025-12-01", "2025-12-02")
    unknown = source.sales.withColumn(
        "customer_id",
        F.when(F.col("sale_date") == "2025-12-01", 99).otherwise(F.col("customer_id")),
    )
    jobs.run_range(spark, replace(source, sales=unknown), root, "2025-12-01", "2025-12-02")
    days = jobs.Mart(spark, root).fact_sales.select(F.col("sale_date").cast("string")).distinct()
    assert [r[0] for r in days.collect()] == ["2025-12-02"]


def test_emptied_date_loses_its_summary_and_keeps_its_rejects(spark, root):
    source = golden.source(spark)
    jobs.run_daily(spark, source, root, golden.TODAY)
    unknown = source.sales.withColumn("customer_id", F.lit(99).cast("bigint"))
    jobs.run_daily(spark, replace(source, sales=unknown), root, golden.TODAY)
    mart = jobs.Mart(spark, root)
    assert mart.fact_sales.isEmpty() and mart.sales_summary_daily.isEmpty()
    rejects = mart.fact_rejects.collect()
    assert len(rejects) == 10 and {r.reason for r in rejects} == {"customer"}


def test_load_checks_see_what_is_wrong(spark, root):
    """Facts without parent, a stale summary, a missing one, a row too many, a missing key."""
    source, at = golden.source(spark), datetime(2025, 1, 1, tzinfo=timezone.utc)
    jobs.run_range(spark, source, root, "2025-12-01", golden.TODAY, at)
    mart = jobs.Mart(spark, root)
    sums, stored = mart.daily_sums, mart.sales_summary_daily
    parents = {
        "customer_key": mart.dim_customers.where("customer_key > 1"),
        "product_key": mart.dim_products,
    }
    day_off = stored.selectExpr("* except (summary_date)", "date_add(summary_date, 1) summary_date")
    dates = [str(r[0]) for r in mart.fact_sales.select("sale_date").distinct().collect()]

    def actual(**given):
        args = {"sums": sums, "dates": dates, "summary": stored, "parents": parents, "accepted": 20} | given
        checks = quality.check_load(day="2025-12-01", **args).collect()
        return {c.check_name: (c.actual, c.passed) for c in checks}

    assert actual() == {
        "fact_count": (20, True),
        "null_keys": (0, True),
        "missing_summaries": (0, True),
        "stale_summaries": (0, True),
        "facts_without_parent": (4, False),
    }
    wrong = actual(summary=day_off, accepted=19)
    assert wrong["missing_summaries"] == wrong["stale_summaries"] == (1, False)
    assert wrong["fact_count"] == (20, False)
    no_key = summary.daily_sums(mart.fact_sales.withColumn("product_key", F.lit(None).cast("bigint")))
    assert actual(sums=no_key)["null_keys"] == (20, False)


def test_constraints_of_an_empty_and_a_skewed_table(spark):
    parent = spark.range(1, 3).selectExpr("id k")
    rows = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 7L, if(id = 1, null, 1L)) k", "'x' t")
    args = ("t", "id", ["k", "t"], {"k": parent})
    found = {r[0]: r[1] for r in quality.constraint_violations(rows, *args).collect()}
    assert found == {"t_pk_id": 0, "t_not_null_k": 1, "t_not_null_t": 0, "t_fk_k": 3000}
    none = quality.constraint_violations(rows.where("1 = 0"), *args).collect()
    assert {r[1] for r in none} == {0} and len(none) == 4


def test_duplicate_natural_key(spark):
    first = dims.new_dim(golden.customers(spark), "customer_id", "customer_key")
    twice = first.unionByName(
        first.where("customer_id < 3").withColumns(
            {"customer_name": F.lit("other"), "customer_key": F.col("customer_key") + 100}
        )
    )
    found = dims.key_map(twice, "customer_id", "customer_key").collect()
    assert {r.customer_id: r.customer_key for r in found} == {1: 101, 2: 102, 3: 3, 4: 4, 5: 5}
    dim_p = dims.new_dim(golden.products(spark), "product_id", "product_key")
    keyed = facts.fact_rows(
        golden.sales(spark), dims.key_map(twice, "customer_id", "customer_key"), dim_p
    )
    assert keyed.count() == 70


def test_duplicate_source_key_fails_the_load(spark, root):
    source = golden.source(spark)
    doubled = replace(source, customers=source.customers.unionAll(source.customers))
    with pytest.raises(quality.CheckFailed, match="customer_id"):
        jobs.run_daily(spark, doubled, root, golden.TODAY)
    log = jobs.Mart(spark, root).etl_log.first()
    assert log.status == "FAILED" and "customer_id" in log.error_message


def test_day_without_sales(spark, root):
    source = golden.source(spark)
    jobs.run_daily(spark, source, root, golden.TODAY)
    result = jobs.run_daily(spark, source, root, NO_SALES_DAY)
    assert (result["rows_loaded"], result["stats"]) == (0, None)
    warned = [c for c in result["checks"] if not c.passed]
    assert [(c.check_name, c.severity) for c in warned] == [("no_data", "warn")]
    mart = jobs.Mart(spark, root)
    assert mart.fact_sales.count() == 10 and mart.sales_summary_daily.count() == 1


def test_first_load_may_be_empty(spark, root):
    result = jobs.run_daily(spark, golden.source(spark), root, NO_SALES_DAY)
    assert result["rows_loaded"] == 0
    assert jobs.Mart(spark, root).sales_summary_daily.count() == 0


def test_facts_stay_when_their_sales_are_gone(spark, root):
    source = golden.source(spark)
    jobs.run_daily(spark, source, root, golden.TODAY)
    jobs.run_daily(spark, replace(source, sales=source.sales.where("1 = 0")), root, golden.TODAY)
    assert jobs.Mart(spark, root).fact_sales.count() == 10


def test_cascade_empties_facts(spark, root):
    source = golden.source(spark)
    jobs.run_daily(spark, source, root, "2025-12-01")
    jobs.run_daily(spark, source, root, golden.TODAY, cascade=True)
    days = jobs.Mart(spark, root).fact_sales.select(F.col("sale_date").cast("string")).distinct()
    assert [r[0] for r in days.collect()] == [golden.TODAY]


@pytest.mark.parametrize("amount, fits", [("99999999.99", True), ("100000000.00", False)])
def test_amount_precision(spark, amount, fits):
    sales = golden.sales(spark).limit(1).withColumn("total_amount", F.lit(amount).cast("decimal(12,2)"))
    scan = schemas.conform(sales, schemas.SALES)
    if fits:
        assert str(scan.first().total_amount) == amount
    else:
        with pytest.raises(PySparkException, match="total_amount"):
            scan.collect()


def test_text_length(spark):
    fine = staging.add_audit_columns(golden.sales(spark), "e" * 92, 1)
    assert len(fine.first().loaded_by) == 100
    with pytest.raises(PySparkException, match="loaded_by"):
        staging.add_audit_columns(golden.sales(spark), "e" * 95, 1).collect()
    long_city = golden.customers(spark).withColumn("city", F.lit("x" * 51))
    with pytest.raises(PySparkException, match="city"):
        schemas.conform(long_city, schemas.CUSTOMERS).collect()


def test_not_null(spark):
    nameless = golden.customers(spark).withColumn("customer_name", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="customer_name"):
        schemas.enforce(nameless, schemas.CUSTOMERS).collect()


def test_checks(spark):
    sales = golden.sales(spark)
    assert quality.check_loaded(sales, golden.TODAY).first().passed
    assert not quality.check_loaded(sales, NO_SALES_DAY).first().passed
    with pytest.raises(quality.CheckFailed, match="rows_loaded"):
        quality.raise_on_failure(quality.check_loaded(sales, NO_SALES_DAY))
    quality.raise_on_failure(quality.warn_if_empty(sales, NO_SALES_DAY))
    assert quality.guard_empty(sales.where("1 = 0")) and not quality.guard_empty(sales)
    keyed = sales.selectExpr("*", "if(sale_id = 1, null, 1L) customer_key", "1L product_key")
    assert quality.check_null_keys(keyed, golden.TODAY).first().actual == 1
    assert not quality.check_count(sales, golden.TODAY, 11).first().passed
    names = quality.report(
        quality.check_count(sales, golden.TODAY, 10), quality.check_loaded(sales, golden.TODAY)
    )
    assert names.columns == quality.CHECK_COLUMNS


def test_run_log_calls(spark, root):
    path, at = f"{root}/log", datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    later = datetime(2024, 5, 1, 13, tzinfo=timezone.utc)
    first = runlog.start_run(spark, path, "job", "task", "2024-05-01", at, rows_loaded=7)
    second = runlog.start_run(spark, path, "job", "task", "2024-05-02", later)
    assert first != second
    runlog.update_run(spark, path, first, "FAILED", later, error_message="broke")
    runlog.update_run(spark, path, first, "SUCCESS", later)
    rows = {r.log_id: r for r in runlog.read_log(spark, path).collect()}
    assert (rows[first].status, rows[first].rows_loaded, rows[first].error_message) == (
        "SUCCESS", 7, None,
    )
    assert rows[second].status == "STARTED" and rows[second].end_time is None
    with pytest.raises(ValueError):
        runlog.update_run(spark, path, 1, "SUCCESS", later)


def test_jdbc_options():
    conn = jdbc.connection("jdbc:x://host/db", "user", "secret")
    plain = jdbc.read_options(conn, jdbc.SALES_QUERY)
    assert plain["query"] == jdbc.SALES_QUERY and "dbtable" not in plain
    sliced = jdbc.read_options(conn, jdbc.SALES_QUERY, "sale_id", 1, 1000, 16)
    assert sliced["numPartitions"] == "16" and sliced["partitionColumn"] == "sale_id"
    assert "query" not in sliced
    with pytest.raises(ValueError):
        jdbc.read_options(conn, jdbc.SALES_QUERY, "sale_id")
    assert jdbc.write_options(conn, "Stage_Sales")["batchsize"] == "1000"
