"""Known results on the seed data, and the load jobs over it."""

from decimal import Decimal

from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.operators import dims, facts, summary, views
from tillmart.plans import jobs
from tillmart.sources import extracts, tables

from tests import golden

M = 1_000_000


def loaded(spark, root, **options):
    jobs.run_range(spark, golden.source(spark), root, "2025-11-26", "2025-12-02", **options)
    return jobs.Mart(spark, root)


def test_sample_sales(spark):
    sales = golden.sales(spark)
    assert sales.count() == 70
    assert sorted(r.sale_id for r in sales.collect()) == list(range(1, 71))
    assert sales.agg(F.min("sale_date").cast("string")).first()[0] == "2025-11-26"


def test_mart_load(spark, root):
    mart = loaded(spark, root)
    assert mart.fact_sales.count() == 70
    assert mart.fact_sales.select("sale_key").distinct().count() == 70
    assert mart.fact_sales.agg(F.sum("total_amount")).first()[0] == 1589 * M
    days = mart.sales_summary_daily.collect()
    assert len(days) == 7
    for day in days:
        assert (day.unique_customers, day.total_orders, day.total_items_sold) == (5, 10, 18)
        assert day.total_revenue == 227 * M
        assert day.avg_order_value == Decimal("22700000.00")
        assert (day.min_order_value, day.max_order_value) == (8 * M, 60 * M)
        assert (day.top_product_id, day.top_product_revenue) == (2, 60 * M)


def test_views(spark, root):
    mart = loaded(spark, root)
    views.register_views(spark, mart.fact_sales, mart.dim_customers, mart.dim_products)
    value = {
        r.customer_name: (r.total_orders, r.total_items_purchased, int(r.lifetime_value) // M)
        for r in spark.table("vw_customer_lifetime_value").collect()
    }
    assert value == {
        "name 1": (14, 14, 371),
        "name 2": (14, 21, 574),
        "name 3": (14, 14, 280),
        "name 4": (14, 35, 224),
        "name 5": (14, 42, 140),
    }
    ranking = views.top_n(
        views.top_products(mart.fact_sales, mart.dim_products),
        "total_revenue",
        10,
        ["product_name"],
    ).collect()
    assert [int(r.total_revenue) // M for r in ranking] == [420, 224, 196, 175, 154, 126, 98, 70, 70, 56]
    assert {r.total_orders for r in ranking} == {7}
    assert spark.table("vw_sales_analysis").count() == 70


def test_source_view(spark):
    views.register_source_views(spark, golden.sales(spark))
    rows = spark.sql("select * from vw_daily_sales_summary where total_revenue = 227000000")
    assert rows.count() == 7


def test_equal_names_merge_in_views(spark, root):
    mart = loaded(spark, root)
    same = mart.dim_customers.withColumns(
        {"customer_name": F.lit("n"), "city": F.lit(None).cast("string")}
    )
    row = views.customer_value(mart.fact_sales, same).collect()
    assert len(row) == 1
    assert (row[0].purchase_days, row[0].total_orders) == (7, 70)
    apart = views.top_products(
        mart.fact_sales, mart.dim_products, by=["product_id", "product_name", "category"]
    )
    assert apart.count() == 10


def test_top_product_tie_takes_lowest_id(spark):
    sales = golden.sales(spark).where(F.col("product_id").isin(9, 10))
    dim_c = dims.new_dim(golden.customers(spark), "customer_id", "customer_key")
    dim_p = dims.new_dim(golden.products(spark), "product_id", "product_key")
    fact = facts.fact_rows(sales, dim_c, dim_p)
    top = summary.top_product_per_day(fact, dim_p).collect()
    assert len(top) == 7 and {r.top_product_id for r in top} == {9}
    one = summary.top_product(summary.product_revenue(fact, dim_p, golden.TODAY)).collect()
    assert [r.product_id for r in one] == [9]


def test_daily_run_reports_figures(spark, root):
    result = jobs.run_daily(spark, golden.source(spark), root, golden.TODAY)
    assert result["rows_loaded"] == 10
    assert result["dim_rows"] == {"dim_customers": 5, "dim_products": 10}
    assert result["stats"]["total_revenue"] == 227.0 * M
    assert result["stats"]["top_product"] == "product 2"
    log = jobs.Mart(spark, root).etl_log.collect()
    assert [(r.status, r.rows_extracted, r.rows_loaded) for r in log] == [("SUCCESS", 10, 10)]


def test_sql_function(spark):
    extracts.register_sql_function(
        spark, golden.sales(spark), golden.customers(spark), golden.products(spark)
    )
    rows = spark.sql("select * from sales_by_date_range(date '2025-12-01', date '2025-12-02')")
    direct = extracts.sales_by_date_range(
        golden.sales(spark), golden.customers(spark), golden.products(spark), "2025-12-01", "2025-12-02"
    )
    assert rows.columns == direct.columns
    assert sorted(rows.collect()) == sorted(direct.collect())
    first = direct.first()
    assert (str(first.sale_date), first.sale_id) == ("2025-12-02", 1)


def test_seed_only_into_empty_table(spark, root):
    path = f"{root}/sales"
    assert tables.seed_if_empty(golden.sales(spark), path, schemas.SALES)
    assert not tables.seed_if_empty(golden.sales(spark), path, schemas.SALES)
    assert tables.read_rows(spark, path, schemas.SALES).count() == 70
