"""What a mart sends to the driver and moves between tasks."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tillmart.operators import facts, summary
from tillmart.plans import catalog, jobs

from tests import golden

AT = datetime(2025, 1, 1, tzinfo=timezone.utc)


def planned(frame) -> str:
    return frame._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("build", [summary.summary_of_sums, summary.top_product_of_sums])
def test_no_dimension_is_broadcast(spark, root, build):
    """Only the days, a row each, go through the driver."""
    jobs.run_range(spark, golden.source(spark), root, "2025-11-26", golden.TODAY, AT)
    mart = jobs.Mart(spark, root)
    found = build(mart.daily_sums, mart.dim_products)
    plan = planned(found)
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("BroadcastHashJoin") == 1
    days = plan[plan.index("BroadcastHashJoin") :]
    assert "BuildRight" in days.splitlines()[0]
    assert found.count() == 7


def test_the_lowest_id_wins_a_tie_and_orphans_win_nothing(spark):
    day = date(2025, 1, 1)
    sums = spark.createDataFrame(
        [(day, 1, None, False, 500), (day, 2, None, False, 500), (day, 9, None, False, 900), (day, None, 4, True, 1900)],
        "sale_date date, product_key long, customer_key long, by_customer boolean, cents long",
    ).selectExpr("*", "1L orders", "1L items", "1.00BD least", "9.00BD most")
    products = spark.createDataFrame(
        [(1, 70, "late"), (2, 60, "early"), (3, 50, "unsold")], "product_key long, product_id long, product_name string"
    )
    for build in (summary.summary_of_sums, summary.top_product_of_sums):
        (row,) = build(sums, products).collect()
        assert (row.top_product_id, row.top_product_name, row.top_product_revenue) == (60, "early", 5)


def tables(spark, folder):
    made = {
        "region": "select 0 r_regionkey, 'r' r_name",
        "nation": "select 0 n_nationkey, 'n' n_name, 0 n_regionkey",
        "customer": "select id c_custkey, 'c' || id c_name, 0 c_nationkey from range(1, 9)",
        "part": "select id p_partkey, 'p' || id p_name, 't' p_type, 1 p_size, 2.5D p_retailprice from range(1, 13)",
        "orders": "select id o_orderkey, 1 + id % 8 o_custkey, "
        "if(id = 3, null, timestamp '1997-05-30 00:00:00' + make_interval(0, 0, 0, int(id % 40))) o_orderdate from range(80)",
        "lineitem": "select id % 80 l_orderkey, int(id div 80) l_linenumber, 1 + id % 12 l_partkey, "
        "2D l_quantity, 5D l_extendedprice from range(240)",
    }
    for name, text in made.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")


def test_loads_of_a_mart_scan_sales_that_were_joined_once(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    tables(spark, folder)
    seen, load_facts = [], jobs.load_facts
    monkeypatch.setattr(jobs, "load_facts", lambda source, *a: seen.append(source.sales) or load_facts(source, *a))
    mart = jobs.Mart(spark, catalog._build_mart(spark, folder, str(tmp_path / "mart")))
    assert len(seen) == 3 and not any("Join" in planned(sales) for sales in seen)
    given = catalog.adapters.unmatched_sales(spark, folder).where("sale_date is not null")
    assert given.count() == 237
    wrong = (F.col("customer_id") < 0) | (F.col("product_id") < 0)
    assert {r[0] for r in mart.fact_sales.select("sale_id").collect()} == {
        r[0] for r in given.where(~wrong).select("sale_id").collect()
    }
    rejects = "sale_id", "customer_id", "product_id", "sale_date"
    assert set(mart.fact_rejects.select(*rejects).collect()) == set(given.where(wrong).select(*rejects).collect())


def test_an_accepted_sale_moves_without_its_natural_keys(spark):
    keyed = spark.createDataFrame(
        [(1, 10, 20, date(2025, 1, 1), 1, 2, 3), (2, 10, 21, date(2025, 1, 1), 1, 2, None), (3, 11, 21, None, None, None, None)],
        "sale_id long, customer_id long, product_id long, sale_date date, quantity int, customer_key long, product_key long",
    ).selectExpr("*", "1.00BD unit_price", "2.00BD total_amount")
    rows = {r.sale_id: r.asDict() for r in facts.told_apart(keyed).collect()}
    assert [rows[1][n] for n in ("customer_id", "product_id", "reason", "customer_key", "product_key")] == [None, None, None, 2, 3]
    assert [rows[2][n] for n in ("customer_id", "product_id", "reason", "customer_key", "quantity")] == [10, 21, "product", None, None]
    assert rows[3]["reason"] == "both" and rows[3]["total_amount"] is None and rows[2]["sale_date"] == date(2025, 1, 1)
