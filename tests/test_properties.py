"""Properties of the load that must hold for any data."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart import schemas
from tillmart.operators import dims, facts, summary
from tillmart.plans import jobs
from tillmart.sources import adapters

from tests import golden

SMALL = "/root/testdata/sf0.001"
START, END = "1997-06-01", "1997-06-14"
FACTS = ["sale_id", "customer_key", "product_key", "sale_date", "quantity", "total_amount"]
STAMPS = ["loaded_at", "updated_at"]


@pytest.fixture(scope="module")
def source(spark):
    return jobs.Source.from_parquet(spark, SMALL)


def state(mart):
    return (
        sorted(mart.fact_sales.select(*FACTS).collect()),
        sorted(mart.sales_summary_daily.drop(*STAMPS).collect()),
        sorted(mart.dim_customers.drop(*STAMPS).collect()),
    )


def test_loading_twice_changes_nothing(spark, source, root):
    jobs.run_range(spark, source, root, START, END)
    mart = jobs.Mart(spark, root)
    before = state(mart)
    firsts = sorted(mart.sales_summary_daily.select("summary_date", "loaded_at").collect())
    jobs.run_range(spark, source, root, START, END)
    assert state(mart) == before
    assert sorted(mart.sales_summary_daily.select("summary_date", "loaded_at").collect()) == firsts
    keys = mart.fact_sales.select("sale_key")
    assert keys.distinct().count() == keys.count() == len(before[0])


def test_range_equals_loop_over_days(spark, tmp_path):
    source = golden.source(spark)
    whole, looped = str(tmp_path / "whole"), str(tmp_path / "looped")
    jobs.run_range(spark, source, whole, "2025-12-01", "2025-12-02")
    for day in ("2025-12-01", "2025-12-02"):
        jobs.run_daily(spark, source, looped, day)
    assert state(jobs.Mart(spark, whole)) == state(jobs.Mart(spark, looped))


def test_summary_adds_up_to_facts(spark, source, root):
    jobs.run_range(spark, source, root, START, END)
    mart = jobs.Mart(spark, root)
    total = mart.fact_sales.agg(F.sum("total_amount"), F.count("*")).first()
    assert mart.sales_summary_daily.agg(F.sum("total_revenue"), F.sum("total_orders")).first() == total


def test_accepted_and_rejected_make_extracted(spark):
    sales = adapters.sales(spark, SMALL)
    dim_c = dims.new_dim(adapters.customers(spark, SMALL), "customer_id", "customer_key")
    dim_p = dims.new_dim(adapters.products(spark, SMALL), "product_id", "product_key")
    dim_c = dim_c.where(F.col("customer_id") % 97 != 0)
    dim_p = dim_p.where(F.col("product_id") % 89 != 0)
    accepted = facts.fact_rows(sales, dim_c, dim_p).count()
    rejected = facts.fact_rejects(sales, dim_c, dim_p)
    assert rejected.count() > 0
    assert accepted + rejected.count() == sales.count()


def test_upsert_keeps_other_dates_and_kept_columns(spark):
    schema = "d int, v int, loaded string"
    old = spark.createDataFrame([(1, 10, "a"), (2, 20, "a")], schema)
    new = spark.createDataFrame([(2, None, "b"), (3, 30, "b")], schema)
    merged = summary.upsert(old, new, ["d"], keep=["loaded"])
    assert sorted(merged.collect()) == [(1, 10, "a"), (2, None, "a"), (3, 30, "b")]


def test_empty_replacement_changes_nothing(spark):
    sales = golden.sales(spark)
    same = facts.replace_by_date(sales, sales.where("1 = 0"))
    assert sorted(same.collect()) == sorted(sales.collect())


@pytest.mark.parametrize("bin_rows", [7, 1000])
def test_dense_index_over_uneven_ids(spark, monkeypatch, bin_rows):
    monkeypatch.setattr(dims, "ROWS_PER_RANGE", bin_rows)
    ids = list(range(-50, 100)) + [10**6 + i * 37 for i in range(80)] + [2**62, -(2**61)]
    frame = spark.createDataFrame([(i,) for i in reversed(ids)], "id bigint").repartition(5)
    numbered = dims.dense_index(frame, "id", "key", start=5).collect()
    assert {r.id: r.key for r in numbered} == {
        value: rank + 6 for rank, value in enumerate(sorted(ids))
    }


def test_keys_survive_reload(spark):
    first = spark.createDataFrame([(i, f"n{i}") for i in (5, 3, 9)], "id bigint, name string")
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    later = datetime(2024, 1, 2, tzinfo=timezone.utc)
    dim = dims.refresh_dim(first, "id", "key", at)
    second = spark.createDataFrame(
        [(1, "n1"), (9, "changed"), (5, "n5"), (4, "n4")], "id bigint, name string"
    )
    again = dims.refresh_dim(second, "id", "key", later, dim).collect()
    assert {r.id: r.key for r in again} == {5: 2, 9: 3, 1: 4, 4: 5}
    stamps = {r.id: (r.loaded_at.day, r.updated_at.day) for r in again}
    assert stamps == {5: (1, 1), 9: (1, 2), 1: (2, 2), 4: (2, 2)}


def test_input_order_does_not_matter(spark):
    dim_p = dims.new_dim(adapters.products(spark, SMALL), "product_id", "product_key")
    dim_c = dims.new_dim(adapters.customers(spark, SMALL), "customer_id", "customer_key")
    sales = adapters.sales(spark, SMALL)
    straight = summary.daily_summary(facts.fact_rows(sales, dim_c, dim_p), dim_p)
    shuffled = summary.daily_summary(
        facts.fact_rows(sales.orderBy(F.rand(7)), dim_c, dim_p), dim_p
    )
    assert sorted(straight.collect()) == sorted(shuffled.collect())


def test_hot_date_and_customer(spark):
    """A third of all rows on one date, customer and product gives the same sums."""
    rows = spark.range(30_000).selectExpr(
        "id sale_id",
        "if(id % 3 = 0, 1L, id % 500 + 1) customer_id",
        "if(id % 3 = 0, 1L, id % 90 + 1) product_id",
        "cast(id % 5 + 1 as int) quantity",
        "cast(1 as decimal(10,2)) unit_price",
        "cast(id % 100 as decimal(10,2)) total_amount",
        "if(id % 3 = 0, date '2024-01-01', date_add(date '2024-01-02', cast(id % 200 as int))) sale_date",
    )
    dim_c = spark.range(1, 501).selectExpr("id customer_id", "id customer_key")
    dim_p = spark.range(1, 91).selectExpr(
        "id product_id", "id product_key", "concat('p', id) product_name"
    )
    fact = facts.fact_rows(rows, dim_c, dim_p)
    assert fact.count() == 30_000
    daily = {str(r.summary_date): r for r in summary.daily_summary(fact, dim_p).collect()}
    assert daily["2024-01-01"].total_orders == 10_000
    assert daily["2024-01-01"].unique_customers == 1
    assert sum(r.total_orders for r in daily.values()) == 30_000


def test_stored_dates_are_spread_over_files(spark, root):
    """A date far larger than the rest is written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        template = spark.range(1, 20_001).selectExpr(
            "id n", "id % 5 + 1 customer_id", "id % 10 + 1 product_id", "1 quantity",
            "1 unit_price", "id % 50 total_amount",
        )
        source = jobs.Source(
            golden.customers(spark),
            golden.products(spark),
            golden.sample_sales(template, golden.TODAY, 20_000, days=1),
        )
        assert jobs.run_daily(spark, source, root, golden.TODAY)["rows_loaded"] == 20_000
        fact = jobs.Mart(spark, root).fact_sales
        assert fact.select(F.input_file_name()).distinct().count() > 1
        assert fact.select("sale_key").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")


def test_any_id_can_be_the_top_product(spark):
    """Ids over the whole range of the type, with a tie that goes to the lowest."""
    ids = [-5, 10**16 + 7, 2**63 - 1, -(2**63), 3]
    products = spark.createDataFrame(
        [(k, i, f"p{i}") for k, i in enumerate(ids)],
        "product_key bigint, product_id bigint, product_name string",
    )
    rows = [(day, k, k, 1, 10 if k == day else 1) for day in range(5) for k in range(5)]
    rows += [(5, k, k, 1, 2) for k in (0, 1, 2)]
    fact = spark.createDataFrame(
        rows, "day int, product_key bigint, customer_key bigint, quantity int, amount int"
    ).selectExpr(
        "date_add(date '2024-01-01', day) sale_date", "product_key", "customer_key", "quantity",
        "cast(amount as decimal(10,2)) total_amount",
    )
    for found in (summary.daily_summary(fact, products), summary.top_product_per_day(fact, products)):
        top = {r.summary_date.day - 1: r.top_product_id for r in found.collect()}
        assert top == {**dict(enumerate(ids)), 5: -5}


def test_a_key_is_never_given_twice(spark, root):
    """A product leaves, another arrives: old facts do not become the new product's."""
    sales = golden.sales(spark)
    every, at = golden.products(spark), "2025-01-01"
    without = every.where("product_id <> 10")
    arrived = without.unionAll(
        every.where("product_id = 10").selectExpr(
            "cast(11 as bigint) product_id", "'new' product_name", "category", "unit_price", "stock_quantity"
        )
    )
    keys = []
    for day, products in enumerate((every, without, arrived)):
        source = jobs.Source(golden.customers(spark), products, sales)
        jobs.load_dims(source, jobs.Mart(spark, root), datetime(2025, 1, day + 1, tzinfo=timezone.utc))
        keys.append({r.product_id: r.product_key for r in jobs.Mart(spark, root).dim_products.collect()})
    assert keys[0][10] == 10 and 10 not in keys[1] and keys[2][11] == 11


@pytest.mark.parametrize("value, wanted", [("2.7D", "int"), ("1.239", "decimal(10,2)"), ("300", "tinyint")])
def test_a_lost_digit_fails(spark, value, wanted):
    frame = spark.sql(f"select {value} as v")
    with pytest.raises(Exception, match="loses digits|does not fit"):
        schemas.conform(frame, T.StructType.fromDDL(f"v {wanted}")).collect()
    kept = schemas.conform(spark.sql("select 2.0D as v"), T.StructType.fromDDL("v int"))
    assert kept.first().v == 2
