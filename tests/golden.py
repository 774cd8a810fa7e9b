"""The small seed data: 5 customers, 10 products, 10 sales a day for 7 days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.timefmt import as_date
from tillmart.plans.jobs import Source

TODAY = "2025-12-02"


# One day of sample sales, amounts in full units.
SAMPLE_TEMPLATE = [
    # n, customer_id, product_id, quantity, unit_price, total_amount
    (1, 1, 1, 1, 25000000, 25000000),
    (2, 2, 2, 2, 30000000, 60000000),
    (3, 3, 4, 1, 8000000, 8000000),
    (4, 4, 7, 3, 6000000, 18000000),
    (5, 5, 9, 5, 2000000, 10000000),
    (6, 1, 5, 1, 28000000, 28000000),
    (7, 2, 3, 1, 22000000, 22000000),
    (8, 3, 6, 1, 32000000, 32000000),
    (9, 4, 8, 2, 7000000, 14000000),
    (10, 5, 10, 1, 10000000, 10000000),
]


def sample_template(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SAMPLE_TEMPLATE,
        "n bigint, customer_id bigint, product_id bigint, quantity int, "
        "unit_price bigint, total_amount bigint",
    )


def sample_sales(
    template: DataFrame, today: date | str, stride: Column | int = 10, days: int = 7
) -> DataFrame:
    """Replay template rows for today and the days before it.

    ``sale_id`` is ``day * stride + n``; it is unique when the template's ``n``
    runs from 1 to ``stride``.
    """
    step = stride if isinstance(stride, Column) else F.lit(stride)
    return template.withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(days - 1)))).select(
        (F.col("day") * step + F.col("n")).cast("bigint").alias("sale_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.col("total_amount").cast("decimal(10,2)").alias("total_amount"),
        F.date_sub(as_date(today), F.col("day")).alias("sale_date"),
    )


def customers(spark):
    rows = [(i, f"name {i}", f"c{i}@example.com", f"city {i}", "land") for i in range(1, 6)]
    frame = spark.createDataFrame(
        rows, "customer_id bigint, customer_name string, email string, city string, country string"
    )
    return frame.selectExpr("*", "date '2020-01-01' created_date")


def products(spark):
    rows = [(i, f"product {i}", f"kind {i % 3}", i * 100, i) for i in range(1, 11)]
    frame = spark.createDataFrame(
        rows,
        "product_id bigint, product_name string, category string, price int, stock_quantity int",
    )
    return frame.selectExpr(
        "product_id", "product_name", "category", "cast(price as decimal(10,2)) unit_price",
        "stock_quantity",
    )


def sales(spark):
    return sample_sales(sample_template(spark), TODAY)


def source(spark) -> Source:
    return Source(customers(spark), products(spark), sales(spark))
