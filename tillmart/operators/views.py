"""Analytic views over the mart. They are unordered; order belongs to the reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.money import (
    average_cents,
    cents,
    cents_sum,
    from_cents,
    row_count,
    whole_sum,
)
from tillmart.operators.summary import daily_sales


def sales_analysis(fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Sales with customer and product attributes."""
    kept = ["loaded_at"] if "loaded_at" in fact.columns else []
    return (
        fact.join(
            dim_customers.select("customer_key", "customer_name", "city", "country"),
            "customer_key",
        )
        .join(dim_products.select("product_key", "product_name", "category"), "product_key")
        .select(
            "sale_date",
            "customer_name",
            "city",
            "country",
            "product_name",
            "category",
            "quantity",
            fact["unit_price"],
            "total_amount",
            *[fact[name] for name in kept],
        )
    )


def top_products(
    fact: DataFrame,
    dim_products: DataFrame,
    by: Sequence[str] = ("product_name", "category"),
) -> DataFrame:
    """Orders, items and revenue per product name and category.

    Products that share both are merged, as in the original view; pass
    ``by=["product_id", …]`` to keep them apart. Facts are summed by key before
    the dimension joins, so the join sees one row per product.
    """
    sums = fact.groupBy("product_key").agg(
        row_count().alias("orders"), F.sum("quantity").alias("items"), cents_sum("total_amount").alias("cents")
    )
    return _products_by(sums, dim_products, by)


def top_products_of_sums(
    sums: DataFrame,
    dim_products: DataFrame,
    by: Sequence[str] = ("product_name", "category"),
) -> DataFrame:
    """`top_products` from kept daily sums."""
    by_key = sums.where("not by_customer").groupBy("product_key")
    return _products_by(by_key.agg(*(F.sum(c).alias(c) for c in ("orders", "items", "cents"))), dim_products, by)


def _products_by(sums: DataFrame, dim_products: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        sums.join(dim_products.select("product_key", *by), "product_key")
        .groupBy(*by)
        .agg(
            whole_sum("orders").alias("total_orders"),
            whole_sum("items").alias("total_quantity_sold"),
            F.sum("cents").alias("_cents"),
        )
        .select(
            *by,
            "total_orders",
            "total_quantity_sold",
            from_cents("_cents").alias("total_revenue"),
            average_cents(F.col("_cents"), F.col("total_orders")).alias("avg_order_value"),
        )
    )


def customer_value(
    fact: DataFrame,
    dim_customers: DataFrame,
    by: Sequence[str] = ("customer_name", "city", "country"),
) -> DataFrame:
    """Lifetime value per customer name, city and country.

    Customers equal in all three are merged, so their purchase days are a union
    and cannot be added up per key. A number stands for the merged customer, which
    keeps the three texts out of the large shuffle; they join at the end.

    Days are kept as a set that can be merged: the bits of a word stand for 64 days, so
    rows are grouped by customer and word, with an OR of bits, and the bits are counted.
    Such sets add up over parts, loads and customers alike.
    """
    rows = fact.select(
        "customer_key",
        "sale_date",
        F.lit(1).alias("orders"),
        F.col("quantity").alias("items"),
        cents("total_amount").alias("cents"),
    )
    return _value_by(rows, dim_customers, by)


def customer_value_of_sums(
    sums: DataFrame,
    dim_customers: DataFrame,
    by: Sequence[str] = ("customer_name", "city", "country"),
) -> DataFrame:
    """`customer_value` from kept daily sums, which have a row per customer and day."""
    return _value_by(sums.where("by_customer"), dim_customers, by)


def _value_by(rows: DataFrame, dim_customers: DataFrame, by: Sequence[str]) -> DataFrame:
    groups = dim_customers.groupBy(*by).agg(F.min("customer_key").alias("_group"))
    members = dim_customers.alias("d").join(
        groups.alias("g"),
        [F.col(f"d.{name}").eqNullSafe(F.col(f"g.{name}")) for name in by],
    )
    valued = (
        rows.join(members.select("customer_key", "_group"), "customer_key")
        .groupBy("_group", F.shiftright(F.unix_date("sale_date"), 6).alias("_word"))
        .agg(
            F.bit_or(F.expr("shiftleft(1L, unix_date(sale_date) & 63)")).alias("_days"),
            F.sum("orders").alias("_orders"),
            F.sum("items").alias("_items"),
            F.sum("cents").alias("_cents"),
            F.max("sale_date").alias("_last"),
        )
        .groupBy("_group")
        .agg(
            whole_sum(F.bit_count("_days")).alias("purchase_days"),
            whole_sum("_orders").alias("total_orders"),
            whole_sum("_items").alias("total_items_purchased"),
            F.sum("_cents").alias("_cents"),
            F.max("_last").alias("last_purchase_date"),
        )
    )
    return valued.join(groups, "_group").select(
        *by,
        "purchase_days",
        "total_orders",
        "total_items_purchased",
        from_cents("_cents").alias("lifetime_value"),
        average_cents(F.col("_cents"), F.col("total_orders")).alias("avg_order_value"),
        "last_purchase_date",
    )


def top_n(view: DataFrame, measure: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest measure; ``ties`` makes the choice definite."""
    return view.orderBy(F.desc_nulls_last(measure), *ties).limit(n)


def register_source_views(spark: SparkSession, sales: DataFrame) -> None:
    """Make the summary over the source sales readable from SQL."""
    daily_sales(sales).createOrReplaceTempView("vw_daily_sales_summary")


def register_views(
    spark: SparkSession, fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame
) -> None:
    """Make the three views readable from SQL."""
    sales_analysis(fact, dim_customers, dim_products).createOrReplaceTempView("vw_sales_analysis")
    top_products(fact, dim_products).createOrReplaceTempView("vw_top_products_by_revenue")
    customer_value(fact, dim_customers).createOrReplaceTempView("vw_customer_lifetime_value")
