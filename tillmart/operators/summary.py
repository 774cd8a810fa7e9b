"""The daily sales summary and its upsert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions.money import (
    average_cents,
    cents_sum,
    from_cents,
    row_count,
    whole_sum,
)
from tillmart.functions.timefmt import as_date

DAILY_MEASURES = [
    "unique_customers",
    "total_orders",
    "total_items_sold",
    "total_revenue",
    "avg_order_value",
    "min_order_value",
    "max_order_value",
]


def daily_sales(sales: DataFrame, customer: str = "customer_id") -> DataFrame:
    """Seven measures per sale date.

    With one distinct column Spark groups by (date, customer) first, so a date
    that holds a third of all rows is spread over the customers before it is
    brought together.
    """
    return (
        sales.groupBy("sale_date")
        .agg(
            F.countDistinct(customer).alias("unique_customers"),
            row_count().alias("total_orders"),
            whole_sum("quantity").alias("total_items_sold"),
            cents_sum("total_amount").alias("_cents"),
            F.min("total_amount").alias("min_order_value"),
            F.max("total_amount").alias("max_order_value"),
        )
        .withColumns(
            {
                "total_revenue": from_cents("_cents"),
                "avg_order_value": average_cents(F.col("_cents"), F.col("total_orders")),
            }
        )
        .select("sale_date", *DAILY_MEASURES)
    )


def product_revenue(fact: DataFrame, dim_products: DataFrame, day: date | str) -> DataFrame:
    """Revenue per product on one day; facts are summed by key before names join."""
    return (
        fact.where(F.col("sale_date") == as_date(day))
        .groupBy("product_key")
        .agg(cents_sum("total_amount").alias("_cents"))
        .join(dim_products.select("product_key", "product_id", "product_name"), "product_key")
        .groupBy("product_id", "product_name")
        .agg(from_cents(F.sum("_cents")).alias("revenue"))
    )


def top_product(revenue: DataFrame) -> DataFrame:
    """The product with the highest revenue; the lowest id wins a tie."""
    return revenue.orderBy(F.desc("revenue"), "product_id").limit(1)


def _winner() -> Column:
    """Aggregate over one date's products: the one with most revenue, then the lowest id.

    A struct of plain numbers, so any id a ``bigint`` holds has its order.
    """
    found = F.struct(
        F.col("_cents").alias("cents"),
        # The complement turns the order of ids around without overflow.
        F.bitwise_not("product_id").alias("turned"),
    )
    return F.max(F.when(F.col("product_id").isNotNull(), found))


def _with_top_product(days: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Take the winner apart and add its name; a day without a winner drops out.

    The days, a row each, go to the products, as a dimension may be too large for the driver.
    """
    names = dim_products.select(
        F.col("product_id").alias("top_product_id"),
        F.col("product_name").alias("top_product_name"),
    )
    won = days.withColumn("top_product_id", F.bitwise_not("_top.turned")).withColumn(
        "_top_cents", F.col("_top.cents")
    )
    return names.join(F.broadcast(won), "top_product_id").withColumn(
        "top_product_revenue", from_cents("_top_cents")
    )


def top_product_per_day(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Top product of every day in one pass."""
    revenue = fact.groupBy("sale_date", "product_key").agg(cents_sum("total_amount").alias("cents"))
    return _top_of_days(revenue, dim_products)


def top_product_of_sums(sums: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Top product of every day from kept `daily_sums`."""
    return _top_of_days(sums.where("not by_customer"), dim_products)


def _shuffled(dim_products: DataFrame) -> DataFrame:
    """A product lookup that no plan broadcasts.

    Catalyst goes by the size of the compressed files, which says little about the rows
    that would pass through the driver; kept sums have more rows than any dimension.
    """
    return dim_products.select("product_key", "product_id").hint("merge")


def _top_of_days(revenue: DataFrame, dim_products: DataFrame) -> DataFrame:
    days = (
        revenue.withColumn("_cents", F.col("cents"))
        .join(_shuffled(dim_products), "product_key")
        .groupBy(F.col("sale_date").alias("summary_date"))
        .agg(_winner().alias("_top"))
    )
    return _with_top_product(days, dim_products).select(
        "summary_date", "top_product_id", "top_product_name", "top_product_revenue"
    )


def daily_sums(fact: DataFrame) -> DataFrame:
    """Sums of the facts by (date, product) and, in rows of their own, by (date, customer).

    The facts are read once, by grouping sets. No shuffle of the facts is keyed by the
    date alone, so a hot date is spread. All figures by date, product or customer can be
    had from these rows; a load keeps them (`schemas.DAILY_SUMS`).
    """
    grouped = fact.groupingSets(
        [["sale_date", "product_key"], ["sale_date", "customer_key"]],
        "sale_date",
        "product_key",
        "customer_key",
    ).agg(
        (F.grouping("product_key") == 1).alias("by_customer"),
        row_count().alias("orders"),
        whole_sum("quantity").alias("items"),
        cents_sum("total_amount").alias("cents"),
        F.min("total_amount").alias("least"),
        F.max("total_amount").alias("most"),
    )
    return grouped


def daily_summary(
    fact: DataFrame, dim_products: DataFrame, day: date | str | None = None
) -> DataFrame:
    """Seven measures and the top product of one day, or of all days."""
    facts = fact if day is None else fact.where(F.col("sale_date") == as_date(day))
    return summary_of_sums(daily_sums(facts), dim_products)


def summary_of_sums(sums: DataFrame, dim_products: DataFrame) -> DataFrame:
    """The daily summary of `daily_sums`, fresh or kept.

    Rows by product give the totals and the top product, rows by customer the distinct
    customers. A day on which no fact has a product row gets no summary.
    ``dim_products`` holds one row per product, as the load writes it.
    """
    by_customer = F.col("by_customer")
    # Rows by customer have no product; each gets a negative number, which no key
    # equals, so that a shuffled join does not send all of them to one task.
    no_key = -1 - F.pmod(F.xxhash64("sale_date", "customer_key"), F.lit(1 << 40))
    products = _shuffled(dim_products).withColumnRenamed("product_key", "_key")
    days = (
        sums.withColumn("_cents", F.col("cents"))
        .withColumn("_lookup", F.when(by_customer, no_key).otherwise(F.col("product_key")))
        .join(products, F.col("_lookup") == F.col("_key"), "left")
        .groupBy("sale_date")
        .agg(
            F.count_if(by_customer & F.col("customer_key").isNotNull()).alias("unique_customers"),
            whole_sum(F.when(~by_customer, F.col("orders"))).alias("total_orders"),
            whole_sum(F.when(~by_customer, F.col("items"))).alias("total_items_sold"),
            F.sum(F.when(~by_customer, F.col("cents"))).alias("_total"),
            F.min("least").alias("min_order_value"),
            F.max("most").alias("max_order_value"),
            _winner().alias("_top"),
        )
    )
    return _with_top_product(days, dim_products).select(
        F.col("sale_date").alias("summary_date"),
        "unique_customers",
        "total_orders",
        "total_items_sold",
        from_cents("_total").alias("total_revenue"),
        average_cents(F.col("_total"), F.col("total_orders")).alias("avg_order_value"),
        "min_order_value",
        "max_order_value",
        "top_product_id",
        "top_product_name",
        "top_product_revenue",
    )


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """State after inserting ``incoming``, overwriting rows whose key exists.

    Columns in ``keep`` hold their old value on a conflict. One full outer join,
    so ``incoming`` is computed once; keys are unique on both sides.
    """
    left = existing.select(*keys, F.struct(*existing.columns).alias("_old"))
    right = incoming.select(*keys, F.struct(*incoming.columns).alias("_new"))

    def merged(name: str):
        old, new = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        if name in keys:
            return F.col(name)
        if name in keep:
            return F.when(F.col("_old").isNull(), new).otherwise(old).alias(name)
        return F.when(F.col("_new").isNull(), old).otherwise(new).alias(name)

    return left.join(right, list(keys), "full_outer").select(
        *[merged(name) for name in existing.columns]
    )


def summary_stats(summary: DataFrame, day: date | str) -> DataFrame:
    """The figures reported after a load; no row when the day has no summary."""
    return summary.where(F.col("summary_date") == as_date(day)).select(
        F.col("summary_date").alias("date"),
        "total_orders",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        "unique_customers",
        F.col("top_product_name").alias("top_product"),
        F.col("top_product_revenue").cast("double").alias("top_revenue"),
    )
