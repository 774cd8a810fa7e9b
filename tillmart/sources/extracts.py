"""Extracts: the source-side reads every load starts from."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.functions.money import row_count
from tillmart.functions.timefmt import as_date

# Fixed: the columns of the listing, in its order.
SALE_LISTING = [
    "sale_id",
    "sale_date",
    "customer_name",
    "city",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "total_amount",
]


def extract_customers(customers: DataFrame) -> DataFrame:
    return customers.select(*schemas.columns(schemas.CUSTOMERS))


def extract_products(products: DataFrame) -> DataFrame:
    """The warehouse keeps no stock, so the stock column is not read."""
    return products.select("product_id", "product_name", "category", "unit_price")


def scan_sales(sales: DataFrame, day: date | str | None = None) -> DataFrame:
    """All sales in the declared types; a value that does not fit fails the scan."""
    picked = sales if day is None else sales.where(F.col("sale_date") == as_date(day))
    return schemas.conform(picked, schemas.SALES)


def sales_between(
    sales: DataFrame, start: date | str, end: date | str, column: str = "sale_date"
) -> DataFrame:
    """Sales of an inclusive date range."""
    return sales.where(F.col(column).between(as_date(start), as_date(end)))


def sales_by_date_range(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    start: date | str,
    end: date | str,
    ordered: bool = True,
) -> DataFrame:
    """Listing of a date range with names, newest day first."""
    named = (
        sales_between(sales, start, end)
        .join(customers.select("customer_id", "customer_name", "city"), "customer_id")
        .join(products.select("product_id", "product_name", "category"), "product_id")
        .select(*SALE_LISTING)
    )
    return named.orderBy(F.desc("sale_date"), "sale_id") if ordered else named


def _listing_function() -> str:
    """The same listing for SQL users; it reads the views `sales`, `customers` and `products`."""
    tables = {"sales": schemas.SALES, "customers": schemas.CUSTOMERS, "products": schemas.PRODUCTS}
    columns, types = [], []
    for name in SALE_LISTING:
        table = next(t for t, schema in tables.items() if name in schema.fieldNames())
        kind = schemas.frame_schema(tables[table])[name].dataType.simpleString()
        columns.append(f"{table}.{name}")
        types.append(f"{name} {kind}")
    return (
        "create or replace temporary function sales_by_date_range(start_date date, end_date date) "
        f"returns table ({', '.join(types)}) return select {', '.join(columns)} "
        "from sales join customers using (customer_id) join products using (product_id) "
        "where sales.sale_date between sales_by_date_range.start_date and sales_by_date_range.end_date"
    )


def register_sql_function(
    spark: SparkSession, sales: DataFrame, customers: DataFrame, products: DataFrame
) -> None:
    sales.createOrReplaceTempView("sales")
    customers.createOrReplaceTempView("customers")
    products.createOrReplaceTempView("products")
    spark.sql(_listing_function())


# --- counts ----------------------------------------------------------------


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counted = [
        frame.agg(F.lit(name).alias("table_name"), row_count().alias("row_count"))
        for name, frame in tables.items()
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


def rows_of_day(table: DataFrame, day: date | str, column: str = "sale_date") -> DataFrame:
    return table.where(F.col(column).cast("date") == as_date(day))
