"""Options for reading and writing the same relations over JDBC.

The driver jar and the address belong to the cluster; this module only builds
the option maps, so that a large table is read in parallel slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillmart import schemas

# The connection limits and batch size the loads run with.
QUERY_TIMEOUT_SECONDS = 30
BATCH_SIZE = 1000


def select_query(table: str, columns: Sequence[str]) -> str:
    """Query for named columns, so that the source sends no others."""
    return f"SELECT {', '.join(columns)} FROM {table}"


SALES_QUERY = select_query("Sales", schemas.columns(schemas.SALES))
CUSTOMERS_QUERY = select_query("Customers", schemas.columns(schemas.CUSTOMERS))
PRODUCTS_QUERY = select_query(
    "Products", [c for c in schemas.columns(schemas.PRODUCTS) if c != "stock_quantity"]
)


def connection(url: str, user: str, password: str, driver: str | None = None) -> dict[str, str]:
    options = {
        "url": url,
        "user": user,
        "password": password,
        "queryTimeout": str(QUERY_TIMEOUT_SECONDS),
    }
    if driver:
        options["driver"] = driver
    return options


def read_options(
    conn: dict[str, str],
    query: str,
    slice_by: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    slices: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of one read; with ``slice_by`` the query becomes ``slices`` range reads.

    Bounds only place the cuts: rows outside them go to the first or last slice.
    """
    options = {**conn, "fetchsize": str(fetch_size), "pushDownPredicate": "true"}
    if slice_by is None:
        return {**options, "query": query}
    if lower is None or upper is None or slices < 1:
        raise ValueError("a sliced read needs lower, upper and a positive number of slices")
    return {
        **options,
        "dbtable": f"({query}) src",
        "partitionColumn": slice_by,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(slices),
    }


def write_options(
    conn: dict[str, str], table: str, batch_size: int = BATCH_SIZE, writers: int = 8
) -> dict[str, str]:
    return {
        **conn,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(writers),
        "isolationLevel": "READ_COMMITTED",
    }


def read(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
