"""Rows for the staging tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.operators.dims import dense_index

# The mark of the loader and its length limit, and the status of new rows.
LOADED_BY_PREFIX = "Airflow_"
LOADED_BY_LENGTH = 100
NEW_ROW = "New"


def loaded_by(environment: str) -> Column:
    """Loader mark; a mark that does not fit its column fails the load."""
    mark = F.concat(F.lit(LOADED_BY_PREFIX), F.lit(environment))
    return F.when(
        F.length(mark) > LOADED_BY_LENGTH,
        F.raise_error(F.lit(f"loaded_by is longer than {LOADED_BY_LENGTH} characters")),
    ).otherwise(mark)


def _now(as_of: datetime | str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def add_audit_columns(
    df: DataFrame, environment: str, batch_id: int, as_of: datetime | str | None = None
) -> DataFrame:
    """Who loaded the row, when, and in which batch."""
    return df.withColumns(
        {
            "load_timestamp": _now(as_of),
            "loaded_by": loaded_by(environment),
            "batch_id": F.lit(batch_id).cast("int"),
        }
    )


def to_stage_sales(audited: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Audited sales in the column order of the staging table.

    The original column mapping leaves out ``sale_id``; ``strict_reference``
    reproduces that.
    """
    mapped = audited
    if strict_reference:
        mapped = audited.withColumn("sale_id", F.lit(None).cast("bigint"))
    return schemas.conform(mapped, schemas.STAGE_SALES)


def _to_stage(df: DataFrame, schema, natural: str, as_of, first_id: int) -> DataFrame:
    numbered = dense_index(df, natural, "stage_id", first_id - 1)
    filled = schemas.with_defaults(
        numbered, {"loaded_at": _now(as_of), "load_status": F.lit(NEW_ROW)}
    )
    return schemas.conform(filled, schema)


def to_stage_customers(
    df: DataFrame, as_of: datetime | str | None = None, first_id: int = 1
) -> DataFrame:
    return _to_stage(df, schemas.STAGE_CUSTOMERS, "customer_id", as_of, first_id)


def to_stage_products(
    df: DataFrame, as_of: datetime | str | None = None, first_id: int = 1
) -> DataFrame:
    return _to_stage(df, schemas.STAGE_PRODUCTS, "product_id", as_of, first_id)
