"""Fact rows: key lookup, rejects and replacement by date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart import schemas

FACT_COLUMNS = [
    "sale_id",
    "customer_key",
    "product_key",
    "sale_date",
    "quantity",
    "unit_price",
    "total_amount",
]

TASK_BITS, ROW_BITS = 20, 27


def lookup_keys(
    sales: DataFrame, customer_map: DataFrame, product_map: DataFrame, how: str = "left"
) -> DataFrame:
    """Sales with both surrogate keys; ``how="left"`` keeps rows without a match.

    Each map holds one row per natural key: a dimension written by the load does,
    any other goes through ``key_map`` first. The maps are not hinted: Catalyst
    broadcasts one that is small enough, and otherwise AQE splits the partition
    of a customer or product that sells far more than the rest.
    """
    return sales.join(
        customer_map.select("customer_id", "customer_key"), "customer_id", how
    ).join(product_map.select("product_id", "product_key"), "product_id", how)


def fact_rows(sales: DataFrame, customer_map: DataFrame, product_map: DataFrame) -> DataFrame:
    """Sales that have both dimension rows, in the shape of the fact table."""
    return lookup_keys(sales, customer_map, product_map, "inner").select(*FACT_COLUMNS)


def fact_rejects(
    sales: DataFrame,
    customer_map: DataFrame,
    product_map: DataFrame,
    more: Sequence[str] = (),
) -> DataFrame:
    """Sales the fact load leaves out, with the dimension that has no row for them."""
    return (
        lookup_keys(sales, customer_map, product_map)
        .withColumn("reason", reject_reason())
        .where("reason is not null")
        .select("sale_id", "customer_id", "product_id", "reason", *more)
    )


def reject_reason() -> Column:
    """The dimension that has no row for a sale after the lookup; null for an accepted one."""
    no_customer, no_product = F.col("customer_key").isNull(), F.col("product_key").isNull()
    return (
        F.when(no_customer & no_product, "both")
        .when(no_customer, "customer")
        .when(no_product, "product")
    )


def told_apart(keyed: DataFrame) -> DataFrame:
    """Accepted and rejected sales as one frame, each with the columns that it keeps.

    A rejected sale keeps its ids, its date and the reason; its other columns are null, so that
    nothing that is wrong with them can fail the load. An accepted one needs its natural keys
    no more. This comes before the shuffle of the write, which then carries no column in vain.
    """
    reason = reject_reason()
    kept = {name: F.when(reason.isNull(), F.col(name)) for name in FACT_COLUMNS if name not in ("sale_id", "sale_date")}
    natural = {name: F.when(reason.isNotNull(), F.col(name)) for name in ("customer_id", "product_id")}
    return keyed.withColumns({"reason": reason} | kept | natural)


def loaded_rows(apart: DataFrame, as_of: datetime | str) -> DataFrame:
    """`told_apart` sales as they are written (`schemas.LOADED_SALES`), all in a single write.

    The date of a rejected sale becomes its ``reject_date``, so it lies apart from all dates.
    """
    accepted = F.col("reason").isNull()
    rows = with_fact_columns(apart, as_of).withColumn("reject_date", F.when(~accepted, F.col("sale_date")))
    blank = {name: F.when(accepted, F.col(name)) for name in ("sale_key", "sale_date")}
    return schemas.enforce(rows.withColumns(blank), schemas.LOADED_SALES, "reason is null")


def replace_by_date(
    existing: DataFrame, incoming: DataFrame, column: str = "sale_date"
) -> DataFrame:
    """State after every date in ``incoming`` was deleted and loaded again.

    An empty ``incoming`` changes nothing. The stored fact table gets the same
    effect from a dynamic partition overwrite, without this join.
    """
    dates = incoming.select(column).distinct()
    kept = existing.join(dates, column, "left_anti").select(*existing.columns)
    return kept.unionByName(incoming)


def with_fact_columns(facts: DataFrame, as_of: datetime | str) -> DataFrame:
    """Add ``sale_key`` and ``loaded_at``; call it on the frame right before the write.

    ``sale_key`` packs day number, task and row position. All rows of a date come
    from one write, and of a task one attempt is committed, so keys never repeat,
    also when tasks run again. No count over the table and no sort is needed.
    """
    position = F.monotonically_increasing_id()
    task = F.shiftright(position, 33)
    row = position.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (task < F.lit(1 << TASK_BITS)) & (row < F.lit(1 << ROW_BITS))
    key = (
        F.shiftleft(F.unix_date("sale_date").cast("bigint"), TASK_BITS + ROW_BITS)
        + F.shiftleft(task, ROW_BITS)
        + row
    )
    return facts.withColumns(
        {
            "sale_key": F.when(fits, key).otherwise(
                F.raise_error(F.lit("sale_key range exceeded")).cast("bigint")
            ),
            "loaded_at": F.lit(str(as_of)).cast("timestamp"),
        }
    )
