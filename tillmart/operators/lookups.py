"""Lookups over reference data: hierarchies and ids found by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions.money import row_count


def hierarchy_rollup(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Members per region and nation; counted per nation before the names join."""
    return (
        customer.groupBy("c_nationkey")
        .agg(row_count().alias("customers"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
        .agg(F.sum("customers").alias("customers"))
    )


def members_of(
    customer: DataFrame, nation: DataFrame, region: DataFrame, nation_name: str, region_name: str
) -> DataFrame:
    """Members found by the name of their nation inside a region found by name.

    The nested scalar subqueries run first, so the large scan gets a plain
    equality on the key.
    """
    region_key = region.where(F.col("r_name") == region_name).select("r_regionkey").scalar()
    nation_key = (
        nation.where((F.col("n_name") == nation_name) & (F.col("n_regionkey") == region_key))
        .select("n_nationkey")
        .scalar()
    )
    return customer.where(F.col("c_nationkey") == nation_key).select("c_custkey")
