"""Aggregates over money and counts, with the result types of the mart tables.

Sums of money run over whole cents in a ``bigint``. A sum over ``decimal(10,2)``
has 20 digits, which Spark keeps as an object per group and in 24 bytes of every
shuffled row; the cents take 8 bytes and stay exact up to 9 * 10**16 in a sum.
Beyond that ANSI mode, which `session.configure` sets, raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def whole_sum(amount: str | Column) -> Column:
    return F.sum(amount).cast("bigint")


def cents(amount: str | Column) -> Column:
    value = F.col(amount) if isinstance(amount, str) else amount
    return (value.cast("decimal(10,2)") * F.lit(100)).cast("bigint")


def cents_sum(amount: str | Column) -> Column:
    return F.sum(cents(amount))


def from_cents(value: str | Column) -> Column:
    """Money of a number of cents, as ``decimal(38,2)``."""
    whole = F.col(value) if isinstance(value, str) else value
    return (whole.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,2)")


def average_cents(total: Column, rows: Column) -> Column:
    """Average of a sum in cents, rounded once, half away from zero, to two places.

    The quotient keeps 18 digits after the point; ``avg`` over a small decimal
    would go through a double.
    """
    money = total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    return (money / rows).cast("decimal(10,2)")
