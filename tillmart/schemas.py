"""Declared table schemas, and the checks a database would make on insert.

Lengths and precisions are those of the source and warehouse tables. Two types
are wider on purpose so that values survive large data: ids and keys are
``bigint``, and sums of money are ``decimal(38,2)``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(38, 2)
ID = T.LongType()


def _table(*fields: tuple) -> T.StructType:
    """Fields as (name, type) or (name, type, "required")."""
    return T.StructType([T.StructField(f[0], f[1], nullable=len(f) < 3) for f in fields])


CUSTOMERS = _table(
    ("customer_id", ID, "required"),
    ("customer_name", T.VarcharType(100), "required"),
    ("email", T.VarcharType(100)),
    ("city", T.VarcharType(50)),
    ("country", T.VarcharType(50)),
    ("created_date", T.DateType()),
)

PRODUCTS = _table(
    ("product_id", ID, "required"),
    ("product_name", T.VarcharType(100), "required"),
    ("category", T.VarcharType(50)),
    ("unit_price", MONEY, "required"),
    ("stock_quantity", T.IntegerType()),
)

SALES = _table(
    ("sale_id", ID, "required"),
    ("customer_id", ID, "required"),
    ("product_id", ID, "required"),
    ("quantity", T.IntegerType(), "required"),
    ("unit_price", MONEY, "required"),
    ("total_amount", MONEY, "required"),
    ("sale_date", T.DateType(), "required"),
)

STAGE_CUSTOMERS = _table(
    ("stage_id", ID),
    *[(f.name, f.dataType) for f in CUSTOMERS],
    ("loaded_at", T.TimestampType()),
    ("load_status", T.VarcharType(20)),
)

STAGE_PRODUCTS = _table(
    ("stage_id", ID),
    *[(f.name, f.dataType) for f in PRODUCTS],
    ("loaded_at", T.TimestampType()),
    ("load_status", T.VarcharType(20)),
)

STAGE_SALES = _table(
    *[(f.name, f.dataType) for f in SALES],
    ("load_timestamp", T.TimestampType()),
    ("batch_id", T.IntegerType()),
    ("loaded_by", T.VarcharType(100)),
)

DIM_CUSTOMERS = _table(
    ("customer_key", ID, "required"),
    ("customer_id", ID, "required"),
    ("customer_name", T.VarcharType(100)),
    ("email", T.VarcharType(100)),
    ("city", T.VarcharType(50)),
    ("country", T.VarcharType(50)),
    ("created_date", T.DateType()),
    ("loaded_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

DIM_PRODUCTS = _table(
    ("product_key", ID, "required"),
    ("product_id", ID, "required"),
    ("product_name", T.VarcharType(100)),
    ("category", T.VarcharType(50)),
    ("unit_price", MONEY),
    ("loaded_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

# The largest key a dimension has ever given, so that none is given twice.
KEY_HIGHS = _table(
    ("dimension", T.VarcharType(100), "required"),
    ("highest", ID, "required"),
)

FACT_SALES = _table(
    ("sale_key", ID, "required"),
    ("sale_id", ID, "required"),
    ("customer_key", ID),
    ("product_key", ID),
    ("quantity", T.IntegerType(), "required"),
    ("unit_price", MONEY, "required"),
    ("total_amount", MONEY, "required"),
    ("loaded_at", T.TimestampType()),
    ("sale_date", T.DateType(), "required"),
)

# Sales a load left out, each with the dimension that has no row for it.
FACT_REJECTS = _table(
    ("sale_id", ID),
    ("customer_id", ID),
    ("product_id", ID),
    ("reason", T.VarcharType(10), "required"),
    ("sale_date", T.DateType()),
    ("loaded_at", T.TimestampType()),
)

# Rejects as they lie beside the facts of their load, whose partition column is `sale_date`.
STORED_REJECTS = T.StructType(
    [
        T.StructField("reject_date" if f.name == "sale_date" else f.name, f.dataType, f.nullable)
        for f in FACT_REJECTS
    ]
)

EXECUTIONS = _table(
    ("execution_id", ID, "required"),
    ("operation_id", ID),
    ("folder_name", T.StringType()),
    ("project_name", T.StringType()),
    ("package_name", T.StringType()),
    ("status", T.IntegerType()),
    ("start_time", T.TimestampType()),
    ("end_time", T.TimestampType()),
)

# What a load writes: facts and rejects in one pass, each without the other's columns.
LOADED_SALES = T.StructType(
    [
        *FACT_SALES.fields,
        *(
            T.StructField(f.name, f.dataType)
            for f in STORED_REJECTS
            if f.name not in FACT_SALES.fieldNames()
        ),
    ]
)

# Sums per (date, product) and, in rows of their own, per (date, customer).
DAILY_SUMS = _table(
    ("sale_date", T.DateType(), "required"),
    ("product_key", ID),
    ("customer_key", ID),
    ("by_customer", T.BooleanType(), "required"),
    ("orders", T.LongType()),
    ("items", T.LongType()),
    ("cents", T.LongType()),
    ("least", MONEY),
    ("most", MONEY),
)

SALES_SUMMARY_DAILY = _table(
    ("summary_date", T.DateType(), "required"),
    ("unique_customers", T.LongType()),
    ("total_orders", T.LongType()),
    ("total_items_sold", T.LongType()),
    ("total_revenue", MONEY_SUM),
    ("avg_order_value", MONEY),
    ("min_order_value", MONEY),
    ("max_order_value", MONEY),
    ("top_product_id", ID),
    ("top_product_name", T.VarcharType(100)),
    ("top_product_revenue", MONEY_SUM),
    ("loaded_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

ETL_LOG = _table(
    ("log_id", ID, "required"),
    ("dag_id", T.VarcharType(100)),
    ("task_id", T.VarcharType(100)),
    ("execution_date", T.DateType()),
    ("start_time", T.TimestampType()),
    ("end_time", T.TimestampType()),
    ("status", T.VarcharType(20)),
    ("rows_extracted", T.LongType()),
    ("rows_loaded", T.LongType()),
    ("error_message", T.StringType()),
    ("created_at", T.TimestampType()),
)



def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema]


def frame_schema(schema: T.StructType) -> T.StructType:
    """The schema as a data frame holds it: strings carry no length."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType,
                True,
            )
            for f in schema
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in its types; a value that does not fit fails the job.

    The checks do not depend on ANSI mode: a conversion that would give NULL
    raises, as does one of numbers that would lose digits and a text longer than
    its declared length. Columns that have
    the type already pass through untouched.
    """
    have = {f.name: f.dataType for f in df.schema}
    return df.selectExpr(*[_fit(f, have[f.name]) for f in schema])


def enforce(df: DataFrame, schema: T.StructType, where: str | None = None) -> DataFrame:
    """`conform` plus the NOT NULL constraints of the table, on all rows or those of a condition."""
    have = {f.name: f.dataType for f in df.schema}
    return df.selectExpr(*[_fit(f, have[f.name], not f.nullable, where) for f in schema])


def _fit(
    field: T.StructField, have: T.DataType, required: bool = False, where: str | None = None
) -> str:
    """SQL expression for one column of a checked row."""
    name, branches = field.name, []
    if required:
        missing = f"{name} is null" if where is None else f"{where} and {name} is null"
        branches.append((missing, f"{name} must not be null"))
    if isinstance(field.dataType, T.VarcharType):
        value, limit = f"cast({name} as string)", field.dataType.length
        branches.append((f"length({value}) > {limit}", f"{name} is longer than {limit} characters"))
    elif have == field.dataType:
        value = name
    else:
        wanted = field.dataType.simpleString()
        value = f"try_cast({name} as {wanted})"
        branches.append(
            (f"{name} is not null and {value} is null", f"{name} does not fit {wanted}")
        )
        if isinstance(have, T.NumericType) and isinstance(field.dataType, T.NumericType):
            # Equal after the cast only if no digit was cut or rounded away.
            branches.append((f"{value} <> {name}", f"{name} loses digits as {wanted}"))
    if not branches:
        return name
    checks = " ".join(f"when {when} then raise_error('{text}')" for when, text in branches)
    return f"case {checks} else {value} end as {name}"


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill columns that are missing from the frame; values given stay as they are.

    As in a database, the default applies to a column left out of the insert,
    not to an explicit NULL.
    """
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df
