"""Stored mart tables.

Every load writes its parts into folders of its own, `<table>/load=<load>/...`, and a version
(`versions`) says which loads and parts make up a table. Facts and rejects are divided by sale
date and written together, the rejects of a load into the folder of rows without a partition date; kept daily sums lie in one folder a load and are told apart by row;
dimensions are divided by bucket of the natural key; the summary is whole.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart import schemas
from tillmart.sources import versions
from tillmart.sources.versions import Version

# Folder of a table, and where a part lies in the folder of a load.
FOLDERS = {
    "fact_sales": ("sales", "sale_date={}"),
    "fact_rejects": ("sales", ""),
    "daily_sums": ("daily_sums", ""),
    "dim_customers": ("dim_customers", "bucket={}"),
    "dim_products": ("dim_products", "bucket={}"),
    "key_highs": ("key_highs", ""),
    "sales_summary_daily": ("sales_summary_daily", ""),
    "stage_sales": ("stage_sales", ""),
    "stage_customers": ("stage_customers", ""),
    "stage_products": ("stage_products", ""),
    "executions": ("executions", "log_date={}"),
    "latest_executions": ("latest_executions", "log_date={}"),
}

# Tables that grow with the sales.
PACKED = {"fact_sales", "daily_sums"}


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schemas.frame_schema(schema))


# Where Spark puts rows whose partition column is null.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def load_path(root: str, table: str, load: str) -> str:
    return f"{root}/{FOLDERS[table][0]}/load={load}"


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    version: Version,
    schema: T.StructType,
    low: date | str | None = None,
    high: date | str | None = None,
) -> DataFrame:
    """A table as a version has it, or its parts from `low` to `high`.

    Only folders that the version names are listed and read. A load that still holds all it wrote
    is read as one folder.
    """
    folder, inner = FOLDERS[table]
    paths = []
    for load, parts in version.parts(table).items():
        base = f"{root}/{folder}/load={load}"
        wanted = parts if low is None else versions.covers(parts, str(low), str(high))
        if not inner or (len(wanted) == len(parts) and version.is_whole(table, load)):
            paths += [f"{base}/{inner}".rpartition("/")[0]] if wanted else []
        else:
            paths += [f"{base}/{inner.format(part)}" for part in wanted]
    if not paths:
        return empty_frame(spark, schema)
    reader = spark.read.schema(schemas.frame_schema(schema)).option("basePath", f"{root}/{folder}")
    rows = reader.parquet(*paths)
    if table == "fact_sales":
        rows = rows.where("sale_date is not null")  # the folder of rejects, which is not listed further
    return rows.select(*schema.fieldNames())


def read_by_row(
    spark: SparkSession,
    root: str,
    table: str,
    version: Version,
    schema: T.StructType,
    low: date | str | None = None,
    high: date | str | None = None,
    inner: str = "",
    column: str = "sale_date",
) -> DataFrame:
    """A table whose loads have one folder each and whose rows tell their date by ``column``.

    Dates that were loaded again since are passed over by a join with the dates each load
    holds: a row per date, and none at all if every load still holds what it wrote.
    """
    folder = FOLDERS[table][0]
    held = {
        load: dates if low is None else versions.covers(dates, str(low), str(high))
        for load, dates in version.parts(table).items()
    }
    paths = [f"{root}/{folder}/load={load}/{inner}".rstrip("/") for load, dates in held.items() if dates]
    if not paths:
        return empty_frame(spark, schema)
    reader = spark.read.schema(schemas.frame_schema(schema)).option("basePath", f"{root}/{folder}")
    rows = reader.parquet(*paths)
    if low is not None:
        rows = rows.where(F.col(column).between(F.lit(str(low)).cast("date"), F.lit(str(high)).cast("date")))
    if not all(version.is_whole(table, load) for load in held):
        owners = spark.createDataFrame(
            [(load, date.fromisoformat(day)) for load, days in held.items() for day in days],
            f"load string, {column} date",
        )
        rows = rows.join(F.broadcast(owners), ["load", column], "left_semi")
    return rows.select(*schema.fieldNames())


def write_load(
    df: DataFrame, root: str, table: str, load: str, *by: str
) -> None:
    """Write the rows of a load into its folder, divided by the columns given.

    Nobody reads the folder before the load commits, so tasks may move their files into place
    themselves; the driver would move thousands of dates one by one. A task that runs again
    replaces its own files.
    """
    writer = df.write.partitionBy(*by).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    if table in PACKED:
        writer = writer.option("compression", "zstd")
    writer.parquet(load_path(root, table, load))


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        return empty_frame(spark, schema)
    return spark.read.schema(schemas.frame_schema(schema)).parquet(path)


def seed_if_empty(df: DataFrame, path: str, schema: T.StructType) -> bool:
    """Write seed rows with their own ids, but only into an empty table."""
    spark = df.sparkSession
    if not read_rows(spark, path, schema).isEmpty():
        return False
    schemas.enforce(df, schema).write.mode("append").parquet(path)
    return True
