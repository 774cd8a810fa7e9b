"""Dimensions: surrogate keys and the full type-1 refresh."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.session import scratch_dir

ROWS_PER_RANGE = 100_000


def dense_index(ids: DataFrame, column: str, name: str, start: int = 0) -> DataFrame:
    """Number the distinct integer ids of ``column`` start+1, start+2, … in id order.

    A ``row_number`` over the whole table would sort everything in one task. Here
    the rows are range-partitioned by id, as many ranges as there are multiples of
    ``ROWS_PER_RANGE`` rows, and written with the number of their range to the
    shared scratch folder; rows are numbered inside their range, and the range's
    offset, a running sum with one row per range, is added. All numbers come from
    the written rows, so a source that changes meanwhile cannot give two rows one key.
    """
    spark = ids.sparkSession
    ranges = ids.select(column).count() // ROWS_PER_RANGE + 1
    path = scratch_dir(spark, "ranges")
    ranged = ids.repartitionByRange(ranges, column).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_range").orderBy(column)
    return (
        rows.withColumn("_rank", F.row_number().over(within))
        .join(offsets, "_range")
        .withColumn(name, (F.col("_offset") + F.col("_rank") + start).cast("bigint"))
        .drop("_range", "_rank", "_offset")
    )


def highest_key(dim: DataFrame | None, key: str) -> int:
    """Largest surrogate key of a dimension, 0 before its first load."""
    return 0 if dim is None else dim.agg(F.max(key)).first()[0] or 0


def assign_keys(
    source: DataFrame,
    natural: str,
    key: str,
    existing: DataFrame | None = None,
    highest: int = 0,
) -> DataFrame:
    """Add a surrogate key: known natural keys keep theirs, new ones follow the largest.

    ``source`` holds one row per natural key; ``existing`` maps natural key to key.
    ``highest`` is the largest key ever given, also to rows that are gone since.
    """
    if existing is None:
        return dense_index(source, natural, key, highest)
    known = existing.select(natural, F.col(key).alias("_known"))
    largest = max(highest, highest_key(existing, key))
    fresh = dense_index(
        source.select(natural).join(known, natural, "left_anti"), natural, "_fresh", largest
    )
    return (
        source.join(known, natural, "left")
        .join(fresh, natural, "left")
        .withColumn(key, F.coalesce("_known", "_fresh"))
        .drop("_known", "_fresh")
    )


def new_dim(source: DataFrame, natural: str, key: str) -> DataFrame:
    """First load of a dimension: key first, then the source columns."""
    return assign_keys(source, natural, key).select(key, *source.columns)


def refresh_dim(
    source: DataFrame,
    natural: str,
    key: str,
    as_of: datetime | str,
    existing: DataFrame | None = None,
    highest: int = 0,
) -> DataFrame:
    """The whole dimension after a type-1 reload from ``source``.

    Rows gone from the source go, and their keys with them: no other row gets a key
    up to ``highest``. Known rows keep key and ``loaded_at``; ``updated_at`` moves only
    when an attribute changed.
    """
    stamp = F.lit(str(as_of)).cast("timestamp")
    if existing is None:
        keyed = assign_keys(source, natural, key, highest=highest)
        return keyed.select(
            key, *source.columns, stamp.alias("loaded_at"), stamp.alias("updated_at")
        )
    attributes = [name for name in source.columns if name != natural]
    keyed = assign_keys(source, natural, key, existing, highest)
    before = existing.select(
        natural,
        F.struct(*attributes).alias("_before"),
        F.col("loaded_at").alias("_loaded_at"),
        F.col("updated_at").alias("_updated_at"),
    )
    same = F.col("_before").eqNullSafe(F.struct(*attributes))
    return keyed.join(before, natural, "left").select(
        key,
        *source.columns,
        F.coalesce("_loaded_at", stamp).alias("loaded_at"),
        F.when(same, F.col("_updated_at")).otherwise(stamp).alias("updated_at"),
    )


def bucket_of(natural: str, buckets: int) -> Column:
    """Bucket of a natural key."""
    return F.pmod(F.hash(F.col(natural)), F.lit(buckets))


def fingerprints(source: DataFrame, natural: str, buckets: int) -> DataFrame:
    """bucket, rows, print: a text that changes with any row of the bucket, but not with their order.

    The print adds up two hashes of each row, so equal prints mean equal rows but for a
    chance of 2**-128. Sums are made before the shuffle; the result has a row per bucket.
    """
    hashes = [F.xxhash64(F.lit(seed), *source.columns).cast("decimal(38,0)") for seed in (1, 2)]
    return (
        source.groupBy(bucket_of(natural, buckets).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"), *(F.sum(h).alias(f"_{i}") for i, h in enumerate(hashes)))
        .select("bucket", "rows", F.concat_ws(":", "rows", "_0", "_1").alias("print"))
    )


def key_map(dim: DataFrame, natural: str, key: str) -> DataFrame:
    """Natural key to surrogate key; the highest key wins when a natural key repeats."""
    return dim.groupBy(natural).agg(F.max(key).alias(key))
