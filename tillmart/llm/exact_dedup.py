"""Exact dedup by content sort (operator 7), DataFrame functions only.

Sampled splitters range-partition the texts, each partition is sorted, and equal
texts, now adjacent, are compared in full by a window whose key is the text. The
splitters are taken from the first `HEAD` characters and a hash, so that the sample
the driver sees has short rows; the whole text follows in the sort key.

All rows of a text lie together, unless they are more than `HOT_ROWS` and more than
`1 / HOT_SHARE` of all rows. Such a text, of which there are at most `HOT_SHARE`, gets a salt
for each part of that size, so that no task sees more; the first rows of its parts are compared in
full once more. Which row stays is a parameter; the query keeps the largest doc_id.

Defined results: a null text equals the empty text. A null id sorts below all
ids. Rows repeated with the same id and text are copies of which one stays. An
empty table gives an empty result. Other columns of the input are ignored by
`content_groups` and kept by `drop_copies`, under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import written

HOT_ROWS = 1_000
HOT_SHARE = 10_000
HEAD = 24


def content_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    hot_rows: int = HOT_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    best, _ = _choice(keep)
    runs = written(sorted_runs(docs, id_col, text_col, keep, hot_rows, hot_share), "content-runs")
    # The parts of hot texts: at most one row for each `hot_rows` rows, compared in full.
    groups = written(
        runs.filter("part_text is not null")
        .groupBy("part_text")
        .agg(
            F.first("digest").alias("digest"),
            best(F.col("part_best")).alias("best"),
            F.sum("part_size").alias("size"),
        )
        .select("digest", "best", "size"),
        "hot-groups",
    )
    joined = runs.join(F.broadcast(groups), "digest", "left")
    keep_id = F.when(F.col("size").isNull(), F.col("part_best")).otherwise(F.col("best"))
    return joined.withColumn("keep_id", keep_id).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.coalesce("size", "part_size").alias("group_size"),
        (F.col("first") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def sorted_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    hot_rows: int = HOT_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """id, digest, first, part_best, part_size, part_text of each row after the sort.

    Equal neighbours form a run, whose first row is the one that stays of it. `part_text` is the
    text of the first row of a hot text's part, null in all other rows.
    """
    best, order = _choice(keep)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    bound = max(hot_rows, docs.count() // hot_share)
    hot = written(
        rows.groupBy("hash")
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > bound)
        .select("hash", F.ceil(F.col("rows") / bound).alias("salts")),
        "hot-texts",
    )
    salted = (
        rows.join(F.broadcast(hot), "hash", "left")
        .withColumn("head", F.left("text", F.lit(HEAD)))
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(-1)))
        .drop("salts")
    )
    # The range partitioning by the first three serves the window by all four.
    splitters = ["head", "hash", "salt"]
    part = Window.partitionBy(*splitters, "text")
    first = F.col("place") == 1
    return (
        salted.repartitionByRange(*splitters)
        .withColumn("place", F.row_number().over(part.orderBy(order(F.col("id")))))
        .withColumn("part_best", best(F.col("id")).over(part))
        .withColumn("part_size", F.count(F.lit(1)).over(part))
        .select(
            "id",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            first.alias("first"),
            "part_best",
            "part_size",
            F.when(first & (F.col("salt") >= 0), F.col("text")).alias("part_text"),
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one for each text."""
    groups = content_groups(docs, id_col, text_col)
    kept = groups.filter("kept").select(F.col(id_col).alias("id"), "text_sha256").hint("merge")
    rows = docs.select(F.struct(*docs.columns).alias("row")).withColumn(
        "digest", F.sha2(F.coalesce(F.col(f"row.{text_col}"), F.lit("")), 256)
    )
    same = F.col(f"row.{id_col}").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("text_sha256"))
    rows = rows.join(kept, same, "left_semi")
    again = groups.filter(~F.col("kept") & F.col(id_col).eqNullSafe(F.col("keep_id")))
    # Rows with the id and the text of one that stays: left to the last step, which few tables need.
    if not again.isEmpty():
        rows = rows.withColumn("id", F.col(f"row.{id_col}")).dropDuplicates(["id", "digest"])
    return rows.select("row.*")


def _choice(keep: str):
    if keep == "largest":
        return F.max, Column.desc_nulls_last
    if keep == "smallest":
        return F.min, Column.asc_nulls_last
    raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
