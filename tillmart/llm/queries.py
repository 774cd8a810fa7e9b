"""One query per corpus operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import (
    collocations,
    decontamination,
    divergence,
    exact_dedup,
    mixing,
    near_dedup,
    pieces,
    quality_neighbours,
    quality_rules,
    secrets,
    substring_dedup,
    toxicity,
    warc,
)
from tillmart.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(_table(spark, folder, "documents")).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.train(docs, _table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(toxicity.fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT, F.lit(False)).alias(
            "held_out"
        ),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_exact",
        "n_near",
        "n_quoted",
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = pieces.load()
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, vocabulary).select(
        "row.doc_id", F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("text_sha256"), "ids"
    )
    return pieces.decode(encoded, vocabulary).select(
        "row.doc_id",
        F.size("row.ids").cast("long").alias("n_pieces"),
        "row.ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("row.text_sha256")).alias("exact"),
    )


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.components(_table(spark, folder, "documents"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.content_groups(_table(spark, folder, "documents"))


def op8_quality_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality_neighbours.train(docs, _table(spark, folder, "labels"))
    held_out = toxicity.fold("doc_id", quality_neighbours.FOLDS) == quality_neighbours.HELD_OUT
    return quality_neighbours.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality_neighbours.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id",
        *map(count, secrets.KINDS),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text().alias("spans"),
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, folder, "pages"))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(_table(spark, folder, "documents"))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return decontamination.find_leaks(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_pieces": op5_pieces,
    "op6_near_dedup": op6_near_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality_neighbours": op8_quality_neighbours,
    "op9_secrets": op9_secrets,
    "op10_warc": op10_warc,
    "op11_divergence": op11_divergence,
    "op12_collocations": op12_collocations,
    "op13_decontamination": op13_decontamination,
}
