"""Documents for training in five stages, each an operator of `tillmart.llm`.

A stage takes the rows its predecessor kept, as they were written and read again, and
returns them with its decisions applied. All but the last return the columns of
`documents`; the last adds the pieces of each text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import exact_dedup, mixing, near_dedup, pieces, quality_neighbours
from tillmart.session import scratch_dir

# Five-word shingles, linked from this similarity on, in percent.
NEAR = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of all documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_neighbours.keep_good(docs, labels)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_one(docs, percent=NEAR)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes of each source: a document as often, and as much of it, as chosen."""
    return mixing.mixed_documents(docs)


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with `pieces`, the ids of each text, and `n_pieces`."""
    encoded = pieces.encode(docs, pieces.load())
    return encoded.select(
        *(F.col("row")[c].alias(c) for c in docs.columns if c not in ("pieces", "n_pieces")),
        F.col("ids").alias("pieces"),
        F.size("ids").cast("long").alias("n_pieces"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing", mixed),
    ("SentencePiece encoding", in_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned scores and similarity groups have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None
