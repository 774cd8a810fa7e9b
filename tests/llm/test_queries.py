"""Corpus queries against SQL, and the pipeline's stages against their operators."""

import pytest

import corpus_pipeline
from tests.compare import connect, duck_rows, spark_rows
from tillmart.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, key):
    names, expected = duck_rows(connect(FOLDER), ORACLE[key])
    result = QUERIES[key](spark, FOLDER)
    assert sorted(result.columns) == sorted(names)
    assert spark_rows(result) == expected


def test_one_query_an_operator():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == [*docs.columns, "pieces", "n_pieces"]
    rows = result.collect()
    assert 0 < len({r["doc_id"] for r in rows}) <= docs.count()
    assert all(len(r["pieces"]) == r["n_pieces"] > 0 for r in rows)
