"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import written

ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); component is the smallest node reached.

    Each round links a node's larger neighbours, then its smaller ones, to the smallest node
    around it; the number of rounds grows with the logarithm of the nodes. Only minima per
    node are aggregated, so a node with any number of links is no problem.
    """
    edges = written(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(edges)
    for _ in range(ROUNDS):
        edges = written(_star(_star(edges, large=True), large=False), "stars")
        before, mark = mark, _mark(edges)
        if mark == before:
            stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return stars.unionAll(roots)
    raise RuntimeError(f"components have not settled in {ROUNDS} rounds")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node to the least node around it."""
    both = edges.select("u", "v")
    if large:
        both = both.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    near = both.join(least, "u")
    if large:
        out = near.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        out = near.select("v", "least").unionAll(least.select(F.col("u").alias("v"), "least"))
        out = out.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return out.filter("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
    ).first()
    return tuple(row)
