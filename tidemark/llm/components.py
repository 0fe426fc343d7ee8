"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Work

MOST_ROUNDS = 100


def components(edges: DataFrame, work: Work, name: str) -> DataFrame:
    """Vertices of ``edges`` (a, b) with the smallest vertex of their component, as (v, root).

    Each round hangs every vertex's larger neighbours, then its smaller ones, on the smallest
    vertex among them. The number of edges does not grow, and few rounds are needed: a power of
    the logarithm of the longest path. Every round is written, so a lost executor costs one.
    """
    edges = _forward(edges)
    edges = work.write(edges, f"{name}-edges")
    seen = None
    for step in range(MOST_ROUNDS):
        edges = _star(edges, work, f"{name}-{step}-large", large=True)
        edges = _star(edges, work, f"{name}-{step}-small", large=False)
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")
        ).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("b")).distinct().select(F.col("b").alias("v"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(roots)


def _forward(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller vertex, each once."""
    return (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(edges: DataFrame, work: Work, name: str, large: bool) -> DataFrame:
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("w"))
    if large:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("w")))
    least = near.groupBy("u").agg(F.min("w").alias("m"))
    least = work.write(least.select("u", F.least("u", "m").alias("m")), f"{name}-least")
    hung = near.join(least, "u")
    if large:
        moved = hung.filter(F.col("w") > F.col("u")).select(F.col("w").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("w").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return work.write(_forward(moved), name)
