"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) of bigints; root is the component's least node.

    Alternates two steps until nothing changes: every node sends its larger neighbours
    to its least neighbour, then its smaller ones. Each is an aggregation and a join, so
    a node with very many neighbours is combined before the shuffle and split by the
    join. Each round is written to the shared folder. Null ends are dropped.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.where("a is not null and b is not null and a > b").distinct(), "edges")
    before = None
    while True:
        edges = written(_to_smaller(_to_larger(edges)), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _to_larger(edges: DataFrame) -> DataFrame:
    """Every node u links its neighbours above it to the least of itself and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _to_smaller(edges: DataFrame) -> DataFrame:
    """Every node u links itself and its neighbours below it to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.withColumnRenamed("m", "b")).distinct()
