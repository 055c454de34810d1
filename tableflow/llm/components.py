"""Connected components of a graph given by its edges, by stars that grow and shrink in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node that it reaches) for every node of the edges a, b.

    In a round every node first points its larger neighbours to its least one, then its smaller
    neighbours. The rounds, about the logarithm of the longest path, end when nothing changes.
    Each round's edges are written to the shared scratch folder, so no lineage grows.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "edges")
    mark = _mark(edges)
    while True:
        edges = written(_smaller(_larger(edges)), "edges")
        mark, before = _mark(edges), mark
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Tells two sets of edges apart."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _larger(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"),
                                                           F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")) \
        .select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, F.col("a") == F.col("node")) \
        .select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node")) \
        .select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return others.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
