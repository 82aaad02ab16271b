"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.session import written

MAX_ROUNDS = 60


def _fingerprint(edges: DataFrame) -> tuple:
    """Tells whether two edge sets are the same."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex links its larger neighbours to the smallest vertex around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    return (
        both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex links its smaller neighbours and itself to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    around = edges.join(low, "u").filter("v <> low")
    moved = around.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``component`` (its smallest vertex) of every vertex that has an edge but is not
    the smallest of its component.

    ``edges`` has ``u`` and ``v`` of one orderable type; loops and repeats do no harm. Each round is
    two joins by vertex, written to the shared folder, so the lineage stays short; minima are
    aggregated before they are shuffled, and a vertex with very many edges is a skewed join, which
    adaptive execution splits. The number of rounds grows with the logarithm of the longest path.
    """
    links = edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = written(links.distinct(), "edges")
    before = _fingerprint(links)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        links = written(_small_star(_large_star(links)), "edges")
        now = _fingerprint(links)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
