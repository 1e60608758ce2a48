"""Connected components by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.shared import fresh_path, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node itself, are tied to the smallest of them. Edges run from the larger id."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(id, component) for each node of an undirected edge list; component is the smallest id of the node's component.

    Loops, nulls and repeated edges do no harm; nodes without an edge to another node
    have no row.  The minimum of a node's neighbours is aggregated before the shuffle and
    joined back, so a hub with a third of all edges is split by adaptive execution.  Each
    round is written to the shared folder, over the one before the last, so two copies of
    the edges are there at a time.  Not converged after max_rounds: an error.
    """
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    spark = edges.sparkSession
    places = fresh_path(spark, "edges"), fresh_path(spark, "edges")
    now, before = staged(pairs, "edges", places[0]), None
    for turn in range(max_rounds):
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if mark.n == 0 or mark == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        before = mark
        now = staged(_small_star(_large_star(now).distinct()).distinct(), "edges", places[(turn + 1) % 2])
    raise RuntimeError(f"components didn't converge in {max_rounds} rounds")
