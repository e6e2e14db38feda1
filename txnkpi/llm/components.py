"""Connected components of a graph given as a table of edges, by alternating stars.

Each round joins a node's neighbours to the least of them: first the greater neighbours of
every node, then the smaller ones. The number of edges does not grow, rounds are few even for
long chains, a node with very many neighbours is reduced by partial sums, and every round is a
written table, so a lost executor costs that round only. Rounds end when the edges are stars: a
check with one shuffle, where a further round to see that nothing changes would take six.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnkpi.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = both.join(least, "a").filter("b > a and b != m")
    return moved.select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges are (a, b) with a < b: each b links its other smaller neighbours to the least."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").filter("a != m").select(F.col("m").alias("x"), F.col("a").alias("y"))
    stay = least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return moved.union(stay).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """No node is the greater end of two edges, or of one and the smaller end of another."""
    ends = F.array(*(F.struct(F.col(c).alias("node"), F.lit(up).alias("up")) for up, c in enumerate("ab")))
    nodes = edges.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("n"))
    return not nodes.agg(F.bool_or(F.expr("up > 0 and n > 1"))).head()[0]


def stars(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) for all nodes of the written edges (a, b) but the least of each component."""
    edges = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    done, rounds = edges.isEmpty(), 0
    while not done:
        if rounds == most_rounds:
            raise RuntimeError(f"components not found in {most_rounds} rounds")
        edges = written(_small_star(_large_star(edges)), "edges")
        done, rounds = _are_stars(edges), rounds + 1
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b); a component is its least node."""
    leaves = stars(written(edges.distinct(), "edges"), most_rounds)
    roots = leaves.select(F.col("component").alias("node"), "component")
    return written(leaves.union(roots).distinct(), "components")
