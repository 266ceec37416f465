"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the ``a``-``b`` edges; the component is its smallest node.

    Each round links every node to the smallest neighbour it knows, so rounds
    grow with the logarithm of a component's width.  Edges are only ever
    joined with one minimum per node and reduced by partial aggregation; no
    component is collected.  Every round is written to the shared folder.
    """
    def towards(pairs, larger_only):
        """Pairs (v, least of u's neighbours and u) for the neighbours v of u."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        linked = pairs.join(least, "u")
        kept = linked.where("v > u") if larger_only else linked
        return kept, least

    current = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .where("u != v").distinct())
    mark = _mark(current)
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        kept, _ = towards(both, True)
        large = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: u > v holds now, so the neighbours of u are all smaller.
        kept, least = towards(large, False)
        small = (kept.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        current = cut_lineage(small)
        after = _mark(current)
        if after == mark:
            break
        mark = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _mark(pairs: DataFrame):
    """Count and two order-free sums that tell whether the edges have changed."""
    h = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())
