"""Connected components by alternating large-star and small-star (Kiveris et al., 2014).

Each half round is one aggregate (a node's least neighbour, with partial minima before the shuffle) and one
join of the edges to it; both sides are read from written tables, so Spark can split the partition of a
node with very many edges.  The rounds end when a large-star and a small-star change nothing; the number of
edges never grows.  Nothing but a row count and a checksum comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankspark.session import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b); component is the least node reachable."""
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = _small_star(_large_star(now))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def _least(pairs: DataFrame) -> DataFrame:
    """Least neighbour (or self) of each node u of pairs (u, v)."""
    return written(pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
                   .select("node", F.least("node", "low").alias("low")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    # a node's larger neighbours are the u of the edges in which it is v
    return written(edges.join(least, edges["v"] == least["node"]).select("u", F.col("low").alias("v")).distinct(), "edges")


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    linked = edges.join(least, edges["u"] == least["node"]).select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = least.select(F.col("node").alias("u"), F.col("low").alias("v"))
    return written(linked.unionByName(own).filter("u <> v").distinct(), "edges")
