"""Connected components as DataFrame rounds (no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_enough, stored

#: Edges (two numbers each, 16 bytes) that one task may finish alone.
ONE_TASK_EDGES = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b", one_task: int = 0) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its
    smallest node.

    Rounds of the large-star / small-star scheme: every node's larger
    neighbours, then its smaller ones, are linked to its smallest neighbour,
    until all edges are stars.  The number of edges never grows.  Smallest
    neighbours are partial aggregates and are stored before they are joined,
    so a node with a third of all edges is a skewed join that AQE can split,
    not a group in one task.  Null ends and self-links are ignored.

    ``one_task`` > 0 lets a single task finish a graph of at most so many edges
    (checked on the stored edges before each round): the rounds of a small
    graph cost more than its work.  The result is the same."""
    x, y = F.col(a), F.col(b)
    pairs = stored(edges.where(x.isNotNull() & y.isNotNull() & (x != y))
                   .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    last = None
    while True:
        if one_task and small_enough(pairs, one_task):
            return stored(_finished(pairs))
        pairs, seen = _small_star(_large_star(pairs))
        if seen == last:
            break
        last = seen
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _finished(pairs: DataFrame) -> DataFrame:
    """Components of a bounded number of edges in one task: labels fall to the
    smallest neighbour and are then followed to their ends."""
    def finish(part: dict) -> dict:
        import numpy as np

        ends = np.array([x for xs in part["ends"] for x in xs], np.int64).reshape(-1, 2)
        nodes, at = np.unique(ends, return_inverse=True)
        u, v = at.reshape(-1, 2).T if len(ends) else (at, at)
        label = np.arange(len(nodes))
        while True:
            new = label.copy()
            np.minimum.at(new, u, label[v])
            np.minimum.at(new, v, label[u])
            np.minimum.at(new, label[u], label[v])
            np.minimum.at(new, label[v], label[u])
            new = new[new]
            if (new == label).all():
                return {"node": nodes, "component": nodes[label]}
            label = new

    # One row that holds all edges, so that one call sees them all.
    one = pairs.coalesce(1).agg(F.collect_list(F.array("u", "v")).alias("ends"))
    return map_batches(one, finish, "node long, component long")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node and its
    neighbours.  ``pairs`` has u > v."""
    least = stored(pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")))
    joined = pairs.join(least, pairs["v"] == least["node"], "left")
    return stored(joined.select("u", F.coalesce("low", "v").alias("v")).distinct())


def _small_star(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = stored(pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")))
    joined = pairs.join(least, pairs["u"] == least["node"])
    moved = joined.where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    out = stored(moved.unionByName(least.select(F.col("node").alias("u"), F.col("low").alias("v"))).distinct())
    seen = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return out, tuple(seen)
