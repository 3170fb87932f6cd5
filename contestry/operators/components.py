"""Connected components of a graph given as an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.session import materialize


def component_labels(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node on an edge; equal component = connected.

    Each round points every node at its smallest neighbour, follows the pointers
    once, and contracts the graph: edges inside a group vanish and parallel ones
    merge, so the edge table shrinks until it is empty. The rounds' pointers are
    then joined from the last one back. The work is joins and map-side combined
    aggregates over distinct pairs; no node's neighbours are ever gathered.

    After a round most nodes of a large component point at one root. The joins on
    pointers therefore have stored tables on both sides, one of them with unique
    keys, so that adaptive execution can split such a root's rows.
    """
    pairs = materialize(_pairs(edges, F.col(a), F.col(b)), "pairs")
    rounds: list[DataFrame] = []
    while not pairs.isEmpty():
        ends = F.array(F.struct("lo", "hi"), F.struct(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        nearest = (
            pairs.select(F.explode(ends).alias("e"))
            .groupBy(F.col("e.lo").alias("from"))
            .agg(F.min("e.hi").alias("near"))
            .select("from", F.least("from", "near").alias("to"))
        )
        nearest = materialize(nearest, "nearest")
        rounds.append(materialize(_follow(nearest, nearest), "parents"))
        lo, hi = (rounds[-1].select(F.col("from").alias(c), F.col("to").alias(f"new_{c}")) for c in ("lo", "hi"))
        contracted = pairs.join(lo, "lo").join(hi, "hi")
        pairs = materialize(_pairs(contracted, F.col("new_lo"), F.col("new_hi")), "pairs")
    nodes = edges.select(F.explode(F.array(a, b)).alias("node")).distinct()
    if not rounds:
        return materialize(nodes.withColumn("component", F.col("node")), "labels")
    roots = rounds.pop()
    while rounds:
        roots = materialize(_follow(rounds.pop(), roots), "roots")
    known = nodes.join(roots, nodes.node == F.col("from"), "left")
    return materialize(known.select("node", F.coalesce("to", "node").alias("component")), "labels")


def _pairs(df: DataFrame, a, b) -> DataFrame:
    """Distinct undirected edges without loops."""
    return (
        df.filter(a != b).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    )


def _follow(parents: DataFrame, ahead: DataFrame) -> DataFrame:
    """Replace each pointer by the pointer of its target in ``ahead``, if it has one."""
    step = ahead.select(F.col("from").alias("to"), F.col("to").alias("next"))
    return parents.join(step, "to", "left").select("from", F.coalesce("next", "to").alias("to"))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, for a graph of nodes 0 to n - 1 that one task holds.

    Each round hooks every root on an edge to the smallest root it meets, follows
    the pointers to their end, and keeps the edges that still join two roots.
    """
    root = np.arange(n)
    while True:
        a, b = root[a], root[b]
        open_ = a != b
        if not open_.any():
            return root
        a, b = a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(ahead := root[root], root):
            root = ahead
