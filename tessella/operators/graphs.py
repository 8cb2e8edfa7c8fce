"""Connected components by alternating stars.

Each round joins the larger neighbours of every node to the smallest neighbour,
and then the smaller ones, until all components are stars around their smallest
node. Whatever the order of the nodes along a chain, the rounds grow with the
logarithm of its length. A node with very many neighbours is a join key like
others: both sides of the joins are written tables, so that adaptive execution
may split it. No join goes through the driver: files of a few MB may hold much
more than that, and a broadcast a round would grow with the graph.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.session import discard, stored

#: Edges, a few MB, up to which one task settles them all.
ALONE = 100_000


def _settled(frames):
    """The smallest node of each node's component, by union-find."""
    parent: dict = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for frame in frames:
        for a, b in zip(frame["a"], frame["b"]):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    yield pd.DataFrame({"node": list(parent), "comp": [root(x) for x in parent]})


def components(edges: DataFrame, alone: int | None = None) -> DataFrame:
    """(node, comp): the smallest node of each connected component of ``edges`` (a, b).

    Edges with a null and those from a node to itself are left out; direction and
    repeats don't matter; no edges give no rows. Up to ``alone`` edges are settled
    in one task, more of them in rounds.
    """
    alone = ALONE if alone is None else alone
    left = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    left = stored(left, "edges")
    kind = left.schema["a"].dataType.simpleString()
    if left.count() <= alone:
        out = stored(left.coalesce(1).mapInPandas(_settled, f"node {kind}, comp {kind}"), "components")
        discard(left)
        return out
    mark = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    seen = mark(left)
    while True:
        # every node sends its larger neighbours to the smallest of its neighbours and itself
        both = stored(left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b"))), "neighbours")
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = stored(both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-stars")
        # and then itself and its smaller ones
        lower = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = large.join(lower.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, left = left, stored(moved.union(lower.select("a", F.col("m").alias("b"))).distinct(), "small-stars")
        discard(before, both, least, large, lower)
        now = mark(left)
        if now == seen:
            centres = left.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
            out = stored(left.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(centres), "components")
            discard(left)
            return out
        seen = now
