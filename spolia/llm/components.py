"""Connected components by alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spolia.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """`node`, `component` (smallest node reachable) of every node of the links `a`, `b`; nodes without links are absent.

    Links to oneself and repeated links do no harm; null ends are ignored.  Each round is written to the shared
    folder, which cuts the lineage; the rounds grow with the logarithm of the longest chain.  A node with very
    many links is only ever aggregated or joined, never collected.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        least = least.select("n", F.least("n", "low").alias("low"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.where("a <> b").distinct(), "large")
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        joined = large.join(low, F.col("a") == F.col("n"))
        small = joined.select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = written(small.select("e.a", "e.b").where("a <> b").distinct(), "small")
        parents = edges.select(F.col("b").alias("a")).distinct()
        if edges.join(parents, "a", "left_semi").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(parents.select("a", "a"))


def roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component under the links (a, b)."""
    while True:
        pa_, pb = parent[a], parent[b]
        low = np.minimum(pa_, pb)
        before = parent.copy()
        np.minimum.at(parent, pa_, low)
        np.minimum.at(parent, pb, low)
        while (jump := parent[parent] != parent).any():
            parent[jump] = parent[parent[jump]]
        if (parent == before).all():
            return parent
