"""Connected components: contracted in tasks, then by alternating stars over written tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from feedgate.llm.common import staged


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``a - b`` as links from each node to the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)`` that is not itself the smallest, its root.

    Each round hangs every node's neighbours under the smallest one, first the larger neighbours,
    then the smaller ones (alternating large and small stars), so rounds grow with the logarithm
    of a component's size.  Minima combine per task; joins on a hot centre are split by adaptive
    execution.  Every round is a written table.
    """
    edges = staged(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    seen = _digest(edges)
    while seen[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least).distinct(), "links")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    """Count and order-free digest of the links: two numbers."""
    bits = F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % (1 << 31))
    return tuple(edges.agg(F.count(F.lit(1)), *bits).first())
