"""Connected components of links that do not fit one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.session import cut_lineage


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each of ``n`` places by the links (a[i], b[i])."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor("u"), F.bit_xor("v"),
        F.bit_xor(F.xxhash64("u", "v")),
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that ``links`` (a, b) names.

    Large-star and small-star rounds alternate until nothing changes: each node's links move to its
    smallest neighbour, so that trees flatten to stars in about log(nodes) rounds. A round is minima
    (combined ahead of the shuffle) joined back; a node with many links is a skewed join that
    adaptive execution splits, never one group. Each round is written to the shared folder. No link
    gives no row; null ends and loops are ignored.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = links.where(F.col("a") != F.col("b")).select(high.alias("u"), low.alias("v"))
    edges = cut_lineage(edges.distinct())
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
