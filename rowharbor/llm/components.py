"""Connected components of a link table by alternating large and small stars.

Each round hangs the larger neighbours of every node on its smallest neighbour, then the smaller ones, until only stars
are left, which the first table of a round tells; long chains shrink by half per round or better. Tables are written between steps, so rounds do not
repeat earlier work, survive lost executors, and join two plain exchanges, of which adaptive execution splits hot partitions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rowharbor.session import cut_lineage


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``, any order); the component is its smallest node.

    NULLs and links of a node to itself are passed over; nodes without any link are not in the result. Links may come twice.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(edges, "links")
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = cut_lineage(_least(both), "least")
        if least.where("open").isEmpty():
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        edges = _small_star(_large_star(both, least))


def _least(both: DataFrame) -> DataFrame:
    """``u, m, open``: the smallest of a node and its neighbours. A node is open if it has several neighbours and a smaller one
    among them; where no node is, every node but the smallest of its component hangs on that one alone."""
    found = both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return found.select("u", F.least("u", "low").alias("m"), ((F.col("low") < F.col("u")) & (F.col("low") != F.col("high"))).alias("open"))


def _large_star(both: DataFrame, least: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, to the smallest of the node and its neighbours; no more edges than there were."""
    hung = both.where(F.col("v") > F.col("u")).join(least.select("u", "m"), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return cut_lineage(hung, "links")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours, to the smallest of them."""
    least = cut_lineage(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    hung = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return cut_lineage(hung.unionAll(own).distinct(), "links")


def reached(links: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that the links of a square block reach from each row; rows of equal id are one."""
    links = links | (ids[:, None] == ids[None])
    order = np.argsort(ids)
    links = links[np.ix_(order, order)]
    label = np.arange(len(ids))
    while True:
        near = np.where(links, label[None], label[:, None]).min(1)
        near = np.minimum(near, label)
        near = near[near]
        if (near == label).all():
            out = np.empty(len(ids), np.int64)
            out[order] = ids[order][label]
            return out
        label = near
