"""Connected components of links between numbers, without one node's links meeting in one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.session import keep

ROUNDS = 60


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, root)`` for each node of the links ``a - b`` that is not its component's smallest."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, left, right = np.arange(len(nodes)), place[: len(a)], place[len(a):]
    while True:
        x, y = root[left], root[right]
        apart = x != y
        if not apart.any():
            break
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _once(links: DataFrame) -> DataFrame:
    return keep(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")


def _smallest(links: DataFrame) -> DataFrame:
    """``node, least``: the smallest of each node and its neighbours in ``links`` (a, b)."""
    found = links.groupBy("a").agg(F.min("b").alias("least"))
    return keep(found.select(F.col("a").alias("node"), F.least("a", "least").alias("least")), "least")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b); the root is its component's smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the smallest
    node it knows, then its smaller ones.  A step sums per node before it shuffles, and its joins read written
    tables, so adaptive execution can split a node with many links.
    """
    links, before = _once(links), None
    for _ in range(ROUNDS):
        both = links.union(links.select("b", "a"))
        large = both.join(_smallest(both), F.col("a") == F.col("node")).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = _once(large)
        near = links.join(_smallest(links), F.col("a") == F.col("node"))
        links = _once(near.select("b", "least").toDF("a", "b").union(near.select("a", "least").toDF("a", "b")))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links still change after {ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct().toDF("node", "root"))
