"""Connected components of links: inside one task with numpy, over a whole table with Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut, cut_and_count


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node of the links a-b that is not the smallest of its component.

    These pairs connect exactly what the links connect, with fewer rows than nodes.
    """
    if not len(a):
        return a[:0], b[:0]
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of the links; root is the smallest node of its component.

    Each round hooks a node to its smallest neighbour, halves the chains and contracts the links to
    the hooked nodes, so the links shrink until none is left; the rounds grow with the logarithm of the
    size. A node with very many links is aggregated in the tasks before any shuffle. Each round is
    written to the shared folder, so a lost executor costs one round at most. No links: an empty table.
    """
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    ends = links.select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo"))
    edges, left = cut_and_count(ends.filter("hi <> lo").distinct(), "edges")
    labels = None
    while left or labels is None:
        hooks = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up"))
        above = hooks.select(F.col("node").alias("mid"), F.col("up").alias("top"))
        hooked = hooks.join(above, F.col("up") == F.col("mid"), "left")
        step = cut(hooked.select("node", F.coalesce("top", "up").alias("root")), "hooks")
        to_hi = step.select(F.col("node").alias("hi"), F.col("root").alias("new_hi"))
        to_lo = step.select(F.col("node").alias("lo"), F.col("root").alias("new_lo"))
        moved = edges.join(to_hi, "hi", "left").join(to_lo, "lo", "left")
        p, q = F.coalesce("new_hi", "hi"), F.coalesce("new_lo", "lo")
        moved = moved.select(F.greatest(p, q).alias("hi"), F.least(p, q).alias("lo"))
        edges, left = cut_and_count(moved.filter("hi <> lo").distinct(), "edges")
        if labels is None:
            labels = step
        else:
            later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            followed = labels.join(later, "root", "left")
            labels = followed.select("node", F.coalesce("next", "root").alias("root")).union(step)
            labels = cut(labels, "labels")
    # A node in the middle of a chain is hooked in more than one round.
    known = labels.union(labels.select(F.col("root").alias("node"), "root"))
    return known.groupBy("node").agg(F.min("root").alias("root"))
