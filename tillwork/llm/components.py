"""Connected components of a graph of links, by jobs over link rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.common import settle


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links a-b, and the smallest node each hangs together with by these links."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        # where two trees meet, their roots meet too
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def spanning(links: DataFrame, most: int = 500_000) -> DataFrame:
    """Links that keep together what these do: each task's, thinned to a tree per group it sees.

    A dense group of n nodes has up to n * n / 2 links and leaves n - 1. A task hands its trees
    on whenever they have ``most`` links.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.array([], np.int64)
        for batch in batches:
            nodes, roots = forest(np.concatenate([a, batch.column("a").to_numpy()]),
                                  np.concatenate([b, batch.column("b").to_numpy()]))
            a, b = nodes[nodes != roots], roots[nodes != roots]
            if len(a) > most:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a = b = np.array([], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each end of links (a, b).

    Tasks first thin the links they hold to trees. Then each round every node takes the smallest label around it, then its label's label, so labels
    travel ever longer ways. Labels are stored after each round; only the number of changes
    reaches the driver. A hub's links are rows of a join against one row per node, which adaptive
    execution splits, and minima are taken before the shuffle.
    """
    thin = settle(spanning(links), "trees")
    both = settle(thin.union(thin.select("b", "a")).where("a <> b").distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        around = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_near")))
        hooked = settle(labels.join(around, "node").select("node", F.col("root").alias("_old"),
                                                           F.least("root", "_near").alias("root")), "labels")
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("_far"))
        jumped = settle(hooked.join(jump, "root").select("node", "_old", F.col("_far").alias("root")), "labels")
        changed = jumped.where("root <> _old").limit(1).count()
        labels = jumped.select("node", "root")
        if not changed:
            return labels
