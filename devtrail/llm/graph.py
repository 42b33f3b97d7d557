"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devtrail.session import stage


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as links of each node to the smallest of its local component."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, root):
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for x in batches:
        a, b = stars(x["a"].to_numpy(), x["b"].to_numpy())
        yield pd.DataFrame({"a": a, "b": b})


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (two long columns ``a``,
    ``b``); ``root`` is the smallest node of its connected component.

    Every batch of links first shrinks to a forest in its task.  Then large-star
    and small-star steps alternate until the links no longer change: each is a
    partial aggregate of a node's smallest neighbour joined back, so a node that
    many links share is never gathered in one task (the join's skew is split by
    AQE).  Every round is written to the shared folder, which cuts lineage.
    Null ends and self links are dropped; an empty table gives no rows.
    """
    a, b = links.columns
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    links = links.where(F.col("a") != F.col("b"))
    links = stage(links.mapInPandas(_forest, "a long, b long").distinct(), "links")
    mark = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: every larger neighbour of a node goes to the node's smallest.
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        # Small star: a node's smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s"))
        links = stage(small.select("s.a", "s.b").where(F.col("a") != F.col("b")).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b"), F.col("b")).distinct())
