"""Embedding near-duplicates by collision-counting projections (operator 7)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm.common import table
from devtrail.llm.graph import components, stars
from devtrail.session import stage

RECALL = 0.985  # of links at the threshold itself, by the collision model
CELL = 1024  # vectors that share a sign prefix, about
WINDOW = 2.0  # half width, in standard deviations of a link's difference
COUNT = 2  # collisions that a pair needs
BLOCK = 4096  # vectors of one cell that meet in one piece of work
UNIT = 1024  # steps of a projection's standard deviation
SEED = 11


def valid_vector(vec: str, vec_id: str) -> Column:
    """A vector that can link: not null, no null or non-finite component, not
    all zero; and a row id."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists(vec, lambda x: x != 0)
    return F.coalesce(F.col(vec_id).isNotNull() & F.col(vec).isNotNull() & finite & some, F.lit(False))


def calibrate(n: int, cosine: float, recall: float = RECALL, cell: int = CELL) -> tuple[int, int]:
    """(signs, rounds): bits of a sign prefix that leave about ``cell`` vectors
    of ``n`` in a cell, and the rounds after which a pair at ``cosine`` has
    collided COUNT times with probability ``recall``."""
    signs = max(0, math.ceil(math.log2(max(n, 1) / cell)))
    p = (1 - math.acos(cosine) / math.pi) ** signs * math.erf(WINDOW / math.sqrt(2))
    rounds = COUNT
    while sum(math.comb(rounds, i) * p**i * (1 - p) ** (rounds - i) for i in range(COUNT)) > 1 - recall:
        rounds += 1
    return signs, rounds


def _codes(signs: int, rounds: int):
    """Per vector and round: the cell (signs of its first projections) and the
    value of its last projection in steps."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            size = b["vec"].map(len).to_numpy()
            cells, steps = [None] * len(b), [None] * len(b)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = np.stack(b["vec"].to_numpy()[at]).astype(float)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x *= math.sqrt(d) / np.linalg.norm(x, axis=1, keepdims=True)
                way = np.random.default_rng([SEED, int(d)]).standard_normal((int(d), rounds, signs + 1))
                way /= np.linalg.norm(way, axis=0)
                y = np.tensordot(x, way, 1)
                cell = (y[:, :, :signs] > 0) @ (1 << np.arange(signs)) if signs else np.zeros((len(at), rounds), int)
                step = np.clip(np.rint(y[:, :, signs] * UNIT), -15000, 15000)
                for k, i in enumerate(at):
                    cells[i], steps[i] = cell[k].astype(np.int32), step[k].astype(np.int32)
            yield pd.DataFrame({"node": b["node"], "size": size.astype(np.int32), "cells": cells, "steps": steps})

    return run


def _linker(cosine: float):
    width = round(WINDOW * math.sqrt(2 - 2 * cosine) * UNIT)

    def link(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """One piece of a cell: links to the smallest node, and each node's
        links (by rows behind its partner) that no earlier round has found."""
        turn, one, two = int(key[0]), int(key[3]), int(key[4])
        steps = np.stack(rows["steps"].to_numpy()).astype(np.int16)
        order = np.argsort(steps[:, turn], kind="stable")
        steps = np.ascontiguousarray(steps[order].T)
        cells = np.ascontiguousarray(np.stack(rows["cells"].to_numpy())[order].T)
        x = np.stack(rows["vec"].to_numpy()[order]).astype(float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        node, many, own = (rows[c].to_numpy()[order] for c in ("node", "many", "own"))
        n, found = len(node), np.zeros(len(node), np.int64)
        a = b = np.zeros(0, np.int64)
        until = np.searchsorted(steps[turn], steps[turn].astype(int) + width, "right")
        for s in range(0, n, 256):
            e, far = min(s + 256, n), int(until[min(s + 256, n) - 1])
            # Window of the sorted projection around each of the block's vectors, later ones only.
            mine = np.arange(s, far) < until[s:e, None]
            mine &= np.arange(s, far) > np.arange(s, e)[:, None]
            if one != two:
                mine &= own[s:e, None] != own[None, s:far]
            times, judged = mine.astype(np.int16), np.zeros(mine.shape, bool)
            for r in range(len(steps)):
                if r == turn:
                    continue
                hit = np.abs(steps[r, s:e, None] - steps[r, None, s:far]) <= width
                hit &= cells[r, s:e, None] == cells[r, None, s:far]
                if r < turn:  # a pair is judged in its first collision's round
                    judged |= hit
                else:
                    times += hit
            i, j = np.nonzero(mine & ~judged & (times >= COUNT))
            if not len(i):
                continue
            i, j = i + s, j + s
            right = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + 50_000]], x[j[k:k + 50_000]]) for k in range(0, len(i), 50_000)]) >= cosine
            i, j = i[right], j[right]
            found += np.bincount(i, many[j], n).astype(np.int64) + np.bincount(j, many[i], n).astype(np.int64)
            a, b = stars(np.concatenate([a, node[i]]), np.concatenate([b, node[j]]))
        at = np.flatnonzero(found)
        return pd.DataFrame({"a": np.concatenate([a, node[at]]), "b": pd.array([*b, *[None] * len(at)], "Int64"),
                             "links": np.concatenate([np.zeros(len(a), np.int64), found[at]])})

    return link


def embedding_dedup(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", cosine: float = 0.9,
                    recall: float = RECALL) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors linked directly), ``component_id``
    (smallest vec_id reachable by links) and ``kept`` (vec_id = component_id)
    of every row of ``vectors``.

    Each round has a random projection of its own; vectors are sorted by it
    inside the cell of the signs of a few more projections, which keep a window's
    rows bounded as the table grows.  A pair collides in a round if it shares
    the cell and one lies in the window centred on the other.  A pair is judged
    in the first round where it collides: its collisions over all rounds are
    counted, and a pair with COUNT or more is verified by its cosine in double
    precision.  Rounds are calibrated for ``recall`` at the threshold itself.

    Equal vectors are one node with a weight, so copies form no pairs.  A cell
    of more than BLOCK vectors is cut into blocks whose pairs are dealt to
    different tasks.  A piece returns each node's count and a forest of its
    links, so a dense group returns rows in proportion to its nodes.

    Vectors that are null, zero, or hold null or non-finite components, and rows
    without an id, link with nothing (a null id: component null, not kept).
    Rows that repeat are linked copies; vectors of different lengths never link.
    Vectors may be of any length.  An empty table gives no rows; other columns
    are not read, whatever their names.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).alias("vec"), valid_vector(vec, vec_id).alias("ok"))
    nodes = rows.where("ok").groupBy("vec").agg(F.min("vec_id").alias("low"), F.count("*").alias("many"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "embedding-nodes")
    signs, rounds = calibrate(nodes.count(), cosine, recall)
    codes = stage(nodes.select("node", "vec").mapInPandas(
        _codes(signs, rounds), "node long, size int, cells array<int>, steps array<int>"), "embedding-codes")
    key = ["turn", "size", "cell"]
    places = codes.select("node", "size", F.posexplode("cells").alias("turn", "cell"))
    large = places.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    places = places.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    places = places.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    places = places.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    places = places.select("node", *key, "own", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    full = places.join(codes.select("node", "cells", "steps").join(nodes.select("node", "vec", "many"), "node"), "node")
    found = stage(full.groupBy(*key, "one", "two").applyInPandas(_linker(cosine), "a long, b long, links long"), "embedding-links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    named = nodes.join(counts, "node", "left").join(roots, "node", "left").select(
        "vec", "low", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component"))
    named = named.join(lows, "root").select(F.col("vec").alias("same"), "n_links", "component")
    out = rows.join(named, F.col("ok") & (F.col("vec") == F.col("same")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, reach) AS (SELECT DISTINCT a, a FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
  coalesce(e.vec_id = coalesce(component_id, e.vec_id), false) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.vec_id LEFT JOIN c ON e.vec_id = c.vec_id
"""
