import numpy as np
from pyspark.sql import functions as F

from devtrail.llm import embeddings
from devtrail.llm.embeddings import calibrate, embedding_dedup, op7_embedding_dedup

SF = "/root/testdata/sf0.1"


def brute(rows, cosine=0.9):
    """rows: (id, vector) -> links per id, component per id, and the links."""
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T) >= cosine
    np.fill_diagonal(near, False)
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in zip(*np.nonzero(near)):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return near.sum(axis=1), [low[find(k)] for k in range(len(rows))]


def compare(got, rows):
    links, comps = brute(rows)
    n = sum(got[i].n_links for i, _ in rows)
    assert all(got[i].n_links <= m for (i, _), m in zip(rows, links)), "a link below the threshold"
    assert n >= 0.97 * links.sum()
    same = sum(got[i].component_id == c for (i, _), c in zip(rows, comps))
    assert same >= 0.97 * len(rows)
    assert all(g.kept == (g.vec_id == g.component_id) for g in got.values())
    return int(links.sum())


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare({r.vec_id: r for r in op7_embedding_dedup(spark, SF).collect()}, rows)


def test_recall_with_cells_blocks_and_links_at_the_threshold(spark, monkeypatch):
    """Small cells and blocks: many rounds, cut cells, a dense group, copies."""
    monkeypatch.setattr(embeddings, "BLOCK", 60)
    monkeypatch.setattr(embeddings, "CELL", 40)
    monkeypatch.setattr(embeddings, "calibrate", lambda n, c, r: calibrate(n, c, r, 40))
    rnd = np.random.default_rng(10)
    base = rnd.normal(size=(1200, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = rnd.normal(size=base.shape)
    noise -= (noise * base).sum(1, keepdims=True) * base
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cos = rnd.uniform(0.88, 0.94, (1200, 1))
    near = cos * base + np.sqrt(1 - cos**2) * noise
    dense = base[0] + rnd.normal(scale=0.05, size=(300, 32))
    x = np.concatenate([base, near, dense, dense[:5], dense[:5]]).astype(np.float32)
    rows = list(enumerate(x.astype(float).tolist()))
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
    assert compare({r.vec_id: r for r in embedding_dedup(df).collect()}, rows) > 10_000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [0.0, 0.0]),
            (None, [1.0, 0.0]), (8, [1.0]), (9, []), (10, [0.0, 1e-30]), (11, [0.0, 1e30]), (12, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash"))
    got = sorted((tuple(r) for r in embedding_dedup(df).collect()), key=str)
    want = [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, False), (10, 1, 10, True), (11, 1, 10, False)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12)]
    assert got == sorted(want, key=str)
    assert embedding_dedup(df.limit(0)).count() == 0


def test_calibration_grows_with_the_table():
    assert calibrate(100, 0.9)[0] == 0 and calibrate(10**9, 0.9)[0] == 20
    assert calibrate(10**6, 0.9)[1] > calibrate(10**4, 0.9)[1]


def test_a_pair_is_judged_once_however_many_rounds():
    """A pair that collides in every round of a very large table's calibration counts once."""
    import pandas as pd

    for rounds in (90, 121, 141, 300):
        rows = pd.DataFrame({"node": [0, 1], "many": [1, 1], "own": [0, 0], "vec": [np.array([1.0, 0.5]), np.array([1.0, 0.5001])],
                             "cells": [np.zeros(rounds, np.int32)] * 2, "steps": [np.zeros(rounds, np.int32), np.ones(rounds, np.int32)]})
        out = [embeddings._linker(0.9)((turn, 2, 0, 0, 0), rows) for turn in range(rounds)]
        assert sum(o["links"].sum() for o in out) == 2, rounds
        assert [int(o["b"].notna().sum()) for o in out][0] > 0, rounds
