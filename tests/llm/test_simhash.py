import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from devtrail.llm import simhash
from devtrail.llm.simhash import first_of_each, one_of_each, op10_simhash_dedup, simhash_dedup, simhash_links
from tests.llm.conftest import SF


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, distance=3):
    """fps: {id: fingerprint} -> {id: smallest reachable id}."""
    by = {}
    for i, f in fps.items():
        by.setdefault(f, []).append(i)
    keys = np.array(sorted(by), np.uint64)
    root = {int(k): int(k) for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k in keys:
        for o in keys[np.bitwise_count(keys ^ k) <= distance]:
            root[find(int(k))] = find(int(o))
    low = {}
    for k in root:
        low[find(k)] = min(low.get(find(k), by[k][0]), min(by[k]))
    return {i: low[find(f)] for i, f in fps.items()}


def test_query_against_brute_force(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op10_simhash_dedup(spark, SF).collect()}
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.select("doc_id", "text").collect()}
    want = brute_components(fps)
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert len({c for _, c in got.values()}) < len(got)


def test_dense_groups_and_every_distance(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 128)
    rnd = random.Random(3)
    fps = set()
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(60):
            f = base
            for b in rnd.sample(range(64), rnd.randint(0, 6)):
                f ^= 1 << b
            fps.add(f)
    base = rnd.getrandbits(64)  # one bucket of more than a block
    fps |= {base ^ (rnd.getrandbits(10) << 48) for _ in range(700)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    from devtrail.llm.graph import components
    for distance in (1, 2, 3):
        got = {r.node: r.root for r in components(simhash_links(df, distance)).collect()}
        want = brute_components(dict(zip(signed, fps)), distance)
        assert {f: got.get(f, f) for f in signed} == want


def test_odd_rows(spark, odd_docs):
    out = simhash_dedup(odd_docs)
    assert out.columns == [*odd_docs.columns, "fingerprint", "component_id", "component_fp"]
    rows = {(r.doc_id, (r.text or "")[:3]): r for r in out.collect()}
    assert out.count() == odd_docs.count()
    assert rows[(None, "a b")].component_id == 1 and rows[(5, "wor")].component_id == 4
    assert rows[(2, "")].fingerprint == "0" * 16 and rows[(6, " \n\t")].component_id == 2 == rows[(None, "")].component_id
    kept = one_of_each(out)
    assert kept.columns == odd_docs.columns and kept.count() == 4
    assert simhash_dedup(odd_docs.limit(0)).count() == 0
    clash = odd_docs.withColumn("fp", F.lit(1)).withColumn("fingerprint", F.lit("x"))
    assert simhash_dedup(clash).where("fp = 1 AND length(fingerprint) = 16").count() == odd_docs.count()


def test_first_of_each_equals_one_of_each(spark, docs, odd_docs):
    for df in (docs.select("doc_id", "text"), odd_docs.withColumn("place", F.lit(1)).withColumn("component_fp", F.lit("clash"))):
        df = df.union(df.limit(4))
        got, want = first_of_each(df), one_of_each(simhash_dedup(df))
        names = [c for c in df.columns if c in want.columns]
        assert got.columns == df.columns
        assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))
    assert first_of_each(docs.limit(0)).count() == 0
