import math
import random
import re
from collections import Counter

import numpy as np
import xxhash

from devtrail.llm import search
from devtrail.llm.search import Queries, _Block, exact_scores, positions, ranked_search, upper_bounds

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    held = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(t for _, ts in held for t in set(ts))
    out = []
    for item, text in items:
        found = []
        for doc, ts in held:
            tf = Counter(ts)
            m = 75 + (25 * len(ts) * n_docs) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in terms(text) if tf[t])
            if score > 0:
                found.append((-score, doc is None, doc, score))
        out += [(item, r, x[2], x[3]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def texts(rnd, n, words, longest):
    odd = [" ", ", ", "\n", "\x00", "\x7f", "é", "É", "İ", " K ", "-", "_"]
    return ["".join(rnd.choice(words) + rnd.choice(odd) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "CELLS", 1 << 12)  # many blocks of signatures
    rnd = random.Random(13)
    words = [f"{rnd.choice('aBcDé')}{i}" for i in range(80)]
    docs = [(i, t) for i, t in enumerate(texts(rnd, 400, words, 60))]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(5, docs[7][1]), (None, docs[7][1]), (2000, None), (2001, ""), (2002, " ".join(words) * 300)]
    items = [(i, t) for i, t in enumerate(texts(rnd, 25, [*words, "nowhere"], 12))] + [(100, docs[7][1]), (101, None), (102, "nowhere"), (103, docs[7][1] * 2)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 20)
    for block in (search.BLOCK_TERMS, 40):  # one block of queries, and many
        got = ranked_search(d.repartition(5), q, block_terms=block).collect()
        assert sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in got], key=str) == want


def test_shuffled_when_candidates_are_many(spark, monkeypatch):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    docs, items = list(enumerate(texts(rnd, 120, words, 20))), list(enumerate(texts(rnd, 6, words, 5)))
    monkeypatch.setattr(search, "MAX_ROWS", 1)
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=3)
    assert sorted([tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()], key=str) == brute(docs, items, 3)


def test_bounds_are_never_under_the_scores_and_mostly_near():
    rnd = random.Random(2)
    words = [f"t{i}".encode() for i in range(500)]
    docs = [rnd.choices(words, weights=range(500, 0, -1), k=rnd.randint(50, 90)) for _ in range(200)]
    asked = [(i, list(set(rnd.choices(words, k=10))), [1] * 10) for i in range(30)]
    df = Counter(t for d in docs for t in set(d))
    q = Queries(asked, dict(df), 200, sum(map(len, docs)))
    block = _Block(4096)
    for i, d in enumerate(docs):
        tf = Counter(d)
        h = np.array([xxhash.xxh64_intdigest(t, search.SEED) for t in tf], np.uint64)
        n = np.array(list(tf.values()))
        at = [positions(h[n >= 1 << j], j, 4096).ravel() for j in range(search.LEVELS)]
        block.add((i, i, len(d)), np.concatenate(at))
    n = np.array([len(d) for d in docs])
    bounds = upper_bounds(q, 4096, n, block.row().column("slices")[0].as_py())
    split = search._separators()
    scores = np.array([exact_scores(q, b" ".join(d), np.arange(30), split) for d in docs]).T
    assert (bounds * (1 + 1e-4) + 1 >= scores).all()
    assert (bounds[scores == 0] == 0).mean() > 0.9  # few false positives
    assert np.median(bounds[scores > 0] / scores[scores > 0]) < 1.2


def test_odd_tables(spark, odd_docs):
    items = spark.createDataFrame([(1, "a TOKEN"), (None, "Straße word7")], "item_id long, text string").selectExpr("item_id", "text", "1 AS doc_id", "2 AS score")
    got = [tuple(r) for r in ranked_search(odd_docs, items).select("item_id", "rank", "doc_id").collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 7), (1, 2, 1), (1, 3, 1), (1, 4, None), (None, 1, 7), (None, 2, 4), (None, 3, 5)], key=str)
    assert ranked_search(odd_docs.limit(0), items).count() == 0
    assert ranked_search(odd_docs, items.limit(0)).count() == 0
    assert ranked_search(odd_docs, items).columns == ["item_id", "rank", "doc_id", "score"]
