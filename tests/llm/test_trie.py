import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from devtrail.llm import trie
from devtrail.llm.trie import conversation_trie, digest_turns, prefix_trie, rebuilt, screen

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(convs):
    """Nodes of {conv_id: [(role, text), ...]} by walking every prefix."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ms in members.items():
        under = [n for n in members if n[:len(node)] == node]
        children = {n for n in under if len(n) == len(node) + 1}
        leaves = [n for n in under if not any(m[:len(n)] == n and len(m) > len(n) for m in under)]
        words = lambda n: len([w for w in n[-1][1].replace("\t", " ").replace("\n", " ").split(" ") if w]) if n else 0
        saved = sum((len(members[n]) - 1) * words(n) for n in under)
        ends = ",".join(str(c) for c in sorted(ms) if len(convs[c]) == len(node))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuild(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def made(rnd, n, longest, words):
    convs = {}
    for c in range(n):
        old = convs[rnd.choice(list(convs))] if convs and rnd.random() < 0.7 else []
        keep = rnd.randint(0, len(old))
        convs[c * 3] = (old[:keep] + [(rnd.choice(["user", "assistant"]), " ".join(rnd.choices(words, k=rnd.randint(0, 3)))) for _ in range(rnd.randint(0, longest))])[:40]
    return {c: t for c, t in convs.items() if t}


def frame(spark, convs, parts=4):
    rows = [(c, k, r, t, 0, "x") for c, ts in convs.items() for k, (r, t) in enumerate(ts)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, n_convs string").repartition(parts)


def rows(df):
    return sorted([tuple(r[c] for c in COLUMNS) for r in df.collect()], key=str)


@pytest.mark.parametrize("width", [64, None])  # a full sketch, and one that proves most singletons
def test_against_walk_over_all_prefixes(spark, monkeypatch, width):
    if width:
        monkeypatch.setattr(trie, "sketch_width", lambda n: width)
        monkeypatch.setattr(trie, "PAGE", 8)
    convs = made(random.Random(12), 150, 4, ["a", "b", "c\td", ""])
    convs |= {1000 + i: [("user", "hello")] * 2 for i in range(60)}  # one common conversation
    assert rows(conversation_trie(frame(spark, convs))) == brute(convs)


def test_query_conversations(spark):
    convs = made(random.Random(3), 120, 5, ["a", "b", "c"])
    convs |= {c * 20 + j: convs[c * 3][:3] for c in range(40) for j in (0, 3, 7) if c * 3 in convs}
    convs.pop(40, None)  # a base that is absent
    digests = digest_turns(frame(spark, convs))
    assert rows(prefix_trie(rebuilt(digests), digests.select("conv_id").distinct())) == brute(rebuild(convs))


def test_one_conversation_holds_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    monkeypatch.setattr(trie, "ROWS", 100)  # many ranges, so that it spreads over them
    rnd = random.Random(5)
    long = [("user", f"w{rnd.randint(0, 9)}") for _ in range(700)]
    convs = {5: long, 9: long[:350] + [("user", "z")], 2: long[:100], **{100 + i: [("user", "hi"), ("assistant", str(i % 2))] for i in range(400)}}
    assert rows(conversation_trie(frame(spark, convs))) == brute(convs)


def test_sketch_proves_singletons_only(spark):
    p = spark.range(3000).select((F.col("id") % 3).alias("depth"), F.col("id").alias("p1"), F.xxhash64("id").alias("p2"))
    twice = p.where("p1 < 500")
    width = trie.sketch_width(3500)
    bits = screen(p.union(twice), width)
    cells = p.select("p1", *(c.alias(f"c{i}") for i, c in enumerate(trie._cells(width, F.col("depth"), F.col("p1"), F.col("p2"))))).toPandas()
    many = lambda c: np.unpackbits(bits)[c]
    single = (many(cells["c0"]) & many(cells["c1"])) == 0
    assert not single[cells["p1"] < 500].any() and single[cells["p1"] >= 500].mean() > 0.95


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, len int"
    data = [(1, None, None, None, 1), (1, 2, "assistant", "x " * 100_000, 1), (1, 2, "assistant", "x " * 100_000, 1), (None, 1, "user", "lost", 1), (2, 1, "", "", 1),
            (-7, 5, "user", "a", 1)]
    x = ("assistant", "x " * 100_000)
    assert rows(conversation_trie(spark.createDataFrame(data, schema))) == brute({1: [("", ""), x, x], 2: [("", "")], -7: [("user", "a")]})
    empty = spark.createDataFrame([], schema)
    assert conversation_trie(empty).count() == 0 and conversation_trie(empty).columns == list(COLUMNS)
    turnless = spark.createDataFrame([(4,), (3,)], "conv_id long")
    assert rows(prefix_trie(digest_turns(empty), turnless)) == brute({3: [], 4: []})
