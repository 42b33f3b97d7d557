import pytest
from pyspark.sql import functions as F

from devtrail.llm.common import running_total, words_of
from devtrail.llm.mixing import mix, op4_mix_sources, source_targets
from tests.llm.conftest import SF


def brute_targets(sizes, weights=(5, 2, 1)):
    """Deal 150% by weight; what is above twice a source's size is dealt again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    got, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-6 and open_:
        total, over = sum(w[s] for s in open_), 0.0
        for s in list(open_):
            got[s] += left * w[s] / total
            if got[s] >= 2 * sizes[s]:
                over += got[s] - 2 * sizes[s]
                got[s] = 2.0 * sizes[s]
                open_.discard(s)
        left = over
    return got


def check(rows):
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.source_size is not None
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6) and abs(taken[s] - target[s]) <= 1
    return sizes


def test_query(spark, docs):
    rows = op4_mix_sources(spark, SF).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(rows) == docs.count()
    check(rows)
    again = op4_mix_sources(spark, SF)
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again.collect())


def test_hot_source_small_sources_and_order(spark):
    rows = [(i, "big" if i % 3 else f"s{i % 60}", (i * 37) % 400) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mix(df).cache()
    per = out.groupBy("mix_row").agg(F.first("source").alias("source"), F.first("size").alias("size"), F.first("target").alias("target"),
                                     F.first("source_size").alias("source_size"), F.sum("take").alias("taken"))
    check(per.collect())
    mixed = sorted((r for r in out.collect() if r.epoch >= 0), key=lambda r: r.position)
    at = 0
    for a, b in zip(mixed, mixed[1:]):
        assert a.position == at and a.finish <= b.finish
        at += a.take
    # The second pass over a source begins when its first is over.
    for s in {r.source for r in mixed}:
        assert [r.epoch for r in mixed if r.source == s] == sorted(r.epoch for r in mixed if r.source == s)


def test_odd_rows(spark, odd_docs):
    df = odd_docs.withColumn("size", words_of("text")).withColumn("take", F.lit("clash"))
    out = mix(df)
    per = out.groupBy("mix_row").agg(F.first("source").alias("source"), F.first("size").alias("size"), F.first("target").alias("target"),
                                     F.first("source_size").alias("source_size"), F.sum("take").alias("taken")).collect()
    assert len(per) == 10 and None in check(per)
    assert mix(df.limit(0)).count() == 0
    assert all(r.take == 0 for r in mix(df.where("size = 0")).collect())


def test_running_total_over_partitions(spark):
    df = spark.range(5000).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 7).alias("v"))
    out = running_total(df, "v", [F.col("g")], [F.col("id")], "b", "test").collect()
    total = {0: 0, 1: 0}
    for r in sorted(out, key=lambda r: r.id):
        assert r.b == total[r.g]
        total[r.g] += r.v


def test_dealing_ends_when_every_source_is_at_its_cap(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 50), (None, 30), ("z", 0)], "source string, source_size long")
    for share, repeats in ((1.5, 1), (1.0, 1), (2.0, 2), (7.0, 2)):
        got = {r.source: r.target for r in source_targets(sizes, share=share, repeats=repeats).collect()}
        assert got == {"a": 100.0 * repeats, "b": 50.0 * repeats, None: 30.0 * repeats, "z": 0.0}
