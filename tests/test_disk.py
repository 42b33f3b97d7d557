"""Disk that a query holds at once: shuffles of ended steps go, the last plan
reads staged records, and rows travel without what can be had otherwise."""

import os
import time

from pyspark.sql import functions as F

from devtrail.registry import QUERIES
from devtrail.session import release, stage
from devtrail.sources import fixtures
from tests.helpers import rows
from tests.test_scale import no_broadcast, nodes, plan_of  # noqa: F401


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b.name() for b in (blocks.apply(i) for i in range(blocks.size())) if b.isShuffle()}


def test_shuffle_files_of_a_staged_table_go(spark):
    before = shuffle_files(spark)
    table = stage(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count())
    made = shuffle_files(spark) - before
    release(spark)
    until = time.time() + 20
    while made & shuffle_files(spark) and time.time() < until:
        time.sleep(0.1)
    assert not made & shuffle_files(spark) and table.count() == 7


def test_last_plan_of_the_timeline_reads_staged_records(spark, tmp_path):
    os.symlink("/root/testdata/sf0.001", folder := str(tmp_path / "tables"))
    files = QUERIES["f1_union_all"](spark, folder).inputFiles()
    assert files and not [f for f in files if "devtrail-feed-" in f]


def test_line_items_travel_as_keys_date_and_bits(spark, tmp_path, no_broadcast):  # noqa: F811
    line = spark.createDataFrame(
        [(i % 5, i % 3, i, None if i % 11 == 0 else i % 8, "ANR"[i % 3] if i % 7 else None, "OF"[i % 2]) for i in range(200)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string")
    line.withColumn("l_shipdate", F.expr("timestamp'1997-01-01 10:00:00' + make_interval(0, 0, 0, l_suppkey)")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5).selectExpr("id o_orderkey", "id o_custkey", "timestamp'1997-03-01 00:00:00' o_orderdate", "'5-LOW' o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(3).selectExpr("id p_partkey", "'B' p_brand", "CAST(id + 7 AS INT) p_size").write.parquet(f"{tmp_path}/part.parquet")
    joined = fixtures.joined_feeds(spark, str(tmp_path))
    travel = {c for n in nodes(plan_of(joined)) if n.nodeName() == "Exchange" for c in n.schema().fieldNames()}
    assert "l_asked" in travel and not travel & {"l_linenumber", "l_returnflag", "l_linestatus"}
    for name in fixtures.FROM_JOIN:
        assert rows(fixtures._feed_of(joined, name)) == rows(fixtures.BUILDERS[name](spark, str(tmp_path)))


def test_event_tables_and_their_union_are_dense_and_their_joins_shuffles_go(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "scratch")
    os.symlink("/root/testdata/sf0.001", data := str(tmp_path / "tables"))
    monkeypatch.setattr("devtrail.registry.scratch_path", lambda s, name: folder)
    freed = []
    monkeypatch.setattr("devtrail.registry.release", lambda s: freed.append(sorted(os.listdir(folder))))
    assert QUERIES["p10_union_text"](spark, data).count() == QUERIES["f1_union_all"](spark, data).count()
    assert [len(x) for x in freed] == [1, 2, 3, 4, 5]  # after each table and their union
    for name in freed[-1]:
        files = [f for f in os.listdir(f"{folder}/{name}") if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
