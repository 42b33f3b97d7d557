"""Work that must not grow with the table beyond its size: feeds written once
and as they come, lines rendered and read over arrays, compressed scratch text."""

import glob
import os
import threading

from pyspark.sql import functions as F

from devtrail.operators.joins import join_both_ends
from devtrail.operators.sequence import distinct_observations
from devtrail.registry import QUERIES
from devtrail.session import stage, together
from devtrail.sources import fixtures, textio
from devtrail.sources.text import LAYOUTS, place_events, read_lines, read_table, to_lines, union_text
from tests.helpers import rows
from tests.test_scale import nodes, plan_of


def test_feed_is_written_by_the_partitions_of_its_builder(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(fixtures.BUILDERS, "uss_device", lambda s, d: s.range(0, 1000, 1, 3))
    feed = fixtures.stored_feed(spark, str(tmp_path), "uss_device")
    assert feed.count() == 1000
    (path, _), = [v for k, v in fixtures._STORED.items() if k[1] == str(tmp_path)]
    assert len(glob.glob(f"{path.removeprefix('file:')}/*.parquet")) == 3  # no exchange before the write


def test_branches_side_by_side_write_a_feed_once(spark, tmp_path, monkeypatch):
    built, both = [], threading.Barrier(2)

    def build(s, d):
        built.append(d)
        return s.range(10)

    def ask():
        both.wait(30)
        return fixtures.stored_feed(spark, str(tmp_path), "sdac_orig").count()

    monkeypatch.setitem(fixtures.BUILDERS, "sdac_orig", build)
    assert together(spark, ask, ask) == [10, 10]
    assert len(built) == 1


def test_checkins_used_writes_the_checkin_feed_alone(spark, tmp_path):
    os.symlink("/root/testdata/sf0.001", folder := str(tmp_path / "tables"))
    (row,) = QUERIES["b3_checkins_used"](spark, folder).collect()
    assert row.records == row.used + row.rejects > 0
    assert [name for _, d, name in fixtures._STORED if d == folder] == ["uss_device"]


def events(spark, n=50):
    """Rows of a move table without its opaque columns, some fields null."""
    df = spark.range(n).select(F.lit("move").alias("eventtype"), F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")).alias("eventdate"))
    ids = F.when(F.monotonically_increasing_id() % 3 > 0, F.monotonically_increasing_id())
    return df.select("*", ids.alias("imei"), ids.alias("xchg_uid"), F.lit("move").alias("xchg_eventtype"), F.lit(None).cast("date").alias("first_launch_date"),
                     ids.alias("to_imei"), F.col("eventdate").alias("to_shipment_date"))


def plan_text(df, which="optimizedPlan") -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return getattr(df._jdf.queryExecution(), which)().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_default_marker_is_set_once_over_the_fields(spark):
    placed = place_events(events(spark))
    lines = to_lines(placed, null_markers=textio.null_markers(placed))
    assert plan_text(lines, "analyzed").count("coalesce(") < 10
    first = lines.first()["value"].split("\x01")
    assert len(first) == 135 and first[11] == first[52] == "\\N" and first[45] == first[46] == "NA"


def test_dates_of_a_text_table_are_parsed_once_over_the_fields(spark, tmp_path):
    textio.write_event_text(events(spark), path := str(tmp_path / "move"))
    table, rejects = read_table(spark, path, "new_move")
    assert plan_text(table).count("RLIKE") == 1
    assert rejects.count() == 0 and table.columns == LAYOUTS["new_move"].columns()
    got = table.select("imei", "eventdate", "first_launch_date", "to_imei", "to_shipment_date").collect()
    want = events(spark).select(F.col("imei").cast("string"), "eventdate", "first_launch_date", F.col("to_imei").cast("string"), "to_shipment_date").collect()
    assert sorted(got, key=str) == sorted(want, key=str)


def test_event_text_that_is_read_back_is_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textio, "scratch_path", lambda s, name: str(tmp_path / "scratch"))
    got = textio.events_by_position(spark, events(spark), (0, 1, 2, 134))
    assert got.count() == 50 and {r.n_fields for r in got.collect()} == {135}
    files = glob.glob(str(tmp_path / "scratch" / "part-*"))
    assert files and all(f.endswith(".lz4") for f in files)


def test_union_of_compressed_text_keeps_lines_and_order(spark, tmp_path):
    paths = []
    for i in range(3):
        lines = spark.range(i * 1000, i * 1000 + 500, 1, 4).select(F.format_string("%05d", "id").alias("value"))
        lines.write.text(path := str(tmp_path / str(i)), compression="lz4")
        paths.append(path)
    union_text(spark, paths, out := str(tmp_path / "all"), compression="lz4")
    files = sorted(glob.glob(f"{out}/part-*"))
    assert all(f.endswith(".lz4") for f in files)
    got = [r.value for f in files for r in read_lines(spark, f).collect()]
    assert got == sorted(got) and len(got) == 1500


def test_distinct_observations_deal_rows_before_they_are_compared(spark):
    obs = spark.range(3000).select((F.col("id") % 1000).alias("imsi"), F.when(F.col("id") % 2 == 0, 7).alias("imei"))
    got = distinct_observations(obs, rows=20_000_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "20" in plan.split("hashpartitioning")[1].split("REPARTITION_BY_NUM")[0]
    assert plan.index("HashAggregate") < plan.index("Exchange") and "HashAggregate" not in plan[plan.index("Exchange"):]
    assert sorted(got.collect(), key=str) == sorted(obs.distinct().collect(), key=str)
    assert distinct_observations(obs).count() == 1000


def test_hot_partition_of_the_file_report_is_one_that_aqe_splits(spark, monkeypatch):
    plans = []
    write = textio.write_delimited
    monkeypatch.setattr(textio, "write_delimited", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k)))
    (row,) = QUERIES["g1_file_rows"](spark, "/root/testdata/sf0.001").collect()
    assert row.within_limit and row.n_rows > 0
    assert "REBALANCE_PARTITIONS_BY_COL" in plans[0] and "REPARTITION_BY_NUM" not in plans[0]


def test_timeline_reads_its_feeds_from_one_join(spark, tmp_path):
    os.symlink("/root/testdata/sf0.001", folder := str(tmp_path / "tables"))
    assert QUERIES["f1_union_all"](spark, folder).count() > 0
    assert {name for _, d, name in fixtures._STORED if d == folder} == {"joined", "sdac_orig"}
    for name in fixtures.FROM_JOIN:
        feed, built = fixtures.stored_feed(spark, folder, name, among=True), fixtures.BUILDERS[name](spark, folder)
        assert feed.dtypes == built.dtypes and rows(feed) == rows(built)


def test_shared_columns_do_not_travel_with_each_edge(spark):
    dim = spark.range(40).select(
        F.col("id").alias("imei"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("m"), F.col("id") % 3)).alias("model"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("act_imei"), (F.col("id") * 3).alias("own"))
    dim = stage(dim.union(dim.filter("imei < 4")))  # some devices twice
    edges = spark.range(300).select((F.col("id") % 43).alias("imei"), (F.col("id") % 41).alias("toimei"), F.col("id").alias("uid"))
    plain = join_both_ends(edges, dim)
    lean = join_both_ends(edges, dim, repeated=["model"], echoes=["act_imei"])
    over = join_both_ends(edges, dim, repeated=["model"], echoes=["act_imei"], max_rows=3)
    assert plain.columns == lean.columns == over.columns and rows(plain) == rows(lean) == rows(over)
    assert rows(join_both_ends(edges, dim.limit(0), repeated=["model"])) == []
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        travels = lambda df: [c for n in nodes(plan_of(df)) if n.nodeName() == "Exchange" and "(xchg_toimei" in n.simpleString(10_000) for c in n.schema().fieldNames()]
        assert {"model", "act_imei"} <= set(travels(join_both_ends(edges, dim)))
        assert set(travels(join_both_ends(edges, dim, repeated=["model"], echoes=["act_imei"]))) == {"imei", "own", "xchg_uid", "xchg_toimei", "__combination"}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
