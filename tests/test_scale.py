"""Shapes for large tables: co-partitioned staged tables, hash-based daily
reduction, reduction ahead of a dedup, even files, union of texts."""

import glob
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from devtrail.__main__ import main
from devtrail.config import FIXTURE_AS_OF, FIXTURE_BUCKETS, HI, LO
from devtrail.functions.dates import day_of
from devtrail.operators.dedupe import latest_per_key
from devtrail.operators.joins import not_in, only_not_in, sized_broadcast
from devtrail.operators.sequence import device_codes, observations, transitions
from devtrail.plans.exchange import build_transitions
from devtrail.plans.lifecycle import Lifecycle, write_outputs
from devtrail.plans.repair import build_new_repair, build_repair
from devtrail.plans.shipment import activation_exceptions
from devtrail.plans.timeline import build_new_complex, build_new_move, build_new_shipment
from devtrail.session import run_scratch, scratch_path, stage, stage_by_key, together
from devtrail.sources import fixtures
from devtrail.sources.text import file_rows, read_lines, union_text, write_delimited, write_table
from tests.helpers import rows
from tests.test_text import outputs, raw_feeds  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def children(node):
    return [node.children().apply(i) for i in range(node.children().size())]


def plan_of(df):
    root = df._jdf.queryExecution().executedPlan()
    return root.initialPlan() if root.nodeName() == "AdaptiveSparkPlan" else root


def nodes(node):
    yield node
    for c in children(node):
        yield from nodes(c)


def is_staged(node) -> bool:
    return "Bucketed: true" in node.simpleString(10_000)


def exchanged_staged_sides(df) -> int:
    """Exchanges that deal out the rows of a bucketed table (not of a join)."""
    n = 0
    for node in nodes(plan_of(df)):
        if node.nodeName() == "Exchange":
            below = children(node)
            while len(below) == 1:
                n += is_staged(below[0])
                below = children(below[0])
    return n


def staged_scans(df) -> int:
    return sum(map(is_staged, nodes(plan_of(df))))


def test_event_joins_need_no_exchange_on_the_staged_side(spark, no_broadcast):
    run = Lifecycle(fixtures.feeds(spark, SF), FIXTURE_BUCKETS, LO, HI, FIXTURE_AS_OF)
    p6 = build_new_shipment(run.ship["shipment"], run.sdac["sdac"], run.activation["activation"], HI,
                            sdac_model_dates=run.sdac["sdac_model_dates"], activation_model_dates=run.activation["activation_model_dates"])["new_shipment"]
    assert staged_scans(p6) == 3 and exchanged_staged_sides(p6) == 0
    assert not any(n.nodeName() == "Exchange" and "hashpartitioning(imei" in n.simpleString(1000) for n in nodes(plan_of(p6)))
    ns = run.new_shipment["new_shipment"]
    for df, scans in ((build_new_complex(run.cabandon["cabandon"], ns), 1), (build_new_move(run.moved("move"), ns), 2),
                      (build_new_repair(run.repair["repair"], ns)["new_repair"], 1)):
        assert (staged_scans(df), exchanged_staged_sides(df)) == (scans, 0)
    assert rows(p6) == rows(ns)


def test_buckets_follow_the_rows_of_a_landed_feed(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr("devtrail.session.ROWS_PER_BUCKET", 300)
    feeds = fixtures.feeds(spark, SF)
    run = Lifecycle(feeds, FIXTURE_BUCKETS, LO, HI, FIXTURE_AS_OF, land=True)
    n = -(-feeds["shipment_orig"].count() // 300)
    assert run.n_buckets == n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    ns = run.new_shipment["new_shipment"]
    df = build_new_complex(run.cabandon["cabandon"], ns)
    assert (staged_scans(df), exchanged_staged_sides(df)) == (1, 0)
    assert any(f"out of {n}" in x.simpleString(10_000) for x in nodes(plan_of(df)) if is_staged(x))
    assert Lifecycle(feeds, FIXTURE_BUCKETS, materialize=False).n_buckets is None


def test_staged_by_key_keeps_rows_and_goes_with_its_run(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("k"), "id").union(spark.sql("SELECT CAST(NULL AS BIGINT), -1L"))
    with run_scratch(spark) as path:
        for n in (None, 5):
            t = stage_by_key(df, "k", "some-table", n)
            assert rows(t) == rows(df)
        names = [t.name for t in spark.catalog.listTables() if t.name.startswith("devtrail_some_table")]
        assert len(names) >= 2 and os.path.isdir(path.removeprefix("file:"))
    assert not {t.name for t in spark.catalog.listTables()} & set(names)
    assert not os.path.isdir(path.removeprefix("file:"))


def test_runs_of_one_session_have_a_folder_each(spark):
    with run_scratch(spark) as outer:
        with run_scratch(spark) as inner:
            assert inner.startswith(outer) and scratch_path(spark, "x").startswith(inner)
            assert all(p.startswith(inner) for p in together(spark, *[lambda: scratch_path(spark, "x")] * 3))
        assert scratch_path(spark, "x").startswith(outer) and not scratch_path(spark, "x").startswith(inner)
        seen = []
        other = threading.Thread(target=lambda: seen.append(scratch_path(spark, "x")))
        other.start()
        other.join()
        assert not seen[0].startswith(outer)


def test_a_dimension_is_measured_by_the_job_that_writes_it(spark):
    dim = spark.range(100).select(F.col("id").cast("string").alias("model"))
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-dim"))
    spark.sparkContext.setJobGroup("one-dim", "")
    try:
        small = sized_broadcast(dim)
        assert jobs() == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    hinted = lambda df: "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small) and not hinted(sized_broadcast(dim, max_rows=99)) and not hinted(sized_broadcast(dim, max_bytes=1000))
    assert hinted(sized_broadcast(dim.filter("model = 'x'"))) and hinted(sized_broadcast(dim.limit(0)))


def pairs(df):
    return rows(df, "imsi", "from_imei", "to_imei", "from_model", "to_model", "eventdate", "kind")


@pytest.mark.parametrize("imei", ["bigint", "int", "string"])
def test_packed_transitions_equal_the_sorted_ones(spark, imei):
    rnd = random.Random(7)
    device = lambda: rnd.choice([*range(35_000, 35_012), None])
    data = [(rnd.randint(0, 9) if rnd.random() < 0.7 else 0, device(), rnd.choice(["A", "B", "Ä", "", None]), f"2010-01-{rnd.randint(1, 28):02d}") for _ in range(1500)]
    obs = spark.createDataFrame(data, "imsi int, imei int, model string, d string").select(
        "imsi", F.col("imei").cast(imei).alias("imei"), "model", F.to_date("d").alias("obs_date"))
    codes = device_codes(obs)
    assert codes is not None and codes.digits == (5 if imei == "string" else None)
    packed, plain = transitions(obs, codes=codes), transitions(obs)
    assert packed.columns == plain.columns and dict(packed.dtypes) == dict(plain.dtypes)
    assert pairs(packed) == pairs(plain) and packed.count() > 100
    for kind in ("move", "swap"):
        assert pairs(transitions(obs, codes=codes, kind=kind)) == pairs(plain.filter(F.col("kind") == kind))
    names = {n.nodeName() for n in nodes(plan_of(packed))}
    assert "HashAggregate" in names and "SortAggregate" not in names


@pytest.mark.parametrize("devices", [["12", "123"], ["12", "1a"], ["1" * 19], ["9" * 18, "0" * 18], [None]])
def test_devices_that_cannot_be_packed(spark, devices):
    df = spark.createDataFrame([(d, f"m{i}") for i, d in enumerate(devices * 10)], "imei string, model string")
    assert device_codes(df) is None
    assert device_codes(df.limit(0)) is None and device_codes(df, max_models=3) is None
    feed = df.select(F.lit("s").alias("imsi"), "imei", "model", F.lit("2010-01-01 00:00:00").alias("first_ts"), F.lit("2010-01-02 00:00:00").alias("last_ts"))
    assert rows(build_transitions(feed), "imei") == rows(transitions(observations(feed)), "from_imei")  # the sorted way


def test_no_sort_aggregate_in_moves_and_swaps(spark):
    from devtrail.registry import QUERIES

    for name in ("w2_move", "w2_swap"):
        names = [n.nodeName() for n in nodes(plan_of(QUERIES[name](spark, SF)))]
        assert "SortAggregate" not in names and names.count("HashAggregate") == 2, name


def test_claims_are_not_sorted_by_their_raw_text(spark):
    repair = build_repair(fixtures.repair_orig(spark, SF), fixtures.shipment_orig(spark, SF), FIXTURE_BUCKETS)
    assert "__purchase_text" not in plan_of(repair["repair"]).toString()
    sorts = [n.simpleString(1000) for n in nodes(plan_of(repair["repair_first"])) if n.nodeName() in ("Sort", "Window", "WindowGroupLimit")]
    assert sorts and not any("__purchase_text" in x or "__period_text" in x for x in sorts)


def test_only_unshipped_records_are_deduplicated(spark, no_broadcast):
    uss = fixtures.stored_feed(spark, SF, "uss_device").withColumn("payload", F.lit("wide"))
    uss = stage(uss.union(uss.limit(3).withColumn("imei", F.lit(None).cast("bigint"))))
    ship = fixtures.stored_feed(spark, SF, "shipment_orig").select("imei").distinct()
    got = activation_exceptions(uss, ship)
    latest, _ = latest_per_key(uss.withColumn("__day", day_of("last_ts")), ["imei"], "__day", LO)
    assert rows(got) == rows(not_in(latest.drop("__day"), ship)) and got.columns == uss.columns
    assert got.filter("imei IS NULL").count() == 1
    window = next(n for n in nodes(plan_of(got)) if n.nodeName() == "Window")
    joins = [n for n in nodes(window) if "Join" in n.nodeName()]
    assert [("BroadcastHashJoin" in j.nodeName(), "LeftSemi" in j.simpleString(1000)) for j in joins] == [(True, True)]
    # The anti join is over keys alone, and no record is dealt out before the dedup.
    reduced = only_not_in(uss, ship)
    assert not any(n.nodeName() == "Exchange" for n in nodes(plan_of(reduced)))
    assert rows(only_not_in(uss, ship, max_rows=1)) == rows(reduced)


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_even_files_of_a_skewed_table(spark, tmp_path, fmt):
    hot = F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(30_000).select(F.col("id").cast("string").alias("v")).withColumn("id", F.col("v").cast("int")).repartition(8, hot)
    write = write_delimited if fmt == "text" else write_table
    write(df, str(tmp_path / "even"), rows_per_file=3000)
    write(df, str(tmp_path / "plain"))
    even, plain = ([r.n for r in file_rows(spark, str(tmp_path / x), fmt).collect()] for x in ("even", "plain"))
    assert sum(even) == sum(plain) == 30_000 and max(even) <= 3000
    assert max(even) <= 2 * sum(even) / len(even)
    with pytest.raises(ValueError):
        write(df, str(tmp_path / "x"), num_files=2, rows_per_file=5)


def parts(folder) -> list[bytes]:
    return [open(f, "rb").read() for f in sorted(glob.glob(f"{folder}/part-*"))]


EVENTS = ("new_shipment_events", "new_complex", "new_move", "new_repair")


def test_union_of_texts_keeps_order_and_bytes(spark, outputs, tmp_path):  # noqa: F811
    write_outputs({k: outputs[k] for k in (*EVENTS, "timeline")}, str(tmp_path), fmt="text")
    folders = [str(tmp_path / k) for k in EVENTS]
    union_text(spark, folders, str(tmp_path / "union"))
    got = b"".join(parts(tmp_path / "union"))
    assert got == b"".join(b"".join(parts(f)) for f in folders)
    assert sorted(got.splitlines()) == sorted(b"".join(parts(tmp_path / "timeline")).splitlines())  # the typed path
    for extra in (["--num-files=3"], ["--unordered"], ["--unordered", "--num-files=2"]):
        main(["union", f"--inputs={','.join(folders)}", f"--out={tmp_path}/cli", *extra], spark=spark)
        lines = b"".join(parts(tmp_path / "cli"))
        assert sorted(lines.split(b"\n")) == sorted(got.split(b"\n"))
        assert "--unordered" in extra or lines == got


def test_union_of_texts_does_not_look_into_lines(spark, tmp_path):
    texts = {"b": [b"z\x01\xff\xfe\x01", b"", b"a\rb", b"  x  "], "a": [b"\x01" * 200, b"\\N\x01NA", b"dup", b"dup"], "c": []}
    for name, lines in texts.items():
        os.makedirs(tmp_path / name)
        for i, line in enumerate(lines):
            (tmp_path / name / f"part-{i}").write_bytes(line + b"\n")
    union_text(spark, [str(tmp_path / n) for n in texts], str(tmp_path / "out"), num_files=3)
    assert b"".join(parts(tmp_path / "out")) == b"".join(x + b"\n" for lines in texts.values() for x in lines)


def test_command_line_writes_files_of_a_size(spark, raw_feeds, tmp_path):  # noqa: F811
    args = [f"--{k.replace('_', '-')}={v}" for k, v in raw_feeds.items()] + [f"--out={tmp_path}/out", "--as-of=2001-10-01", "--format=text"]
    written = main([*args, "--only=shipment,uss_guard_rejects", "--rows-per-file=1"], spark=spark)
    assert written == {n: f"{tmp_path}/out/{n}" for n in ("shipment", "uss_guard_rejects")}
    assert [r.n for r in file_rows(spark, written["shipment"]).collect()] == [1, 1, 1]
    assert read_lines(spark, written["uss_guard_rejects"]).count() == 1
