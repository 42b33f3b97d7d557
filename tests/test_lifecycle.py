"""Layouts, rejects, raw text, selection of tables and scratch of the lifecycle run."""

import os

import pytest
from pyspark.sql import functions as F

from devtrail.__main__ import main
from devtrail.config import FIXTURE_AS_OF, FIXTURE_BUCKETS
from devtrail.functions.warranty import warranty_tag
from devtrail.operators.joins import enrich, enrich_left, lookup, not_in
from devtrail.plans.lifecycle import TABLES, Lifecycle, run_lifecycle, write_outputs
from devtrail.plans.timeline import build_timeline
from devtrail.sources import fixtures
from devtrail.sources.text import read_lines, read_table
from tests.test_text import SEP, outputs, raw_feeds, rows  # noqa: F401


@pytest.mark.parametrize("name,width", [("new_move", 135), ("new_repair", 91), ("new_complex", 52), ("new_shipment_events", 46)])
def test_event_table_alone_has_its_width(spark, outputs, tmp_path, name, width):  # noqa: F811
    write_outputs({name: outputs[name]}, str(tmp_path), fmt="text")
    lines = [r.value.split(SEP) for r in read_lines(spark, f"{tmp_path}/{name}").collect()]
    assert lines and {len(f) for f in lines} == {width}


def test_timeline_from_text_intermediates(spark, outputs, tmp_path):  # noqa: F811
    names = ("new_shipment_events", "new_complex", "new_move", "new_repair")
    write_outputs({k: outputs[k] for k in names}, str(tmp_path), fmt="text")
    t = [read_table(spark, f"{tmp_path}/{k}", k)[0] for k in names]
    key = ("eventtype", "eventdate", "imei", "xchg_uid", "rep_claim_date", "to_imei")
    assert rows(build_timeline(t[0], t[1], t[2], t[3]), *key) == rows(outputs["timeline"], *key)


def test_reports_keep_column_order_and_raw_text(spark, outputs, tmp_path):  # noqa: F811
    names = {"sdac_exception": 1, "activation_exception": 3, "repair_exception": 4, "cabandon_exception": 2, "dabandon_exception": 2}
    write_outputs({k: outputs[k] for k in names}, str(tmp_path), fmt="text")
    for name, at in names.items():
        fields = [r.value.split(SEP) for r in read_lines(spark, f"{tmp_path}/{name}").collect()]
        assert fields and {f[at] for f in fields} <= {"d5", "d9"}, name
    feed = spark.createDataFrame(
        [("SRC_0", "x1", "2001-01-01", "n/a", "abc", 1)],
        "data_source string, imei string, claim_date string, purchase_date string, warranty_period string, claim_id long")
    ship = spark.createDataFrame([("x2", "m", "2000/12/1", "2001-01-01")], "imei string, model string, mfg_date string, shipment_date string")
    run = Lifecycle({"repair_orig": feed, "shipment_orig": ship}, FIXTURE_BUCKETS)
    assert rows(run.table("repair_exception"), "imei", "purchase_date", "warranty_period") == [("x1", "n/a", "abc")]


def test_joins_keep_the_left_columns_in_place(spark):
    a = spark.createDataFrame([(1, "k", 2)], "x int, key string, y int")
    b = spark.createDataFrame([("k", 5)], "key string, z int")
    assert enrich(a, b, "key").columns == enrich_left(a, b, "key").columns == lookup(a, b, "key").columns == ["x", "key", "y", "z"]
    assert not_in(a, b.limit(0), "key").columns == ["x", "key", "y"]


def test_any_warranty_period_gives_a_tag(spark):
    r = spark.createDataFrame([(p, s) for p in (99_999_999, 2_147_483_647, -2_147_483_648) for s in ("SRC_0", "SRC_2", "SRC_7")], "p int, s string")
    d = F.lit("2001-01-01").cast("date")
    tags = {(x.p, x.s): x.t for x in r.select("p", "s", warranty_tag("s", d, d, d, "p", FIXTURE_BUCKETS).alias("t")).collect()}
    assert {t for (p, s), t in tags.items() if p < 0} == {"3"}
    assert {t for (p, s), t in tags.items() if p > 0 and s != "SRC_7"} == {"1"}


def test_bad_dates_are_rejects(spark):
    ship = spark.createDataFrame(
        [("d1", "m", "2001-01-01", "2001-02-01"), ("d2", "m", "2001-01-01", "abcdefghij"), ("d3", "m", "", "2014-02-31"), ("d4", "m", None, None)],
        "imei string, model string, mfg_date string, shipment_date string")
    run = Lifecycle({"shipment_orig": ship}, FIXTURE_BUCKETS)
    assert rows(run.table("shipment"), "imei") == [("d1",)]
    assert rows(run.table("shipment_date_rejects"), "imei") == [("d2",), ("d3",), ("d4",)]


def test_only_what_is_asked_is_built(spark, raw_feeds, tmp_path, monkeypatch):  # noqa: F811
    import devtrail.session as session

    staged = []
    real = session.stage
    for module in ("devtrail.plans.shipment", "devtrail.plans.exchange", "devtrail.sources.landing"):
        monkeypatch.setattr(f"{module}.stage", lambda df, name="stage", **how: (staged.append(name), real(df, name, **how))[1])
    args = [f"--{k.replace('_', '-')}={v}" for k, v in raw_feeds.items()] + [f"--out={tmp_path}/out", "--as-of=2001-10-01"]
    main([*args, "--only=cabandon"], spark=spark)
    assert staged == ["feed-uss_device", "cabandon_best"]
    assert spark.read.parquet(f"{tmp_path}/out/cabandon").count() > 0
    staged.clear()
    main([*args, "--domestic=DOM"], spark=spark)
    assert sorted(os.listdir(f"{tmp_path}/out")) == sorted([*TABLES, *(f"{f}_bad_lines" for f in raw_feeds)])
    # Each raw feed is scanned once, and lands as a table that everything reads.
    assert sorted(x for x in staged if x.startswith("feed-")) == sorted(f"feed-{f}" for f in raw_feeds)
    assert len(staged) == len(set(staged) - {"shared"}) + staged.count("shared")


def test_names_and_labels_are_checked(spark, raw_feeds, tmp_path):  # noqa: F811
    args = [f"--{k.replace('_', '-')}={v}" for k, v in raw_feeds.items()] + [f"--out={tmp_path}/out"]
    for more in (["--only=cabandn"], ["--only=repair"], []):
        with pytest.raises(SystemExit):
            main([*args, *more], spark=spark)
    with pytest.raises(ValueError):
        run_lifecycle({}, FIXTURE_BUCKETS, only=["cabandn"])


def test_scratch_of_a_run_goes_on_success(spark):
    from devtrail.session import run_scratch, stage

    with run_scratch(spark) as path:
        stage(spark.range(3), "x")
        assert os.path.isdir(path.removeprefix("file:"))
    assert not os.path.isdir(path.removeprefix("file:"))
    with pytest.raises(KeyError), run_scratch(spark) as path:
        stage(spark.range(3), "x")
        raise KeyError
    assert os.path.isdir(path.removeprefix("file:"))


def test_no_local_fallback_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from devtrail.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))


def test_timeline_plan_joins_little(spark):
    """The four branches read one staged new_shipment."""
    from devtrail.registry import Ctx

    plan = Ctx(spark, "/root/testdata/sf0.001").whole()._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Join") for line in plan.splitlines()) <= 10


def test_typed_feeds_need_places_for_extra_columns(spark, tmp_path):
    feeds = fixtures.feeds(spark, "/root/testdata/sf0.001")
    out = run_lifecycle(feeds, FIXTURE_BUCKETS, as_of=FIXTURE_AS_OF, only=["new_shipment_events"])
    with pytest.raises(ValueError):
        write_outputs(out, str(tmp_path), fmt="text")
