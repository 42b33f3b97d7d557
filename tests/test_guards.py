"""Reject records with reasons, and raw feeds landed by one scan."""

import glob
import json
import os
import subprocess
import sys

import pytest

from devtrail.config import FIXTURE_BUCKETS
from devtrail.operators.guards import FAILED, GUARDS, guard_counts, guard_rejects
from devtrail.plans.lifecycle import FEEDS, Lifecycle, write_outputs
from devtrail.sources.landing import TextFeeds, land_lines, tag_lines
from devtrail.sources.text import LAYOUTS, read_lines
from tests.helpers import rows
from tests.test_text import SEP, line, raw_feeds, write_feed  # noqa: F401

U, S, A = (LAYOUTS[n] for n in ("uss_device", "shipment_orig", "repair_orig"))


def test_a_bad_first_seen_day_is_a_reject_and_still_an_activation(spark):
    feed = spark.createDataFrame(
        [("s1", "d1", "m", "2014-01-01 10:00:00", "2014-01-02 10:00:00"), ("s1", "d2", "m", "2014-02-31 10:00:00", "2014-03-01 10:00:00"),
         ("s2", "d3", "m", "", "2014-13-01 10:00:00"), ("s2", "d3", "m", None, "2014-03-01")],
        "imsi string, imei string, model string, first_ts string, last_ts string")
    ship = spark.createDataFrame([("d2", "m", None, "2013-01-01")], "imei string, model string, mfg_date string, shipment_date string")
    run = Lifecycle({"uss_device": feed, "shipment_orig": ship}, FIXTURE_BUCKETS, materialize=False)
    assert rows(run.table("uss_guard_rejects"), "imei", FAILED) == [
        ("d2", ["first_ts"]), ("d3", ["first_ts", "last_ts"]), ("d3", ["first_ts", "last_ts"])]
    assert rows(run.table("uss_date_rejects"), "imei") == [("d3",), ("d3",)]  # the key date only
    assert run.table("uss_date_rejects").columns == feed.columns
    assert rows(run.table("activation"), "imei") == [("d2",)]
    assert run.table("move").count() == run.table("swap").count() == 0


@pytest.mark.parametrize("name", FEEDS)
def test_every_guard_of_every_feed(spark, name):
    good = {c: "2014-01-02 10:00:00" if c.endswith("_ts") else "2014-01-02" for c in LAYOUTS[name].names.values()} | {"warranty_period": "12"}
    columns = [*LAYOUTS[name].names.values(), "extra"]
    base = {c: good.get(c, "x") for c in columns}
    bad = {"warranty_period": "abc"}
    data, want = [base], []
    for g in GUARDS[name]:
        for value in (bad.get(g.field, "2014-02-31 10:00:00" if g.field.endswith("_ts") else "2014-02-31"), "abcdefghij", "", "\\N", None):
            data.append(base | {g.field: value})
            if g.required or value not in ("", "\\N", None):
                want.append((value, [g.field]))
    data.append(base | {g.field: "?" for g in GUARDS[name]})
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in data], ", ".join(f"{c} string" for c in columns))
    got = guard_rejects(df, name)
    assert got.columns == [*columns, FAILED]
    found = [(r[r[FAILED][0]], r[FAILED]) for r in got.collect() if len(r[FAILED]) == 1]
    every = [[g.field for g in GUARDS[name]]]
    assert sorted(found, key=str) == sorted(want + ([("?", every[0])] if len(every[0]) == 1 else []), key=str)
    assert [r[FAILED] for r in got.collect() if len(r[FAILED]) > 1] == (every if len(every[0]) > 1 else [])
    n = {r.guard: r.n for r in guard_counts(df, name).collect()}
    assert n == {g.field: sum(g.field in f for _, f in want) + 1 for g in GUARDS[name]}
    assert guard_rejects(df.limit(0), name).count() == 0


def test_typed_dates_can_only_be_absent(spark):
    df = spark.sql("SELECT 'd' AS imei, 'm' AS model, CAST(NULL AS DATE) AS mfg_date, CAST(NULL AS DATE) AS shipment_date UNION ALL SELECT 'e', 'm', NULL, DATE '2001-01-01'")
    assert rows(guard_rejects(df, "shipment_orig"), "imei", FAILED) == [("d", ["shipment_date"])]


def test_outcomes_of_a_landed_feed(spark, tmp_path):
    lines = [line(S, imei="d1", mfg_date="2001-01-01", shipment_date="2001-01-02"), line(S, imei="d2", mfg_date="2001-02-30", shipment_date="2001-01-02"),
             line(S, imei="d3", mfg_date="", shipment_date=""), "short", "", SEP.join(["x"] * 30)]
    path = write_feed(str(tmp_path), "ship", lines)
    landed = TextFeeds(spark, {"shipment_orig": path})["shipment_orig"]
    assert rows(landed.good, "imei") == [("d1",)]
    assert rows(landed.feed, "imei") == [("d1",), ("d2",), ("d3",)]
    assert rows(landed.rejects, "imei", FAILED) == [("d2", ["mfg_date"]), ("d3", ["shipment_date"])]
    assert rows(landed.bad_lines) == sorted([("",), ("short",), (lines[-1],)], key=repr)
    assert landed.feed.columns == S.columns() and landed.bad_lines.columns == ["value"]
    plan = landed.rejects._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan  # only the flawed partition is read
    assert plan.count("FileScan") == 1
    none = land_lines(read_lines(spark, path).limit(0), "shipment_orig")
    assert none.feed.count() == none.rejects.count() == none.bad_lines.count() == 0


def test_a_line_is_split_once(spark, tmp_path):
    path = write_feed(str(tmp_path), "ship", ["x"])
    plan = tag_lines(read_lines(spark, path), "shipment_orig")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_rejects_as_text_list_their_guards(spark, tmp_path):
    df = spark.createDataFrame([("s1", "d2", "m", "", "x")], "imsi string, imei string, model string, first_ts string, last_ts string")
    write_outputs({"uss_guard_rejects": guard_rejects(df, "uss_device")}, str(tmp_path), fmt="text")
    assert rows(read_lines(spark, f"{tmp_path}/uss_guard_rejects")) == [(SEP.join(["s1", "d2", "m", "", "x", "first_ts,last_ts"]),)]


def scanned_lines(events: str) -> int:
    """Lines that all scans of text files read, from an event log."""
    ids, total = set(), 0

    def walk(node: dict) -> None:
        if node["nodeName"].startswith("Scan text"):
            ids.update(m["accumulatorId"] for m in node["metrics"] if m["name"] == "number of output rows")
        for child in node["children"]:
            walk(child)

    logged = []
    for path in glob.glob(f"{events}/*"):
        with open(path) as f:
            logged += [json.loads(x) for x in f]
    for e in logged:
        if "sparkPlanInfo" in e:
            walk(e["sparkPlanInfo"])
    for e in logged:
        if e["Event"] == "SparkListenerTaskEnd":
            total += sum(int(a["Update"]) for a in e["Task Info"]["Accumulables"] if a["ID"] in ids)
    return total


def test_all_tables_read_each_raw_line_once(raw_feeds, tmp_path):  # noqa: F811
    events, out = tmp_path / "events", tmp_path / "out"
    events.mkdir()
    conf = {"spark.master": "local[4]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{events}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
            "spark.checkpoint.dir": f"file://{tmp_path}/shared", "spark.sql.maxMetadataStringLength": "1000"}
    args = [f"--{k.replace('_', '-')}={v}" for k, v in raw_feeds.items()] + [f"--out={out}", "--as-of=2001-10-01", "--domestic=DOM", "--overseas=OVS"]
    submit = " ".join(f"--conf {k}={v}" for k, v in conf.items()) + " pyspark-shell"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-m", "devtrail", *args], cwd=root, env=os.environ | {"PYSPARK_SUBMIT_ARGS": submit}, timeout=600, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    lines = sum(len(open(f).read().splitlines()) for p in raw_feeds.values() for f in glob.glob(f"{p}/*"))
    assert scanned_lines(str(events)) == lines
    assert {"uss_guard_rejects", "shipment_orig_bad_lines", "timeline"} <= set(os.listdir(out))
