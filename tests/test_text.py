"""Text edges and the whole lifecycle on raw Ctrl-A feeds (FIXTURES.md section 1).

Hand-written feeds hold the edge rows: wrong width, empty date, ten-character
non-date, ``\\N``, two records with the same best date, dates below the floor
and above the ceiling, a device unknown to shipment, a SIM going A->B->A,
same-day neighbours, one observation only, warranty -1 / 0 / 12 /
non-numeric, a claim before the start and an unknown source.
"""

import datetime as dt
import os
import tempfile

import pytest

from devtrail.config import Buckets
from devtrail.plans.lifecycle import read_text_feeds, run_lifecycle, write_outputs
from devtrail.sources.text import LAYOUTS, read_delimited, read_lines, write_delimited
from tests.helpers import rows

SEP = "\u0001"
D = dt.date


def line(layout, **fields):
    """One raw line: named fields at their positions, payload ``pNN`` elsewhere."""
    cols = layout.columns()
    return SEP.join(fields.get(c, f"p{i:02d}") for i, c in enumerate(cols))


def write_feed(folder, name, lines):
    path = os.path.join(folder, name)
    os.makedirs(path)
    with open(os.path.join(path, "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


@pytest.fixture(scope="module")
def raw_feeds(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("feeds"))
    S, R, U, A = (LAYOUTS[n] for n in ("shipment_orig", "sdac_orig", "uss_device", "repair_orig"))
    ts = lambda day: f"{day} 08:00:00"
    shipment = [
        line(S, imei="d1", model="M1", mfg_date="2001-01-01", shipment_date="2001-02-01", c00="b"),
        line(S, imei="d1", model="M1", mfg_date="2001-01-05", shipment_date="2001-02-01", c00="a"),  # same best date
        line(S, imei="d2", model="M1", mfg_date="", shipment_date="2001-03-01"),                     # empty date
        line(S, imei="d2", model="M1", mfg_date="2001-0X-01", shipment_date="\\N"),                  # non-date, \N
        line(S, imei="d3", model="M2", mfg_date="2002-05-01", shipment_date="2002-04-01"),           # mfg after ship
        line(S, imei="d5", model="M2", mfg_date="1999-01-01", shipment_date="1999-06-01"),           # below floor
        SEP.join(["short"] * 28),                                                                    # wrong width
    ]
    sdac = [
        line(R, imei="d1", create_date="2001-03-01"),
        line(R, imei="d1", create_date="2001-02-20"),
        line(R, imei="d2", create_date=""),
        line(R, imei="d9", create_date="2001-01-01"),   # unknown to shipment
        line(R, imei="d3", create_date="2021-01-01"),   # at/after the ceiling
    ]
    uss = [
        line(U, imsi="s1", imei="d1", model="M1", first_ts=ts("2001-04-01"), last_ts=ts("2001-04-02")),
        line(U, imsi="s1", imei="d3", model="M2", first_ts=ts("2001-05-01"), last_ts=ts("2001-05-02")),  # A->B
        line(U, imsi="s1", imei="d1", model="M1", first_ts=ts("2001-06-01"), last_ts=ts("2001-06-01")),  # B->A
        line(U, imsi="s2", imei="d2", model="M1", first_ts=ts("2001-04-10"), last_ts=ts("2001-04-10")),
        line(U, imsi="s2", imei="d1", model="M1", first_ts=ts("2001-04-10"), last_ts=ts("2001-04-10")),  # same day
        line(U, imsi="s2", imei="d1", model="M1", first_ts=ts("2001-04-12"), last_ts=ts("2001-04-12")),  # swap d2->d1
        line(U, imsi="s3", imei="d2", model="M1", first_ts=ts("2001-07-01"), last_ts=ts("2001-07-03")),  # one device
        line(U, imsi="s4", imei="d9", model="M9", first_ts=ts("2001-01-01"), last_ts=ts("2001-01-05")),  # unknown
        line(U, imsi="s5", imei="d5", model="M2", first_ts=ts("1999-01-01"), last_ts=ts("1999-02-01")),  # below floor
        line(U, imsi="s6", imei="d2", model="M1", first_ts="", last_ts="2001-09-01"),                    # short ts
    ]
    repair = [
        line(A, data_source="DOM", imei="d1", claim_date="2001-05-01", purchase_date="2001-02-01", warranty_period="12", c01="x"),
        line(A, data_source="DOM", imei="d1", claim_date="2001-05-01", purchase_date="2001-02-01", warranty_period="12", c01="y"),
        line(A, data_source="OVS", imei="d1", claim_date="2001-07-01", purchase_date="", warranty_period="-1"),
        line(A, data_source="DOM", imei="d2", claim_date="2001-02-01", purchase_date="", warranty_period="0"),
        line(A, data_source="ZZZ", imei="d3", claim_date="2002-06-01", purchase_date="", warranty_period="12"),
        line(A, data_source="OVS", imei="d3", claim_date="2002-06-02", purchase_date="", warranty_period="abc"),
        line(A, data_source="DOM", imei="d9", claim_date="2001-01-01", purchase_date="", warranty_period="12"),
    ]
    return {
        "shipment_orig": write_feed(d, "shipment_orig", shipment),
        "sdac_orig": write_feed(d, "sdac_orig", sdac),
        "uss_device": write_feed(d, "uss_device", uss),
        "repair_orig": write_feed(d, "repair_orig", repair),
    }


@pytest.fixture(scope="module")
def outputs(spark, raw_feeds):
    feeds, rejects = read_text_feeds(spark, raw_feeds)
    assert rejects["shipment_orig"].count() == 1
    return run_lifecycle(feeds, Buckets(("DOM",), ("OVS",)), as_of=D(2001, 10, 1))


def test_width_guard_keeps_trailing_empty_fields(spark, tmp_path):
    p = write_feed(str(tmp_path), "x", ["a" + SEP + SEP, "a" + SEP + "b", "a", "\\N" + SEP + "" + SEP + ""])
    good, rejects = read_delimited(spark, p, ["f0", "f1", "f2"])
    assert rows(good) == [("\\N", "", ""), ("a", "", "")]
    assert rows(rejects) == [("a",), ("a" + SEP + "b",)]


def test_dimension_tables(outputs):
    ship = {r.imei: r for r in outputs["shipment"].collect()}
    assert sorted(ship) == ["d1", "d2", "d3"]
    assert ship["d1"].c00 == "a"                             # tie on the date: smallest payload wins
    assert ship["d2"].mfg_date is None and ship["d2"].first_mfg_date == D(2001, 1, 1)
    assert ship["d3"].first_mfg_date == D(1999, 1, 1)        # model dates come from raw rows (Q10)
    assert rows(outputs["shipment_rejects"], "imei") == [("d5",)]
    assert rows(outputs["shipment_exception"], "imei") == [("d3",)]
    assert rows(outputs["sdac"], "imei", "create_date", "first_sdac_date") == [("d1", D(2001, 2, 20), D(2001, 2, 20))]
    assert rows(outputs["sdac_rejects"], "imei") == [("d3",)]
    assert rows(outputs["sdac_exception"], "imei") == [("d9",)]
    act = rows(outputs["activation"])
    assert act == [
        # first_checkin_date: model minimum of the devices' *latest* days (Q19)
        ("d1", D(2001, 6, 1), D(2001, 6, 1), 1),
        ("d2", D(2001, 7, 3), D(2001, 6, 1), 1),   # the 10-character last-seen of s6 is no timestamp
        ("d3", D(2001, 5, 2), D(2001, 5, 2), 1),
    ]
    assert rows(outputs["activation_exception"], "imei") == [("d9",)]


def test_repair_tags(outputs):
    rep = rows(outputs["repair"], "imei", "claim_date", "c01", "failure_count", "is_real_in_warranty")
    assert rep == [
        ("d1", D(2001, 5, 1), "x", "1", "1"),    # duplicate (imei, claim_date) collapsed; in warranty
        ("d1", D(2001, 7, 1), "p01", "2", "3"),  # negative period
        ("d2", D(2001, 2, 1), "p01", "1", "1"),  # claim before the shipment start: in
        ("d3", D(2002, 6, 1), "p01", "1", "0"),  # unknown source
    ]
    assert rows(outputs["repair_period_rejects"], "imei", "claim_date") == [("d3", D(2002, 6, 2))]
    assert rows(outputs["repair_exception"], "imei") == [("d9",)]


def test_events(outputs):
    assert rows(outputs["move"], "uid", "imei", "toimei", "eventdate") == [
        ("s1", "d1", "d3", D(2001, 5, 1)), ("s1", "d3", "d1", D(2001, 6, 1))
    ]
    # same-day neighbours emit nothing; the day's last device (by imei) is d2
    assert rows(outputs["swap"], "uid", "imei", "toimei", "eventdate") == [("s2", "d2", "d1", D(2001, 4, 12))]
    cab = rows(outputs["cabandon"], "uid", "imei", "eventdate")
    assert ("s5", "d5", D(1999, 2, 1)) not in cab                     # below the floor: rejected, no "dummy"
    assert rows(outputs["cabandon_rejects"], "imsi") == [("s5",)]
    dab = rows(outputs["dabandon"], "imei", "eventdate")
    assert ("d5", D(2000, 1, 1)) in dab                                # scalar fold keeps the floor
    assert ("d2", D(2001, 7, 3)) in dab
    assert rows(outputs["dabandon_exception"], "imei") == [("d5",), ("d9",)]
    counts = {r.eventtype: r.n for r in outputs["timeline"].groupBy("eventtype").count().withColumnRenamed("count", "n").collect()}
    n_ship, n_cx, n_mv, n_rep = (outputs[k].count() for k in ("new_shipment_events", "new_complex", "new_move", "new_repair"))
    assert sum(counts.values()) == n_ship + n_cx + n_mv + n_rep
    assert counts["move"] == 2 and counts["shipment"] == 3


def test_text_sink_widths_and_markers(spark, outputs):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write_outputs(outputs, base, fmt="text")
    widths = {}
    for name in ("shipment", "sdac", "activation", "repair", "new_shipment", "new_shipment_events",
                 "new_complex", "new_repair", "new_move", "new_repair_exception", "cabandon"):
        lines = [r.value for r in read_lines(spark, f"{base}/{name}").collect()]
        widths[name] = {len(v.split(SEP)) for v in lines}
    assert widths == {
        "shipment": {31}, "sdac": {8}, "activation": {4}, "repair": {39}, "new_shipment": {44},
        "new_shipment_events": {46}, "new_complex": {52}, "new_repair": {91}, "new_move": {135},
        "new_repair_exception": {83}, "cabandon": {6},
    }
    tl = [r.value.split(SEP) for r in read_lines(spark, f"{base}/timeline").collect()]
    by_type = {}
    for f in tl:
        by_type.setdefault(f[0], set()).add(len(f))
    assert by_type == {"shipment": {46}, "cabandon": {52}, "dabandon": {52}, "swap": {52}, "move": {135}, "repair": {91}}
    rep = next(f for f in tl if f[0] == "repair")
    assert rep[46:52] == ["\\N"] * 6                                   # empty exchange slot
    dab = next(f for f in tl if f[0] == "dabandon")
    assert dab[46:52][:2] == ["NA", "NA"] and dab[46 + 3] == "NA"     # not-applicable exchange fields
    ship_line = next(f for f in tl if f[0] == "shipment" and f[11] == "d2")
    assert ship_line[2 + 31:2 + 35] == ["\\N"] * 4                     # no SDAC row for d2
    cab_text = [r.value.split(SEP) for r in read_lines(spark, f"{base}/cabandon").collect()]
    assert all(f[1] == "imsi" and f[3] == "NA" and f[4] == "cabandon" for f in cab_text)


def test_fail_if_exists_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    p = str(tmp_path / "out")
    write_delimited(df, p, mode="errorifexists")
    with pytest.raises(Exception):
        write_delimited(df, p, mode="errorifexists")
    write_delimited(df, p, mode="overwrite")
    assert [r.value for r in read_lines(spark, p).collect()] == ["a" + SEP + "1"]


def test_command_line_writes_chosen_tables(spark, raw_feeds, tmp_path):
    from devtrail.__main__ import main

    out = str(tmp_path / "out")
    args = [f"--{k.replace('_', '-')}={v}" for k, v in raw_feeds.items()]
    args += [f"--out={out}", "--format=text", "--as-of=2001-10-01", "--domestic=DOM", "--overseas=OVS",
             "--only=shipment,repair,timeline,shipment_orig_bad_lines", "--reference-file-counts"]
    written = main(args, spark=spark)
    assert sorted(written) == ["repair", "shipment", "shipment_orig_bad_lines", "timeline"]
    assert len(read_lines(spark, f"{out}/shipment").collect()) == 3
    assert len(read_lines(spark, f"{out}/shipment_orig_bad_lines").collect()) == 1
    assert len([f for f in os.listdir(f"{out}/repair") if f.startswith("part-")]) <= 20  # at most the surveyed count


def test_later_jobs_run_on_text_intermediates(spark, outputs, tmp_path):
    """The surveyed jobs handed text tables to each other: read the written
    shipment/sdac/activation/repair/new_shipment text back and run P6 and P9."""
    from devtrail.plans.repair import build_new_repair
    from devtrail.plans.timeline import build_new_shipment
    from devtrail.sources.text import read_table

    base = str(tmp_path / "lifecycle")
    write_outputs({k: outputs[k] for k in ("shipment", "sdac", "activation", "repair", "new_shipment")}, base, fmt="text")
    t = {k: read_table(spark, f"{base}/{k}", k)[0] for k in ("shipment", "sdac", "activation", "repair", "new_shipment")}
    assert rows(t["repair"]) == rows(outputs["repair"])
    assert rows(t["new_shipment"]) == rows(outputs["new_shipment"])
    ns = build_new_shipment(t["shipment"], t["sdac"], t["activation"])  # first_launch_date aggregated here
    assert rows(ns["new_shipment"]) == rows(outputs["new_shipment"])
    rep = build_new_repair(t["repair"], t["new_shipment"])
    assert rows(rep["new_repair_exception"]) == rows(outputs["new_repair_exception"])



def test_read_table_markers_and_types(spark, tmp_path):
    from devtrail.sources.text import read_table

    p = write_feed(str(tmp_path), "activation", [
        SEP.join(["d1", "2001-06-01", "NA", "1"]),
        SEP.join(["d2", "\\N", "2001-02-31", "x"]),
        SEP.join(["short", "line"]),
    ])
    t, rejects = read_table(spark, p, "activation")
    assert dict(t.dtypes) == {"imei": "string", "activation_date": "date", "first_checkin_date": "date",
                              "checkin_count": "bigint"}
    assert rows(t) == [("d1", D(2001, 6, 1), None, 1), ("d2", None, None, None)]
    assert rejects.count() == 1


def test_timeline_text_is_read_back_row_for_row(spark, outputs, tmp_path):
    from devtrail.sources.text import place_events, read_table

    write_outputs({"timeline": outputs["timeline"]}, str(tmp_path), fmt="text")
    back, rejects = read_table(spark, f"{tmp_path}/timeline", "timeline")
    want = place_events(outputs["timeline"])
    assert rejects.count() == 0 and back.columns == want.columns
    typed = dict(outputs["timeline"].dtypes)
    assert {c: t for c, t in back.dtypes if c in typed} == {c: typed[c] for c in back.columns if c in typed}
    assert rows(back) == rows(want)


def test_ragged_lines_of_a_wrong_width_are_rejects(spark, tmp_path):
    from devtrail.sources.text import Layout, read_ragged

    p = write_feed(str(tmp_path), "x", [SEP.join(x) for x in (["a", "1"], ["a", "1", ""], ["b", "1", "2", "3"], ["b", "1"], ["c", "1"], ["a"], ["a", "1", "2", "3"], [""])])
    good, rejects = read_ragged(spark, p, Layout(4, {0: "kind"}), {"a": (2, 3), "b": (4,)})
    assert good.columns == ["kind", "c01", "c02", "c03"]
    assert rows(good) == sorted([("a", "1", None, None), ("a", "1", "", None), ("b", "1", "2", "3")], key=repr)
    assert rows(rejects) == sorted([(SEP.join(x),) for x in (["b", "1"], ["c", "1"], ["a"], ["a", "1", "2", "3"], [""])], key=repr)
    with pytest.raises(ValueError):
        read_ragged(spark, p, Layout(3), {"a": (4,)})
