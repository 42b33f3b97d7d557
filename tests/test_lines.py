"""Event lines: rendered by compiled code and split once when they are read."""

from pyspark.sql import functions as F

from devtrail.sources import textio
from devtrail.sources.text import LAYOUTS, place_events, read_delimited, read_lines, read_table, to_lines
from tests.helpers import rows
from tests.test_large import events, plan_text


def test_lines_are_rendered_without_a_function_over_their_fields(spark):
    placed = place_events(events(spark))
    lines = to_lines(placed, null_markers=textio.null_markers(placed), ragged_width=F.when(F.col("imei").isNull(), 12).otherwise(135))
    plan = plan_text(lines)
    assert "transform(" not in plan and "date_format" not in plan
    got = [r.value.split("\x01") for r in lines.collect()]
    assert {len(f) for f in got} == {12, 135} and all(f[0] == "move" and f[1].startswith("2001-") for f in got)
    assert all(f[11] == "\\N" for f in got if len(f) == 12)


def test_lines_are_split_once_and_only_used_fields_are_looked_at(spark, tmp_path):
    textio.write_event_text(events(spark), path := str(tmp_path / "move"), compression="lz4")
    for name in ("timeline", "new_move"):
        table, rejects = read_table(spark, path, name)
        few = table.select("eventtype", "imei", "to_imei")
        plan = plan_text(few)
        assert plan.count("split(") == 1 and "transform(" not in plan
        assert rows(few) == rows(events(spark).select("eventtype", F.col("imei").cast("string"), F.col("to_imei").cast("string")))
        assert rejects.count() == 0 and table.count() == 50


def test_width_guard_and_markers_stay(spark, tmp_path):
    lines = ["a\x01b", "a\x01", "\x01", "", "a", "a\x01b\x01c", "\\N\x01NA", "\x01\x01"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path := str(tmp_path / "t"))
    good, rejects = read_delimited(spark, path, ["x", "y"], absent=("\\N", "NA"))
    assert rows(good) == rows(spark.createDataFrame([("a", "b"), ("a", ""), ("", ""), (None, None)], "x string, y string"))
    assert sorted(r.value for r in rejects.collect()) == ["", "\x01\x01", "a", "a\x01b\x01c"]
    assert read_lines(spark, path).count() == len(lines) and len(LAYOUTS["timeline"].columns()) == 135
