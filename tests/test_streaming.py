"""Incremental landing of a raw feed: new files only, width guard, restartable."""

import os

from devtrail.sources.text import LAYOUTS
from devtrail.streaming import land_feed

SEP = "\u0001"


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_land_feed_incrementally(spark, tmp_path):
    src, target, ckpt = (str(tmp_path / n) for n in ("src", "target", "ckpt"))
    os.makedirs(src)
    layout = LAYOUTS["sdac_orig"]
    row = lambda imei, d: SEP.join(["x", imei, "x", "x", d, "x", "x"])
    _write(src, "a.txt", [row("d1", "2001-01-01"), row("d2", ""), "too" + SEP + "short"])
    q = land_feed(spark, src, "sdac_orig", target, checkpoint=ckpt)
    q.awaitTermination()
    _write(src, "b.txt", [row("d3", "2001-02-02")])
    q = land_feed(spark, src, layout, target, checkpoint=ckpt)  # restart: only the new file
    q.awaitTermination()
    good = spark.read.parquet(f"{target}/good")
    assert sorted((r.imei, r.create_date) for r in good.collect()) == [
        ("d1", "2001-01-01"), ("d2", ""), ("d3", "2001-02-02")
    ]
    assert spark.read.parquet(f"{target}/rejects").count() == 1
