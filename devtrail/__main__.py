"""Command line: run the lifecycle on raw Ctrl-A feeds (for spark-submit).

    python -m devtrail --shipment-orig P --sdac-orig P --uss-device P --repair-orig P \\
        --out DIR [--format parquet|text] [--as-of YYYY-MM-DD] \\
        --domestic "label,label" --overseas "label,..." [--only shipment,timeline] \\
        [--reference-file-counts | --rows-per-file N]

    python -m devtrail union --inputs DIR,DIR,... --out DIR [--num-files N] [--unordered]

Each input accepts a comma-separated list of paths (several folders of one
feed).  Outputs are written under ``DIR/<table>``; ``--only`` restricts the
tables written.  ``union`` puts event tables that were written as text
together line by line, without parsing them.  The session comes from spark-submit / the environment.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from .config import GRACE_MONTHS, HI, LO, REFERENCE_FILE_COUNTS, STALE_DAYS, Buckets
from .plans.lifecycle import BUCKET_TABLES, FEEDS, TABLES, run_lifecycle, write_outputs
from .session import run_scratch, scale_out
from .sources.landing import TextFeeds
from .sources.text import union_text


def _date(s: str | None) -> dt.date | None:
    return dt.date.fromisoformat(s) if s else None


def _labels(s: str) -> tuple[str, ...]:
    return tuple(x for x in (p.strip() for p in s.split(",")) if x)


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="devtrail", description="device-lifecycle tables from raw feeds")
    for feed in ("shipment-orig", "sdac-orig", "uss-device", "repair-orig"):
        p.add_argument(f"--{feed}", required=True, help="path(s), comma separated")
    p.add_argument("--out", required=True)
    p.add_argument("--format", choices=("parquet", "text"), default="parquet")
    p.add_argument("--as-of", help="reference day of the abandon jobs (default: today)")
    p.add_argument("--lo", default=LO.isoformat())
    p.add_argument("--hi", default=HI.isoformat())
    p.add_argument("--stale-days", type=int, default=STALE_DAYS)
    p.add_argument("--grace-months", type=int, default=GRACE_MONTHS)
    p.add_argument("--domestic", default="", help="domestic data-source labels, comma separated")
    p.add_argument("--overseas", default="", help="overseas data-source labels, comma separated")
    p.add_argument("--checkin-source", choices=("deduped", "raw"), default="deduped")
    p.add_argument("--only", default="", help="tables to write, comma separated (default: all)")
    p.add_argument("--mode", choices=("overwrite", "errorifexists"), default="overwrite")
    p.add_argument("--rows-per-file", type=int, help="even files of at most so many rows")
    p.add_argument(
        "--reference-file-counts", action="store_true",
        help="write each table in the file count of the surveyed jobs (default: sized by AQE)",
    )
    a = p.parse_args(argv)
    only = _labels(a.only)
    known = {*TABLES, *(f"{f}_bad_lines" for f in FEEDS)}
    if unknown := sorted(set(only) - known):
        p.error(f"unknown tables: {', '.join(unknown)}")
    if not (a.domestic or a.overseas) and (not only or set(only) & set(BUCKET_TABLES)):
        p.error(f"--domestic and --overseas are needed for {', '.join(BUCKET_TABLES)}")
    return a


def _session():
    from pyspark.sql import SparkSession

    return scale_out(SparkSession.builder.appName("devtrail").getOrCreate())


def union_main(argv: list[str], spark=None) -> None:
    p = argparse.ArgumentParser(prog="devtrail union", description="text event tables into one, line by line")
    p.add_argument("--inputs", required=True, help="folders, comma separated, in the order to keep")
    p.add_argument("--out", required=True)
    p.add_argument("--num-files", type=int)
    p.add_argument("--unordered", action="store_true", help="no shuffle: lines in any order")
    p.add_argument("--mode", choices=("overwrite", "errorifexists"), default="overwrite")
    a = p.parse_args(argv)
    union_text(spark or _session(), a.inputs.split(","), a.out, mode=a.mode, num_files=a.num_files, ordered=not a.unordered)


def main(argv: list[str] | None = None, spark=None) -> dict:
    """Write the chosen tables; their paths by name."""
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["union"]:
        return union_main(argv[1:], spark) or {}
    a = parse_args(argv)
    spark = spark or _session()
    paths = {
        "shipment_orig": a.shipment_orig.split(","),
        "sdac_orig": a.sdac_orig.split(","),
        "uss_device": a.uss_device.split(","),
        "repair_orig": a.repair_orig.split(","),
    }
    feeds = TextFeeds(spark, paths)  # each landed by one scan when a table needs it
    only = _labels(a.only)
    tables = [x for x in only if x in TABLES] if only else list(TABLES)
    with run_scratch(spark):
        chosen = run_lifecycle(
            feeds,
            Buckets(_labels(a.domestic), _labels(a.overseas)),
            lo=_date(a.lo),
            hi=_date(a.hi),
            as_of=_date(a.as_of),
            days=a.stale_days,
            grace=a.grace_months,
            checkin_source=a.checkin_source,
            only=tables,
        ) if tables else {}
        chosen.update({f"{k}_bad_lines": feeds.bad_lines(k) for k in FEEDS if not only or f"{k}_bad_lines" in only})
        files = REFERENCE_FILE_COUNTS if a.reference_file_counts else None
        write_outputs(chosen, a.out, fmt=a.format, mode=a.mode, num_files=files, rows_per_file=a.rows_per_file)
    return {name: f"{a.out.rstrip('/')}/{name}" for name in chosen}  # what the run staged is gone


if __name__ == "__main__":
    main()
