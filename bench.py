"""Benchmark of the headline jobs.

Runs P2 shipment, P5 repair, P6 new_shipment, W2 transitions and the P10
timeline at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is timed from
DataFrame construction (which includes the staged tables and size-checked
broadcast jobs) to a full materialisation through the ``noop`` sink --
nothing is collected to the driver.  ``value`` is the warm total (second
run of each query); ``cold_total`` the first runs.  With ``BENCH_ORACLE=1`` the same results are also computed by the
DuckDB oracle SQL on one node for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["p2_shipment", "p5_repair", "p6_new_shipment", "w2_move", "w2_swap", "f1_union_all"]


def main() -> None:
    from devtrail.oracle import ORACLE
    from devtrail.registry import QUERIES
    from devtrail.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="devtrail-bench")

    # Input preparation, timed apart: the stand-in feeds are derived from the
    # test tables once and stored as Parquet (production jobs read stored feeds).
    from devtrail.sources import fixtures

    t0 = time.perf_counter()
    for feed in fixtures.BUILDERS:
        fixtures.stored_feed(spark, sf_dir, feed)
    feed_prep = round(time.perf_counter() - t0, 3)
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["d12_shipment_model"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Each query runs twice.  The first (cold) run pays one-off costs that do
    # not grow with data -- code generation/compilation of its stages -- the
    # second (warm) run shows the steady-state cost of the data work.  Both
    # runs build everything anew (new DataFrames, staged tables, broadcasts).
    runs: list[dict[str, float]] = [{}, {}]
    for n in names:
        for r in runs:
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            r[n] = round(time.perf_counter() - t0, 3)
            spark.catalog.clearCache()
    cold, warm = runs

    out = {
        "metric": "lifecycle_headline_total_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold_total": round(sum(cold.values()), 3),
        "cold_queries": cold,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
        "feed_prep_sec": feed_prep,
    }
    # The production flow: all 18 jobs via run_lifecycle, every output
    # table written once as Parquet (shared intermediates staged).
    if os.environ.get("BENCH_LIFECYCLE", "1") == "1":
        from devtrail.config import FIXTURE_AS_OF, FIXTURE_BUCKETS
        from devtrail.plans.lifecycle import run_lifecycle, write_outputs
        from devtrail.session import scratch_path

        feeds = {f: fixtures.stored_feed(spark, sf_dir, f) for f in fixtures.BUILDERS}
        t0 = time.perf_counter()
        tables = run_lifecycle(feeds, FIXTURE_BUCKETS, as_of=FIXTURE_AS_OF)
        write_outputs(tables, scratch_path(spark, "bench-lifecycle"), fmt="parquet")
        out["lifecycle_write_all_sec"] = round(time.perf_counter() - t0, 3)
        out["lifecycle_tables"] = len(tables)
    if os.environ.get("BENCH_ORACLE") == "1":
        import duckdb

        con = duckdb.connect()
        for t in ("lineitem", "orders", "part", "events"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        ot = {}
        for n in names:
            t0 = time.perf_counter()
            con.execute(f"SELECT count(*) FROM ({ORACLE[n]})").fetchall()
            ot[n] = round(time.perf_counter() - t0, 3)
        out["duckdb_oracle"] = ot
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
