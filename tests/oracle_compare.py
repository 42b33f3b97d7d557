"""Run registered queries next to their DuckDB oracle and compare results.

Row count, column names and the multiset of rows (columns sorted by name)
must agree.  CLI: ``python -m tests.oracle_compare [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, float) and v.is_integer():
        return int(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(cols)


def compare(spark, con, name: str, sf_dir: str, queries: dict, oracle: dict) -> dict:
    t0 = time.time()
    sdf = queries[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(oracle[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    t2 = time.time()
    s, scols = _rows(sdf.columns, srows)
    d, dcols_s = _rows(dcols, drows)
    res = {
        "name": name,
        "spark_rows": len(s),
        "oracle_rows": len(d),
        "cols_match": scols == dcols_s,
        "rows_match": Counter(s) == Counter(d),
        "spark_s": round(t1 - t0, 2),
        "oracle_s": round(t2 - t1, 2),
    }
    if not res["cols_match"]:
        res["spark_cols"] = scols
        res["oracle_cols"] = dcols_s
    elif not res["rows_match"]:
        cs, cd = Counter(s), Counter(d)
        res["only_spark"] = list((cs - cd).elements())[:3]
        res["only_oracle"] = list((cd - cs).elements())[:3]
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from devtrail.oracle import ORACLE
    from devtrail.registry import QUERIES
    from devtrail.session import local_session

    plain = "--default-session" in argv
    argv = [a for a in argv if a != "--default-session"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(QUERIES)
    if plain:  # a session with Spark's defaults only, as a caller might have
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false").getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in ORACLE:
            print(f"{n}: no oracle")
            continue
        try:
            r = compare(spark, con, n, sf_dir, QUERIES, ORACLE)
        except Exception as e:  # report and go on
            bad += 1
            print(f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["cols_match"] and r["rows_match"]
        bad += not ok
        print(("OK  " if ok else "FAIL") + f" {n}: {r}")
        spark.catalog.clearCache()
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
