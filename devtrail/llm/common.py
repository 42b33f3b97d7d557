"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devtrail.session import stage

#: ASCII white space; everything else is part of a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | Column) -> Column:
    """Number of words of a text, 0 for a null one."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names built from ``names`` that no column of ``df`` has."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n = f"_{n}"
        have.add(n.lower())
        out.append(n)
    return out


def worker_cache(name: str) -> dict:
    """A dict that lives across the tasks of a Python worker, until a worker
    function asks for one of another name: workers outlive a stage, and only
    one stage's cache is kept."""
    held = sys.modules.setdefault("_devtrail_worker_cache", types.ModuleType("_devtrail_worker_cache"))
    if getattr(held, "name", None) != name:
        held.name, held.cache = name, {}
    return held.cache


ROWS = 2_000_000  # of one range of a running total, about


def running_total(df: DataFrame, value: str, group: list[Column], order: list[Column], out: str, name: str, rows: int = 0) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same group that sort
    before a row, for groups of any size.

    The rows are range-partitioned by (group, order), so a group that holds a
    third of them spreads over many partitions, and written once with their
    partition's number.  Sums per (partition, group) are few; a group's running
    sum over its partitions gives each partition's start, and a window inside
    (partition, group) does the rest.  ``order`` must be total up to equal rows.
    ``rows``, their number, gives large tables more ranges than the session's
    shuffle partitions.
    """
    # The group is kept as a string key; null groups get their own key.
    keyed = df.withColumn("_g", F.to_json(F.struct(*[g.alias(f"g{i}") for i, g in enumerate(group)])) if group else F.lit(""))
    for i, o in enumerate(order):
        keyed = keyed.withColumn(f"_o{i}", o)
    keys = ["_g", *(f"_o{i}" for i in range(len(order)))]
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS))
    placed = stage(keyed.repartitionByRange(n, *keys).withColumn("_p", F.spark_partition_id()), name)
    starts = placed.groupBy("_p", "_g").agg(F.sum(value).alias("_t"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_p", "_g", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_p", "_g").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    rows = rows.join(starts, ["_p", "_g"]).withColumn(out, F.col("_start") + F.col("_in"))
    return rows.drop("_p", "_g", "_in", "_start", *keys[1:])
