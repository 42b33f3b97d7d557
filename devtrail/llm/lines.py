"""Line dedup by distinct-site spread (operator 8): DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm.common import fresh, table
from devtrail.operators.joins import sized_broadcast
from devtrail.session import stage

LEAST_SITES = 2  # distinct sites that make a line boilerplate, whatever their number in the table
SHORT_CHARS = 24  # shorter lines may coincide by chance: they need more sites
SHARE, SHORT_SHARE = 0.1, 0.3  # of all sites that a line, and a short one, must stand on
SKETCH = 12  # log2 of the sketch's registers: standard error 1.6%
BAND = 0.1  # estimates this near the threshold are counted exactly
MAX_LINES = 500_000  # boilerplate lines that are broadcast; more are joined by a shuffle


def _site(source: str) -> Column:
    return F.xxhash64(F.col(source).isNull(), F.col(source))


def site_thresholds(n_sites: int, share: float = SHARE, short_share: float = SHORT_SHARE) -> tuple[int, int]:
    """The distinct sites that make a line, and a short one, boilerplate in a
    table of ``n_sites`` sites."""
    return tuple(max(LEAST_SITES, math.ceil(round(x * n_sites, 9))) for x in (share, short_share))


def boilerplate_lines(lines: DataFrame, min_sites: int, short_sites: int | None = None) -> DataFrame:
    """(line, line2, first) of the lines of ``lines`` (line and line2, two hashes,
    short, site, at) that stand on ``min_sites`` or more distinct sites, short
    ones on ``short_sites``; ``first`` is their smallest ``at``.

    Sketches merge by aggregation, so a line of a third of all documents sends
    one sketch from each task.  Estimates within BAND of the threshold (six
    standard errors) are replaced by exact distinct counts.
    """
    needed = F.when(F.col("short"), F.lit(short_sites or min_sites)).otherwise(F.lit(min_sites))
    key = ["line", "line2"]
    spread = lines.groupBy(*key).agg(F.hll_sketch_agg("site", F.lit(SKETCH)).alias("sketch"), F.min("at").alias("first"), F.max("short").alias("short"))
    spread = spread.select(*key, "first", needed.alias("needed"), F.hll_sketch_estimate("sketch").alias("sites"))
    spread = stage(spread.where(F.col("sites") >= F.col("needed") * (1 - BAND)), "lines-spread")
    near = spread.where(F.col("sites") <= F.col("needed") * (1 + BAND)).select(*key, "first", "needed")
    exact = lines.select(*key, "site").join(sized_broadcast(near, MAX_LINES), key).groupBy(*key, "first", "needed", "site").agg(F.lit(1).alias("one"))
    exact = exact.groupBy(*key, "first", "needed").agg(F.count("*").alias("sites")).where(F.col("sites") >= F.col("needed"))
    return spread.where(F.col("sites") > F.col("needed") * (1 + BAND)).select(*key, "first").union(exact.select(*key, "first"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", site: str = "source",
                min_sites: int | None = None, short_sites: int | None = None) -> DataFrame:
    """``docs`` without the lines that stand on many distinct sites, but for each
    such line's first place (by doc_id, null last, then text hash and line
    number); with ``n_lines`` and ``removed_lines``.

    Many is ``min_sites``, for lines under SHORT_CHARS characters
    ``short_sites``; by default shares of the table's sites, two at least
    (``site_thresholds``).  Every line that is not empty is sketched.  Lines are
    compared without spaces, tabs and carriage returns at their ends, by two
    hashes.  Texts without such a line stay as they are, whatever their length;
    a text that loses all lines becomes empty.  A null text stays
    null with 0 lines, an empty one is one line.  A null site is one site.  Rows
    with equal id and text are treated alike.  Columns named n_lines or
    removed_lines are replaced, other columns stay.
    """
    docs = docs.drop("n_lines", "removed_lines")
    key, gone, k_id, k_text = fresh(docs, "text_key", "gone", "key_id", "key_text")
    split = F.split(F.col(text), "\n")
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), _site(site).alias("site"), F.posexplode(split).alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(" \t\r"))).where(F.length("line") > 0)
    rows = rows.select(F.xxhash64("line").alias("line"), F.xxhash64(F.lit("line"), "line").alias("line2"), (F.length("line") < SHORT_CHARS).alias("short"), "site",
                       F.struct(F.col("id").isNull().alias("none"), "id", "key", "pos").alias("at"))
    if min_sites is None:
        sites = docs.select(_site(site).alias("site")).agg(F.count_distinct("site")).first()[0]
        min_sites, short_default = site_thresholds(sites)
        short_sites = short_sites or short_default
    spread = sized_broadcast(boilerplate_lines(rows, min_sites, short_sites), MAX_LINES)
    same_doc = (F.col("at.none") == F.col("first.none")) & F.col("at.id").eqNullSafe(F.col("first.id")) & (F.col("at.key") == F.col("first.key"))
    drops = rows.join(spread, ["line", "line2"]).where(~(same_doc & (F.col("at.pos") == F.col("first.pos"))))
    drops = drops.groupBy(F.col("at.id").alias(k_id), F.col("at.key").alias(k_text)).agg(F.collect_set("at.pos").alias(gone))
    marked = docs.withColumn(key, F.xxhash64(text))
    out = marked.join(drops, F.col(doc_id).eqNullSafe(F.col(k_id)) & (F.col(key) == F.col(k_text)), "left")
    left = F.array_join(F.filter(split, lambda x, i: ~F.array_contains(gone, i)), "\n")
    return out.select(*[F.when(F.col(gone).isNull(), F.col(text)).otherwise(left).alias(text) if c == text else F.col(c) for c in docs.columns],
                      F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
                      F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("removed_lines"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after line dedup."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return dedup_lines(docs).select("doc_id", "n_lines", "removed_lines", "text")


OP8_SQL = rf"""
WITH rows AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
l AS (SELECT doc_id, source, pos, trim(line, ' ' || chr(9) || chr(13)) AS t FROM rows),
n AS (SELECT greatest({LEAST_SITES}, ceil(round({SHARE} * sites, 9))) AS needed, greatest({LEAST_SITES}, ceil(round({SHORT_SHARE} * sites, 9))) AS short
  FROM (SELECT count(DISTINCT coalesce(source, chr(0))) AS sites FROM documents)),
b AS (SELECT t, min((doc_id, pos)) AS first FROM l, n WHERE t <> ''
  GROUP BY t, needed, short HAVING count(DISTINCT coalesce(source, chr(0))) >= CASE WHEN length(t) < {SHORT_CHARS} THEN short ELSE needed END),
g AS (SELECT doc_id, list(pos) AS gone FROM l JOIN b USING (t) WHERE (doc_id, pos) <> first GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS removed_lines,
  CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i)), chr(10)), '') END AS text
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""
