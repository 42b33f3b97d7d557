"""Mixing sources to target weights by weighted fair queueing (operator 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm.common import fresh, running_total, table, words_of
from devtrail.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
REPEATS = 2  # times a document is taken at most
SEED = 17


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: ``share`` of all words
    dealt by weight, no source above ``repeats`` times its own words, the
    excess dealt again by weight until none is above (with ``share`` of
    ``repeats`` or more all end at their caps).

    Weights repeat over the sources by code point, null last.  The sources are
    ranked by a distributed running count; each round of dealing sends three
    sums to the driver, whatever the number of sources.
    """
    ranked = running_total(sizes.withColumn("_one", F.lit(1)), "_one", [], [F.col("source").isNull(), F.col("source")], "_rank", "mix-ranks")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * float(repeats)).alias("_cap")), "mix-sources")
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("_cap") < F.col("_w") * level
        total, capped, open_w = ranked.agg(F.sum("source_size"), F.sum(F.when(full, F.col("_cap")).otherwise(0.0)),
                                           F.sum(F.when(~full, F.col("_w")).otherwise(0.0))).first()
        if total and not open_w:
            break  # every source is at its cap: there is no more to deal
        now = (share * total - capped) / open_w if total and open_w else 0.0
        if now == level:
            break
        level = now
    return ranked.select("source", "source_size", F.least("_cap", F.col("_w") * level).alias("target"))


def mix(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", size: str = "size", weights=WEIGHTS,
        share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """The mix: rows of ``docs`` with ``source_size``, ``target``, ``epoch``
    (0 for the first pass over its source, 1 for the second, ...), ``take``
    (words taken of this copy), ``finish`` (virtual finish time) and
    ``position`` (words of the mix before it).  A row that the mix does not
    reach has epoch -1, take 0 and null in finish and position.

    Each source is a queue of its documents in seeded order, repeated up to
    ``repeats`` times.  A copy's virtual finish time is its source's cumulative
    words over the source's target, so all queues reach time 1 when the total
    budget is spent; the copy in service then is cut there.  The copies are
    range-sorted by finish time over all sources and truncated at the budget.
    ``size`` is a column of word counts (null: 0).  Empty documents are never
    taken.  Null sources are one source; rows that repeat are separate
    documents; a null doc_id is shuffled like an empty one; ties in the seeded
    order go by id, size and row.  A document of any size is cut where its
    source's target is met.  Columns of ``docs`` that have the new names are
    replaced, all others stay; an empty table gives an empty one.
    """
    new = ("source_size", "target", "epoch", "take", "finish", "position")
    docs = docs.drop(*new)
    row, key, before, src, n = fresh(docs, "row", "key", "before", "src", "words")
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    rows = docs.count()
    slim = docs.select(row, F.col(source).alias("source"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias(n), F.col(doc_id).alias("_id"),
                       F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))).alias(key))
    sizes = slim.groupBy("source").agg(F.sum(n).alias("source_size"))
    targets = stage(source_targets(sizes, weights, share, repeats).withColumn("_quota", F.floor("target").cast("long")), "mix-targets")
    queued = running_total(slim, n, [F.col("source")], [F.col(key), F.col("_id"), F.col(n), F.col(row)], before, "mix-queues", rows)
    queued = queued.join(targets, queued["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    passes = queued.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    begin = F.col("epoch") * F.col("source_size") + F.col(before)
    take = F.least(F.col(n), F.col("_quota") - begin)
    copies = passes.withColumn("take", take).where((F.col("take") > 0) & (F.col(n) > 0))
    copies = copies.withColumn("finish", F.least(begin + F.col(n), F.col("_quota")) / F.col("_quota"))
    budget = targets.agg(F.sum("_quota")).first()[0] or 0
    order = [F.col("finish"), F.col("source").isNull(), F.col("source"), F.col("epoch"), F.col(key), F.col("_id"), F.col(row)]
    copies = running_total(copies.select(row, "source", key, "_id", "epoch", "take", "finish"), "take", [], order, "position", "mix-order", repeats * rows)
    copies = copies.where(F.col("position") < budget).select(row, "epoch", "take", "finish", "position")
    out = docs.join(copies, row, "left").withColumnRenamed(source, src).join(
        targets.select(F.col("source").alias("_s"), "source_size", "target"), F.col(src).eqNullSafe(F.col("_s"))).withColumnRenamed(src, source)
    return out.select(*[c for c in docs.columns if c != row], "source_size", "target", F.coalesce("epoch", F.lit(-1)).alias("epoch"),
                      F.coalesce("take", F.lit(0)).alias("take"), "finish", "position", F.col(row).alias("mix_row"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, repeats counted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words_of("text").alias("size"))
    return mix(docs).groupBy("mix_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.sum("take").cast("long").alias("taken")).drop("mix_row")


OP4_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS n,
    CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w
  FROM d GROUP BY source),
level(i, l) AS (
  SELECT 0, (SELECT 1.5 * sum(n) / sum(w) FROM s)
  UNION ALL
  SELECT i + 1, (SELECT (1.5 * sum(n) - sum(CASE WHEN 2 * n < w * l THEN 2 * n ELSE 0 END)) / sum(CASE WHEN 2 * n < w * l THEN 0 ELSE w END) FROM s)
  FROM level WHERE i < 40),
t AS (SELECT source, n, least(2 * n, w * (SELECT l FROM level WHERE i = 40)) AS target FROM s),
q AS (SELECT d.*, CAST(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS b FROM d)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, CAST(t.n AS BIGINT) AS source_size, t.target,
  CAST(greatest(0, least(q.size, floor(t.target) - q.b)) + greatest(0, least(q.size, floor(t.target) - t.n - q.b)) AS BIGINT) AS taken
FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source
"""
