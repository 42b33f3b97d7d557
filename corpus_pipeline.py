"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on every row its predecessor kept, and returns the next stage's rows.

All stages but the last return the columns of ``documents`` alone: other columns,
also those named like an operator's own, are left behind.  Nulls in any column,
empty and very long texts, ties, repeated rows and empty tables go through every
stage; what a stage makes of them is stated with it, and an empty table stays an
empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm import lines, mixing, packing, simhash, toxicity
from devtrail.llm.common import WORD, table, words_of
from devtrail.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go.  Null and empty texts
    hold no evidence and stay; texts are read whole; repeated rows share a
    verdict; null ids do not matter to a score."""
    scored = toxicity.classify_toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("toxic = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go, but for their first place (smallest id,
    null last); no document goes.  Null texts stay null; a text that loses all
    lines, as a copy on another site does, becomes empty; a null source is one
    site; equal rows keep their lines alike; ``n_chars`` follows the text."""
    clean = lines.dedup_lines(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the first by id (null last)
    and text.  Null and empty texts have one fingerprint, so one of them stays
    beside near copies of nothing; repeated rows leave one; long texts are read
    whole."""
    return simhash.first_of_each(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that it takes, once for each time it takes them; the
    one in service when a source's target is met keeps its words up to there.
    Null and empty texts hold no word and are never taken; a null source is one
    source; repeated rows are documents of their own; ties go by id, size and
    row."""
    mixed = mixing.mix(docs.select(*COLUMNS, words_of("text").alias("size"))).where("take > 0")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), F.lit(1), F.col("take").cast("int")), "")
    partly = F.col("take") < F.col("size")
    mixed = mixed.withColumn("text", F.when(partly, cut).otherwise(F.col("text")))
    return mixed.withColumn("n_chars", F.when(partly, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences, one row per piece of a document.  A null or empty
    text is its end token; long ones are cut at window ends; repeated rows are
    packed each; null ids stay null."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
