"""SimHash near-duplicates with pigeonring candidate filtering (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devtrail.llm.common import fresh, table
from devtrail.llm.graph import components
from devtrail.session import stage

SEGMENTS = 8  # of 8 bits each, on a ring
CHAIN = 5  # segments of a key: the first ones exact, one of the others free
BLOCK = 2048  # fingerprints of one bucket that meet in one piece of work


def fingerprint_column(shingle: int) -> Column:
    """A pandas UDF: text to its 64-bit SimHash (as a signed long)."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
        out = np.zeros(len(texts), np.uint64)
        digest = xxhash.xxh64_intdigest
        for k, text in enumerate(texts):
            # bytes.lower and bytes.split know ASCII letters and ASCII space only
            words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
            if not words:
                continue
            joined = b" ".join(words)
            if len(words) <= shingle:
                h = np.array([digest(joined, 42)], np.uint64)
            else:
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                starts = np.concatenate([[0], ends[:-1] + 1])
                n = len(words) - shingle + 1
                h = np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())), np.uint64, n)
            octets = h.view(np.uint8).reshape(-1, 8)
            ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ bits for i in range(8)])
            out[k] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
        return pd.Series(out.view(np.int64))

    return fingerprint


def _budgets(distance: int) -> list[int]:
    """Most differing bits of a chain's first 1, 2, ... segments."""
    return [distance * n // SEGMENTS for n in range(1, SEGMENTS + 1)]


def _keys(fp: str, distance: int) -> Column:
    """The bucket keys of a fingerprint: for each start on the ring, a chain of
    CHAIN segments.  Its leading segments have a budget of 0 and must be equal;
    the later ones may differ in at most one bit together, so one of them is
    left out of the key in turn."""
    budget = _budgets(distance)
    if budget[CHAIN - 1] > 1:
        raise ValueError("these keys find all pairs for a distance of at most 3")
    exact = sum(x == 0 for x in budget[:CHAIN])
    segment = lambda i: F.shiftrightunsigned(fp, 8 * (i % SEGMENTS)).bitwiseAND(F.lit(255))
    keys = []
    for start in range(SEGMENTS):
        for free in range(min(exact, CHAIN - 1), CHAIN):
            key = F.lit(start * SEGMENTS + free).cast("long")
            for i in range(CHAIN):
                if i != free:
                    key = F.shiftleft(key, 8).bitwiseOR(segment(start + i))
            keys.append(key)
    return F.array(*keys)


def _chains(distance: int) -> list[list[tuple[np.uint64, int]]]:
    """Per start on the ring: the bits of the longest chain of each budget,
    with that budget.  Shorter chains of the same budget hold then, too."""
    budget = _budgets(distance)
    longest = [n for n in range(1, SEGMENTS + 1) if n == SEGMENTS or budget[n] > budget[n - 1]]
    bits = lambda start, n: sum(255 << 8 * ((start + i) % SEGMENTS) for i in range(n))
    return [[(np.uint64(bits(start, n)), budget[n - 1]) for n in longest] for start in range(SEGMENTS)]


def _linker(distance: int):
    chains = _chains(distance)

    def near(fps: np.ndarray, fp: np.uint64, start: int) -> np.ndarray:
        """Whether each fingerprint keeps within the budgets of the chains that
        begin at ``start``; the last one, the whole ring, is the full Hamming
        check and sees only what the shorter ones have left."""
        differ = fps ^ fp
        at = np.arange(len(fps))
        for mask, budget in chains[start]:
            at = at[np.bitwise_count(differ[at] & mask) <= budget]
        out = np.zeros(len(fps), bool)
        out[at] = True
        return out

    def bucket(fps: np.ndarray, start: int, a: list, b: list) -> None:
        """A spanning forest of a bucket's links: all of them are found, those
        between fingerprints already reached are not written again."""
        left = fps
        while len(left) > 1:
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                fp = reached.pop()
                hit = near(left, fp, start)
                if hit.any():
                    new = left[hit]
                    a.append(np.full(len(new), fp))
                    b.append(new)
                    reached.extend(new)
                    left = left[~hit]

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by (key, piece); a piece holds at most about 2 BLOCKs."""
        rest = None
        for part in batches:
            part = part if rest is None else pd.concat([rest, part], ignore_index=True)
            same = (part["key"].to_numpy()[1:] == part["key"].to_numpy()[:-1]) & (part["piece"].to_numpy()[1:] == part["piece"].to_numpy()[:-1])
            cut = np.flatnonzero(~same) + 1
            last = cut[-1] if len(cut) else 0
            yield from found(part.iloc[:last], cut[:-1])
            rest = part.iloc[last:]
        if rest is not None:
            yield from found(rest, np.array([], np.int64))

    def found(part: pd.DataFrame, cut: np.ndarray) -> Iterator[pd.DataFrame]:
        a: list = []
        b: list = []
        fps, keys = part["fp"].to_numpy().view(np.uint64), part["key"].to_numpy()
        for s, e in zip([0, *cut], [*cut, len(part)]):
            if e - s > 1:
                bucket(fps[s:e], int(keys[s] >> (8 * (CHAIN - 1))) // SEGMENTS, a, b)
        if a:
            yield pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    return link


def simhash_links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (one long column) at
    ``distance`` or fewer differing bits: every such pair is found, and enough
    of them are returned to connect the same fingerprints.

    Pigeonring: two fingerprints within the distance have a start on the ring
    of segments from which every chain of consecutive segments keeps within its
    proportional budget.  The chain's first CHAIN segments are the bucket key
    (32 bits, 24 keys a fingerprint for distance 3), the rest of the chain
    prunes a bucket's candidates, and the full Hamming check is its last step.
    Buckets of one fingerprint are dropped after a count; a bucket of more than
    BLOCK is cut into blocks whose pairs are dealt to different tasks.
    """
    (fp,) = fps.columns
    keyed = stage(fps.select(F.col(fp).alias("fp"), F.explode(_keys(fp, distance)).alias("key")), "simhash-keys")
    full = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    full = full.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = keyed.join(full, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = rows.withColumn("other", F.explode(other)).select(
        "fp", "key", (F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other")).alias("piece"))
    return rows.repartition("key", "piece").sortWithinPartitions("key", "piece").mapInPandas(_linker(distance), "a long, b long")


def _components_of(docs: DataFrame, text: str, doc_id: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """``docs`` with its fingerprints, written once; (fingerprint, root, smallest
    id of the component) of each distinct fingerprint; and those columns' names."""
    fp, comp, root = names = fresh(docs, "fp", "comp", "root")
    marked = stage(docs.withColumn(fp, fingerprint_column(shingle)(F.col(text))), "simhash")
    ids = marked.groupBy(F.col(fp).alias("node")).agg(F.min(doc_id).alias("low"))
    ids = stage(ids, "simhash-ids")
    roots = components(simhash_links(ids.select("node"), distance))
    named = ids.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias(root))
    lows = named.groupBy(root).agg(F.min("low").alias(comp))
    return marked, named.join(lows, root).select(F.col("node").alias(fp), root, comp), names


def simhash_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 3) -> DataFrame:
    """Every row of ``docs`` with ``fingerprint`` (16 lower-case hex digits),
    ``component_id`` (the smallest ``doc_id`` reachable over links) and
    ``component_fp`` (the component's smallest fingerprint, which names it also
    where ids are null).

    Null and empty texts have fingerprint zero and link like any other; texts
    are read whole, however long.  Rows that repeat share their component.  A
    null doc_id is a member like others but never the smallest; a component of
    such rows only has a null id.  Other columns stay; columns of the same names
    as the new ones are replaced.  An empty table gives an empty one.  Copies
    meet as one fingerprint, so no group of copies forms pairs.
    """
    docs = docs.drop("fingerprint", "component_id", "component_fp")
    marked, named, (fp, comp, root) = _components_of(docs, text, doc_id, shingle, distance)
    return marked.join(named, fp).select(*docs.columns, F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint"),
                                         F.col(comp).alias("component_id"), F.col(root).alias("component_fp"))


def first_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, by doc_id
    (null last) and text: ``one_of_each`` of ``simhash_dedup``.

    The first row of each fingerprint is taken before the components are
    joined, so a group of copies sends one row from each task, and whole
    documents meet only as one for a fingerprint.  Cases as in
    ``simhash_dedup``; equal rows leave one; all columns stay as they are.
    """
    marked, named, (fp, comp, root) = _components_of(docs, text, doc_id, shingle, distance)
    (place,) = fresh(marked, "place")
    order = [F.col(doc_id).asc_nulls_last(), F.xxhash64(text), text]

    def firsts(rows: DataFrame, group: str) -> DataFrame:
        return rows.withColumn(place, F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col(place) == 1)

    return firsts(firsts(marked, fp).join(named.select(fp, root), fp), root).select(*docs.columns)


def one_of_each(marked: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component of ``simhash_dedup``: the first by doc_id (null
    last) and text.  The limit of one row a component is applied before the
    shuffle, so a large group sends one row from each task."""
    (place,) = fresh(marked, "place")
    first = Window.partitionBy("component_fp").orderBy(F.col(doc_id).asc_nulls_last(), F.xxhash64(text), text)
    return marked.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(
        place, "fingerprint", "component_id", "component_fp")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component of every document (3-word shingles,
    links at 3 or fewer differing bits)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_dedup(docs).select("doc_id", "fingerprint", "component_id")
