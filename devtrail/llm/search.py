"""Ranked lexical search over bit-sliced Bloom signatures (operator 13)."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devtrail.llm.common import table
from devtrail.operators.joins import sized_broadcast
from devtrail.session import stage

K = 20
BLOCK_TERMS = 65_536  # distinct terms, about, of the queries that are searched at a time
BITS, HASHES = 12, 6  # bits of a signature for a key, at least, and those that a key sets
MAX_BITS = 1 << 21  # of a signature: longer texts have fuller ones, whose bounds are looser but right
CELLS = 1 << 23  # bits of the document rows of one block of signatures
LEVELS = 8  # a term's keys: it occurs 1, 2, 4, ... 128 times or more
SCREEN = 1 << 24  # bits of the screen that tells terms that may be asked
MAX_ROWS, MAX_BYTES = 1_000_000, 64 << 20  # of candidates that are broadcast; beyond it they are joined by a shuffle
SEED = 42  # of XXH64, as Spark's own hash of a binary

SIGNATURES = "bits long, docs array<long>, keys array<long>, n array<long>, slices binary, terms array<binary>, dfs array<long>"


def _separators() -> bytes:
    """Per byte what it becomes: ASCII letters in lower case, digits and all
    bytes of other characters as they are, a space for the rest."""
    keep = lambda b: b >= 128 or bytes([b]).isalnum()
    return bytes(b if keep(b) else 32 for b in range(256)).lower()


def _terms_of(text: bytes, table_: bytes) -> list[bytes]:
    return text.translate(table_).split()


def positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The bits (keys x HASHES) that terms of these hashes set at a level."""
    h = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    first, step = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    at = first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (at & np.uint64(bits - 1)).astype(np.int64)


def _count_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = _separators()
    for b in batches:
        counts = [Counter(_terms_of(t or b"", split)) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([
            b.column("id"), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
            pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], ["id", "terms", "counts"])


class _Block:
    """Signatures of up to ``CELLS / bits`` documents, a byte for a bit."""

    def __init__(self, bits: int):
        self.bits, self.room = bits, max(8, CELLS // bits)
        self.cells = np.zeros((bits, self.room), np.uint8)
        self.docs: list = []

    def add(self, doc: tuple, at: np.ndarray) -> None:
        self.cells[at, len(self.docs)] = 1
        self.docs.append(doc)

    def row(self) -> pa.RecordBatch:
        used = -(-len(self.docs) // 8) * 8
        slices = np.packbits(self.cells[:, :used], axis=1).tobytes()
        ids, keys, n = (list(x) for x in zip(*self.docs))
        self.cells[:, :used], self.docs = 0, []
        return _row(self.bits, ids, keys, n, slices, None, None)


def _row(*values) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    kinds = (pa.int64(), longs, longs, longs, pa.binary(), pa.list_(pa.binary()), longs)
    names = ("bits", "docs", "keys", "n", "slices", "terms", "dfs")
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], list(names))


def _signatures(screen: bytes):
    """Blocks of signatures, and the number of documents of each term that the
    screen lets through.  Documents are put together by the size of their
    signature, so a block's slices are rows of documents of like length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, asked = _separators(), np.unpackbits(np.frombuffer(screen, np.uint8), bitorder="little").view(bool)
        blocks: dict[int, _Block] = {}
        dfs: Counter = Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            found = list(dfs.items())
            dfs.clear()
            for i in range(0, len(found), 10_000):
                terms, n = zip(*found[i:i + 10_000])
                yield _row(None, None, None, None, None, list(terms), list(n))

        for b in batches:
            for doc, key, text in zip(b.column("doc").to_pylist(), b.column("key").to_pylist(), b.column("text")):
                words = _terms_of(text.as_py() or b"", split)
                if not words:
                    continue
                count = Counter(words)
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, count, repeat(SEED)), np.uint64, len(count))
                hit = np.flatnonzero(asked[(hashes & np.uint64(SCREEN - 1)).astype(np.int64)])
                if len(hit):
                    terms = list(count)
                    dfs.update([terms[i] for i in hit])
                tf = np.fromiter(count.values(), np.int64, len(count))
                levels = [hashes, *(hashes[tf >= 1 << j] for j in range(1, LEVELS))]
                bits = min(MAX_BITS, max(64, 1 << (BITS * sum(map(len, levels)) - 1).bit_length()))
                if bits not in blocks:
                    blocks[bits] = _Block(bits)
                at = np.concatenate([positions(h, j, bits).ravel() for j, h in enumerate(levels) if len(h)])
                blocks[bits].add((doc, key, len(words)), at)
                if len(blocks[bits].docs) == blocks[bits].room:
                    yield blocks[bits].row()
            if len(dfs) > 200_000:
                yield from counted()
        for block in blocks.values():
            if block.docs:
                yield block.row()
        yield from counted()

    return run


class Queries:
    """A block of queries: their distinct terms with hashes and weights, and
    for each query the places of its terms there and its repeats of them."""

    def __init__(self, asked: list[tuple[int, list[bytes], list[int]]], dfs: dict[bytes, int], n_docs: int, n_terms: int):
        self.ids = [q for q, _, _ in asked]
        weight = lambda df: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        self.terms = sorted({t for _, terms, _ in asked for t in terms if weight(dfs.get(t, 0)) > 0 and t in dfs})
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.weights = [weight(dfs[t]) for t in self.terms]
        self.hashes = np.array([xxhash.xxh64_intdigest(t, SEED) for t in self.terms], np.uint64)
        self.of = [[(self.place[t], c) for t, c in zip(terms, counts) if t in self.place] for _, terms, counts in asked]
        self.n_docs, self.n_terms = n_docs, n_terms

    def measure(self, n: int) -> int:
        """m of a document of n terms."""
        return 100 - 25 + (25 * n * self.n_docs) // self.n_terms


def upper_bounds(q: Queries, bits: int, n: np.ndarray, slices: bytes) -> np.ndarray:
    """Upper bounds (queries x documents) of all scores of a block.

    The slices of a term's keys, met, overestimate the documents that hold it
    so many times; level by level their weighted sums, times the most that the
    level can add to a score, add up to the bound."""
    held = np.frombuffer(slices, np.uint8).reshape(bits, -1)
    docs = len(n)
    m = np.array([q.measure(int(x)) for x in n], np.float64)
    most = [np.minimum(n, (2 << j) - 1) if j < LEVELS - 1 else n for j in range(LEVELS)]
    adds = np.diff(np.array([np.zeros(docs), *(1e9 * tf / (1000 * tf + 12 * m) for tf in most)]), axis=0).astype(np.float32)
    out = np.zeros((len(q.ids), docs), np.float32)
    weights = np.array(q.weights, np.float32)
    live = np.arange(len(q.terms))
    for level in range(LEVELS):
        if not len(live):
            break
        rows = np.full(len(q.terms), -1)
        bands = []
        for part in np.array_split(live, max(1, len(live) // 4096)):
            at = positions(q.hashes[part], level, bits)
            met = reduce(np.bitwise_and, (held[at[:, i]] for i in range(HASHES)))
            some = met.any(axis=1)
            rows[part[some]] = np.arange(some.sum()) + sum(map(len, bands))
            bands.append(met[some])
        met = np.concatenate(bands)
        live = np.flatnonzero(rows >= 0)
        if not len(live):
            break
        present = np.unpackbits(met, axis=1, count=docs)
        for i, terms in enumerate(q.of):
            if of := [(rows[t], c * weights[t]) for t, c in terms if rows[t] >= 0]:
                at, by = zip(*of)
                out[i] += adds[level] * (np.array(by, np.float32) @ present[list(at)].astype(np.float32))
    return out


def _bounds(q: Queries, keep):
    """Per block what ``keep(bounds)`` picks: (queries' places, documents' places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                bits, docs, keys, n, slices = (b.column(c)[r].as_py() for c in ("bits", "docs", "keys", "n", "slices"))
                bounds = upper_bounds(q, bits, np.array(n), slices)
                at, doc = keep(bounds)
                order = np.argsort(doc, kind="stable")
                at, doc = at[order].astype(np.int32), doc[order]
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else doc
                held = np.split(at, first[1:])
                yield pa.RecordBatch.from_arrays([
                    pa.array([docs[d] for d in doc[first]], pa.int64()), pa.array([keys[d] for d in doc[first]], pa.int64()),
                    pa.array([x.tobytes() for x in held[:len(first)]], pa.binary()),
                    pa.array([bounds[x, d].astype(np.float32).tobytes() for x, d in zip(held, doc[first])], pa.binary())], ["doc", "key", "asked", "bounds"])

    return run


def _highest(k: int):
    def keep(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = min(k, bounds.shape[1])
        doc = np.argpartition(-bounds, top - 1, axis=1)[:, :top]
        at = np.repeat(np.arange(len(bounds)), top)
        some = bounds[at, doc.ravel()] > 0
        return at[some], doc.ravel()[some]

    return keep


def _reaching(floors: np.ndarray):
    """Documents whose bound is not provably under the floor of a query; the
    margin covers the rounding of 32-bit sums."""
    def keep(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero((bounds > 0) & (bounds * (1 + 1e-4) + 1 >= floors[:, None]))

    return keep


def exact_scores(q: Queries, text: bytes, asked: np.ndarray, split: bytes) -> list[int]:
    """The contract's scores of a whole text for the queries at these places."""
    words = _terms_of(text, split)
    m = q.measure(len(words))
    held = Counter(t for t in words if t in q.place)
    part = {q.place[t]: q.weights[q.place[t]] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m)) for t, tf in held.items()}
    return [sum(c * part[t] for t, c in q.of[i] if t in part) for i in asked]


def _rescore(q: Queries, k: int):
    """The k best of each query among a task's rows, by exact scores."""

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["query", "score", "doc"], ascending=[True, False, True], na_position="last", kind="stable")
        return rows.groupby("query").head(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _separators()
        held = pd.DataFrame({"query": pd.Series(dtype="int64"), "doc": pd.Series(dtype="Int64"), "score": pd.Series(dtype="int64")})
        at, docs, scores = [], [], []

        def merged() -> pd.DataFrame:
            new = pd.DataFrame({"query": pd.Series(at, dtype="int64"), "doc": pd.Series(docs, dtype="Int64"), "score": pd.Series(scores, dtype="int64")})
            out = best(pd.concat([held, new[new["score"] > 0]]))
            for x in (at, docs, scores):
                x.clear()
            return out

        for b in batches:
            for doc, asked, text in zip(b.column("doc").to_pylist(), b.column("asked").to_pylist(), b.column("text")):
                places = np.frombuffer(asked, np.int32)
                at += [q.ids[i] for i in places]
                docs += [doc] * len(places)
                scores += exact_scores(q, text.as_py() or b"", places, split)
                if len(at) > 200_000:
                    held = merged()
        held = merged()
        yield pa.RecordBatch.from_pandas(held, pa.schema([("query", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())]), preserve_index=False)

    return run


def _rescored(docs: DataFrame, found: DataFrame, q: Queries, k: int) -> DataFrame:
    """Exact scores of the documents in ``found`` (doc, key, asked): their
    texts are read again by id and hash; broadcast only if ``found`` is small."""
    found = sized_broadcast(found.dropDuplicates(["doc", "key"]).select(F.col("doc").alias("d"), F.col("key").alias("h"), "asked"), MAX_ROWS, MAX_BYTES)
    texts = docs.join(found, F.col("doc").eqNullSafe(F.col("d")) & (F.col("key") == F.col("h")))
    rows = texts.select("doc", "asked", "text").mapInArrow(_rescore(q, k), "query long, doc long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(docs: DataFrame, signed: DataFrame, q: Queries, k: int) -> DataFrame:
    """First the highest bounds are scored exactly: the k-th score is a floor.
    Then all documents whose bound reaches it are."""
    found = "doc long, key long, asked binary, bounds binary"
    rows = signed.where("bits IS NOT NULL")
    high = stage(rows.mapInArrow(_bounds(q, _highest(k)), found), "search-high")

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = [np.frombuffer(x, np.int32) for x in b["asked"]]
            many = list(map(len, at))
            yield pd.DataFrame({"doc": b["doc"].astype("Int64").repeat(many).reset_index(drop=True), "key": b["key"].repeat(many).reset_index(drop=True),
                                "at": np.concatenate([*at, np.zeros(0, np.int32)]),
                                "bound": np.concatenate([*(np.frombuffer(x, np.float32) for x in b["bounds"]), np.zeros(0, np.float32)])})

    single = high.mapInPandas(pairs, "doc long, key long, at int, bound float")
    order = Window.partitionBy("at").orderBy(F.desc("bound"), F.asc_nulls_last("doc"), "key")
    first = single.withColumn("r", F.row_number().over(order)).where(F.col("r") <= 2 * k)
    first = first.groupBy("doc", "key").agg(F.sort_array(F.collect_set("at")).alias("at"))  # at most a block's queries

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"].astype("Int64"), "key": b["key"], "asked": [np.array(x, np.int32).tobytes() for x in b["at"]]})

    first = first.mapInPandas(packed, "doc long, key long, asked binary")
    floors = dict(_rescored(docs, first, q, k).groupBy("query").agg(F.min(F.when(F.col("rank") == k, F.col("score")))).collect())
    floors = np.array([floors.get(i) or 1 for i in q.ids], np.float64)
    reach = rows.mapInArrow(_bounds(q, _reaching(floors)), found).select("doc", "key", "asked")
    return _rescored(docs, reach, q, k).select("query", "rank", "doc", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", query_id: str = "item_id",
                  query_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(query id, rank from 1, document id, score) of the ``k`` highest-scoring
    documents with a score above 0 for each query (fewer if there are fewer).

    One pass over all documents writes their Bloom signatures, sliced by bit:
    a slice is the bitmap of a block's documents that have the bit, and
    documents of like length share blocks, as the signature grows with the
    text.  A key is a term that occurs 1, 2, 4, ... times or more.  The same
    pass counts the documents of the terms that are asked.  Queries are asked
    in blocks of about ``block_terms`` distinct terms, which go to the tasks;
    a query of more terms is a block of its own.  Weighted sums of slices bound
    every document's score from above; whatever is not provably under the k-th
    exact score found so far is read again and scored exactly, in integers.

    Null and empty texts have no terms and never score; very long texts have
    looser bounds beyond ``MAX_BITS``; equal scores go by ascending id, null
    ids last; repeated rows are documents, and queries, of their own; an empty
    table on either side gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    asked = queries.select(F.col(query_id).alias("name"), F.col(query_text).cast("binary").alias("text"), F.monotonically_increasing_id().alias("id"))
    asked = stage(asked, "search-asked")
    counted = stage(asked.select("id", "text").mapInArrow(_count_queries, "id long, terms array<binary>, counts array<long>"), "search-terms")
    terms = counted.select(F.explode("terms").alias("term"))
    cell = F.pmod(F.xxhash64("term"), F.lit(SCREEN))
    words = terms.select((cell / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int")).alias("b"))
    screen = np.zeros(SCREEN // 64, np.uint64)
    for w, b in words.groupBy("w").agg(F.bit_or("b")).collect():  # at most SCREEN / 64 words
        screen[w] = b & (2**64 - 1)
    signed = stage(rows.mapInArrow(_signatures(screen.tobytes()), SIGNATURES), "search-signatures")
    n = F.explode("n").alias("n")
    n_docs, n_terms = signed.where("bits IS NOT NULL").select(n).agg(F.count("*"), F.sum("n")).first()
    dfs = signed.where("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "dfs")).alias("x"))
    dfs = dfs.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.dfs").alias("df"))
    total = terms.agg(F.count("*")).first()[0]
    blocks = max(1, math.ceil(total / block_terms))
    counted = counted.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    dfs = stage(dfs.join(terms.distinct(), "term"), "search-counts")
    out = None
    for block in range(blocks if n_docs else 0):
        mine = counted.where(F.col("block") == block)
        held = mine.select(F.explode("terms").alias("term")).distinct().join(dfs, "term").collect()
        q = Queries([tuple(r) for r in mine.select("id", "terms", "counts").collect()], {bytes(t): d for t, d in held}, n_docs, n_terms)
        if q.terms:
            got = _search(rows, signed, q, k)
            out = got if out is None else out.unionByName(got)
    if out is None:
        out = spark.createDataFrame([], "query long, rank int, doc long, score long")
    names = asked.select(F.col("id").alias("query"), F.col("name"))
    return out.join(names, "query").select(F.col("name").alias(query_id), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = "regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
OP13_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS.format(t="coalesce(text, '')")} AS terms FROM documents),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l FROM d),
c AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM c GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, big_n),
q AS (SELECT item_id, term, count(*) AS many FROM (SELECT item_id, unnest({_TERMS.format(t="coalesce(text, '')")}) AS term FROM benchmark) GROUP BY ALL),
r AS (SELECT q.item_id, tf.doc_id, CAST(sum(many * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= {K}
"""
