"""Prefix trie of conversations, screened by count-min sketches (operator 12)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from devtrail.llm.common import table, words_of
from devtrail.session import stage

ROWS = 2_000_000  # of one range, about
MIN_WIDTH, MAX_WIDTH = 1 << 16, 1 << 27  # counters of a sketch row; its use takes a bit for each
PAGE = 1 << 16  # counters whose bits are put together in one task
PIECE = 4096  # conversation ids in a piece of text that is hashed
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = ["depth", "p1", "p2"]  # a prefix: its turns, and 128 bits of hash


def _ranges(df: DataFrame, rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS))


def _running(df: DataFrame, n: int, key: str, order: list[str], sums: dict[str, tuple[str, Column]], total: str, name: str) -> DataFrame:
    """``df`` with running aggregates of each key's rows, and their number in
    ``total``, for keys of any size: rows are range-partitioned by key and
    order, so a key with a third of them spreads over many ranges, and a range
    starts from what the key's ranges before it add up to.  ``sums`` gives a
    column's aggregate (``sum`` or ``bit_xor``) and its value; ``order`` must be
    total but for rows that may change places."""
    placed = stage(df.withColumns({f"_{c}": v for c, (_, v) in sums.items()}).repartitionByRange(n, key, *order).withColumn(
        "_p", F.spark_partition_id()), name)
    agg = {c: F.sum if how == "sum" else F.bit_xor for c, (how, _) in sums.items()}
    zero = F.lit(0).cast("long")
    starts = placed.groupBy("_p", key).agg(F.count("*").alias("_n"), *(f(f"_{c}").alias(f"_t{c}") for c, f in agg.items()))
    before = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_p", F.col(key).alias("_key"), F.sum("_n").over(Window.partitionBy(key)).alias(total),
                           *(F.coalesce(f(f"_t{c}").over(before), zero).alias(f"_s{c}") for c, f in agg.items()))
    inside = Window.partitionBy("_p", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumns({f"_{c}": f(f"_{c}").over(inside) for c, f in agg.items()})
    rows = rows.join(starts.withColumnRenamed("_p", "_q"), (F.col("_p") == F.col("_q")) & (F.col(key) == F.col("_key")))
    both = {c: F.col(f"_{c}") + F.col(f"_s{c}") if how == "sum" else F.col(f"_{c}").bitwiseXOR(F.col(f"_s{c}")) for c, (how, _) in sums.items()}
    return rows.select(*df.columns, *(v.alias(c) for c, v in both.items()), total)


def digest_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, k, h1, h2, words): per turn its place in the conversation, from
    1, hashes of role and text, and the words of the text.  Only these are
    shuffled, never a text.  Order: turn, null first; equal turns by hash.  Null
    roles and texts are empty; rows without a conversation take no part."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    slim = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(*said).alias("h1"),
        F.xxhash64(said[1], F.lit("turn"), said[0]).alias("h2"), words_of(said[1]).alias("words"), F.monotonically_increasing_id().alias("i"))
    slim = stage(slim, "trie-turns")
    order = ["turn", "h1", "h2", "i"]
    numbered = _running(slim, _ranges(slim, slim.count()), "conv_id", order, {"k": ("sum", F.lit(1).cast("long"))}, "turns", "trie-order")
    return stage(numbered.select("conv_id", "k", "h1", "h2", "words"), "trie-digests")


def _bitmap(cells: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(PAGE, np.uint8)
    bits[cells["cell"].to_numpy() % PAGE] = 1
    return pd.DataFrame({"page": [int(cells["cell"].iloc[0]) // PAGE], "bits": [np.packbits(bits).tobytes()]})


def sketch_width(rows: int) -> int:
    """Counters of a sketch row: eight for a prefix, within the bounds."""
    return min(MAX_WIDTH, max(MIN_WIDTH, 1 << (8 * rows).bit_length()))


def _cells(width: int, depth: Column, p1: Column, p2: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(r), p2, p1, depth), F.lit(width)) + F.lit(r * width) for r in (0, 1)]


def screen(rows: DataFrame, width: int) -> np.ndarray:
    """A bit for each counter of a count-min sketch (two rows of ``width``) of
    the prefixes: whether it is 2 or more.  A prefix whose estimate, the least
    of its counters, is one has a counter of one: it is proved a singleton.

    The counters are added up by shards, with partial sums; the bits, which are
    all that screening needs, have at most ``2 * MAX_WIDTH / 8`` bytes."""
    cells = rows.select(F.explode(F.array(*_cells(width, *map(F.col, NODE)))).alias("cell"))
    many = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell", F.floor(F.col("cell") / PAGE).alias("page"))
    bits = np.zeros(2 * width // 8, np.uint8)
    for r in many.groupBy("page").applyInPandas(_bitmap, "page long, bits binary").toLocalIterator():
        bits[r.page * PAGE // 8:(r.page + 1) * PAGE // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


def _flags(bits: np.ndarray, columns: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        many = lambda cell: (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1
        for b in batches:
            c = [b[x].to_numpy() for x in ("c0", "c1", "u0", "u1")]
            b["single"] = (many(c[0]) & many(c[1])) == 0
            b["up_single"] = ((many(c[2]) & many(c[3])) == 0) & (b["depth"] > 1)  # the root is not in the sketch
            yield b[[x.split()[0] for x in columns.split(", ")]]

    return run


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (node, conversation) as pieces of the text to be hashed."""
    for b in batches:
        node = b[NODE].to_numpy()
        cut = np.flatnonzero((node[1:] != node[:-1]).any(axis=1)) + 1
        out = []
        for part in np.split(np.arange(len(b)), cut):
            for i in range(0, len(part), PIECE):
                ids = b["conv_id"].to_numpy()[part[i:i + PIECE]]
                out.append((*node[part[i]], ids[0], ",".join(map(str, ids))))
        yield pd.DataFrame(out, columns=[*NODE, "first", "ids"])


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted pieces: one hash a node, carried over pieces and batches."""
    node = sha = None
    for b in batches:
        out = []
        for *at, ids in b[[*NODE, "ids"]].itertuples(index=False, name=None):
            if at == node:
                sha.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((*node, sha.hexdigest()))
            node, sha = at, hashlib.sha256(ids.encode())
        yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, sha.hexdigest())], columns=[*NODE, "ends_sha256"])


def end_hashes(ends: DataFrame, n: int) -> DataFrame:
    """Per node the hash of its ids in order.  Rows are sorted in ranges of
    (node, id), so the ids of a node that many share become pieces in many
    tasks; only the hash over the pieces, which has to be taken in order, is
    one task's, and streams."""
    kinds = "depth long, p1 long, p2 long"
    pieces = ends.repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInPandas(_pieces, f"{kinds}, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInPandas(_hashed, f"{kinds}, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie of all prefixes of conversations: conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256, as in the contract of the query.

    ``turns`` holds (conv_id, k, h1, h2, words) with places k from 1 without
    gaps, as ``digest_turns`` returns; ``members`` holds each conv_id once,
    those without a turn too.

    A prefix is told by its depth and 128 bits: the exclusive or of its turns'
    hashes, each mixed with its place, so running aggregates over ranges give
    all prefixes of a conversation of any length.  A sketch of them proves most
    singletons; the nodes they make are emitted where they are.  The others
    are grouped exactly, with partial sums.  Sums over a subtree need no walk
    over the tree: a node belongs to its smallest member, a conversation owns
    the end of its path from some depth on, and so each conversation adds to
    the leaves, children and words of the nodes on its path what it owns below
    them.  Nodes that many share meet in partial sums and in joins that
    Spark may split.

    No member: no node.  Repeated turns are turns of their own; a conversation
    whose id is null takes no part (``digest_turns``).
    """
    spark = turns.sparkSession
    many = turns.count()
    n = _ranges(turns, many)
    k = F.col("k")
    mixed = {"p1": F.xxhash64("h1", "h2", k, F.lit(1)), "p2": F.xxhash64(k, "h2", "h1", F.lit("2"))}
    path = _running(turns, n, "conv_id", ["k"], {"p1": ("bit_xor", mixed["p1"]), "p2": ("bit_xor", mixed["p2"]), "upto": ("sum", F.col("words"))},
                    "len", "trie-paths")
    path = path.select("conv_id", k.alias("depth"), "p1", "p2", F.col("p1").bitwiseXOR(mixed["p1"]).alias("u1"),
                       F.col("p2").bitwiseXOR(mixed["p2"]).alias("u2"), "words", (F.col("upto") - F.col("words")).alias("before"), "len")
    path = stage(path, "trie-prefixes")
    width = sketch_width(many)
    bits = screen(path, width)
    up = _cells(width, k.cast("long"), F.col("u1"), F.col("u2"))
    asked = path.withColumns({"k": F.col("depth") - 1} | dict(zip(("c0", "c1"), _cells(width, *map(F.col, NODE)))))
    asked = asked.withColumns(dict(zip(("u0", "u1"), up)))
    columns = "conv_id long, depth long, p1 long, p2 long, words long, before long, len long, single boolean, up_single boolean"
    rows = stage(asked.mapInPandas(_flags(bits, columns), columns), "trie-screened")
    alone, shared = rows.where("single"), rows.where("NOT single")

    # Exact groups of what may be shared: the smallest member owns a node.
    nodes = shared.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.max("len").alias("longest"))
    shared = stage(shared.join(nodes, NODE), "trie-shared")
    paths = shared.select("conv_id", "depth", "owner", "longest", "words", "before", "len").unionByName(
        alone.select("conv_id", "depth", F.col("conv_id").alias("owner"), F.col("len").alias("longest"), "words", "before", "len"))
    own = F.col("owner") == F.col("conv_id")
    convs = paths.groupBy("conv_id").agg(
        F.max("len").alias("len"), F.min(F.when(own, F.col("depth"))).alias("since"), F.min(F.when(own, F.col("before"))).alias("unowned"),
        F.max(F.col("before") + F.col("words")).alias("total"),
        F.max(F.when(own & (F.col("depth") == F.col("len")) & (F.col("longest") == F.col("len")), 1).otherwise(0)).alias("leaf"))
    convs = members.select("conv_id").join(convs, "conv_id", "left").select(
        "conv_id", F.coalesce("len", F.lit(0)).cast("long").alias("len"), F.coalesce("since", F.col("len") + 1, F.lit(1)).cast("long").alias("since"),
        F.coalesce("unowned", "total", F.lit(0)).cast("long").alias("unowned"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"))
    # The owner of the node above a conversation's first own one.
    above = shared.select(F.col("conv_id").alias("c"), (F.col("depth") + 1).alias("d"), F.col("owner").alias("above"))
    convs = stage(convs.join(above, (F.col("conv_id") == F.col("c")) & (F.col("since") == F.col("d")), "left").drop("c", "d"), "trie-conversations")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.when((F.col("len") > 0) & (F.col("since") == 1), 1).otherwise(0)).alias(
        "n_children"), F.sum("leaf").alias("leaves"), F.sum("unowned").alias("saved_tokens"), F.max("len").alias("longest")).first()
    if not top.n_convs:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                         "saved_tokens long, ends_sha256 string")
    parent = F.when(F.col("depth") == 1, F.lit(top.conv_id)).when(F.col("depth") == F.col("since"), F.col("above")).otherwise(F.col("conv_id"))
    facts = shared.select("conv_id", *NODE, "owner", "before").join(convs, "conv_id")
    below = (F.col("len") > F.col("depth")) & (F.col("since") <= F.col("depth") + 1)
    facts = facts.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max(F.when(own, parent)).alias("parent_conv_id"), F.count("*").alias("n_convs"),
        F.sum(F.when(below, 1).otherwise(0)).alias("n_children"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.lit(0), F.col("unowned") - F.col("before"))).alias("saved_tokens"))
    root = F.lit(0).cast("long")
    ends = shared.where("len = depth").select(*NODE, "conv_id").unionByName(
        convs.where("len = 0").select(root.alias("depth"), root.alias("p1"), root.alias("p2"), "conv_id"))
    hashes = end_hashes(ends, n)
    first = spark.range(1).select(
        root.alias("depth"), root.alias("p1"), root.alias("p2"), F.lit(top.conv_id).alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(top.n_convs).alias("n_convs"), F.lit(top.n_children).alias("n_children"),
        F.lit(top.leaves if top.longest else 1).cast("long").alias("n_leaves"), F.lit(top.saved_tokens).alias("saved_tokens"))
    grouped = facts.unionByName(first).join(hashes, NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    # Nodes under a proved singleton know their parent; the first of a path asks its conversation.
    begin = alone.where("NOT up_single").join(convs.select("conv_id", "since", "above"), "conv_id").withColumn("parent_conv_id", parent)
    tails = alone.where("up_single").withColumn("parent_conv_id", F.col("conv_id")).unionByName(begin.drop("since", "above"))
    one, last = F.lit(1).cast("long"), F.col("len") == F.col("depth")
    tails = tails.select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        root.alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"))
    return grouped.select(*tails.columns).unionByName(tails)


def conversation_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``prefix_trie`` of a table of turns.  Nulls: see ``digest_turns``; very
    long texts are hashed whole; other columns are not read; an empty table
    has no node."""
    digests = digest_turns(turns, conv_id, turn, role, text)
    return prefix_trie(digests, digests.select("conv_id").distinct())


EVERY, PARTS = 20, 4


def rebuilt(digests: DataFrame) -> DataFrame:
    """The query's conversations: the first turns of conversation c - c % 20,
    as many as the hash of c says, then c's own turns after as many."""
    members = digests.select("conv_id").distinct()
    members = members.withColumns({"h": F.crc32(F.col("conv_id").cast("string")) % PARTS, "base": F.col("conv_id") - F.col("conv_id") % EVERY})
    heads = digests.where(f"k < {PARTS} AND conv_id % {EVERY} = 0").withColumnRenamed("conv_id", "base")
    lent = members.join(heads, "base").where("k <= h").select("conv_id", "h", "k", "h1", "h2", "words")
    got = lent.groupBy("conv_id").agg(F.count("*").alias("got"))
    own = digests.join(members.select("conv_id", "h").join(got, "conv_id", "left"), "conv_id").where("k > h")
    own = own.withColumn("k", F.col("k") - F.col("h") + F.coalesce("got", F.lit(0)))
    return lent.select(*digests.columns).unionByName(own.select(*digests.columns))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = digest_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie(stage(rebuilt(digests), "trie-rebuilt"), digests.select("conv_id").distinct())


_CRC = "list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), " \
       "lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
OP12_SQL = f"""
WITH m AS (SELECT DISTINCT conv_id, xor({_CRC}, 4294967295) % {PARTS} AS h FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT m.conv_id, 0 AS own, k, role, text FROM m JOIN t ON t.conv_id = m.conv_id - m.conv_id % {EVERY} AND k <= h
  UNION ALL SELECT conv_id, 1, k, role, text FROM m JOIN t USING (conv_id) WHERE k > h),
p AS (SELECT conv_id, row_number() OVER w AS depth, list(struct_pack(role := role, text := text)) OVER (w ROWS UNBOUNDED PRECEDING) AS turns,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words, count(*) OVER (PARTITION BY conv_id) AS n
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, k)),
a AS (SELECT conv_id, depth, md5(CAST(turns AS VARCHAR)) AS key, md5(CAST(turns[:-2] AS VARCHAR)) AS up, words, depth = n AS last FROM p
  UNION ALL SELECT conv_id, 0, md5('[]'), NULL, 0, conv_id NOT IN (SELECT conv_id FROM r) FROM m),
v AS (SELECT depth, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM a GROUP BY depth, key),
u AS (SELECT v.*, (SELECT count(*) FROM v AS c WHERE c.depth = v.depth + 1 AND c.up = v.key) AS n_children FROM v),
s AS (SELECT a.depth, a.key, sum((u.n_convs - 1) * u.words) AS saved_tokens, count(*) FILTER (u.n_children = 0) AS n_leaves
  FROM u JOIN a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.depth, a.key)
SELECT u.conv_id, u.depth, b.conv_id AS parent_conv_id, u.n_convs, u.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
FROM u JOIN s USING (depth, key) LEFT JOIN v AS b ON b.depth = u.depth - 1 AND b.key = u.up
"""
