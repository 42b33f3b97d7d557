"""Lexical retrieval packing with a sharded BM25 index (operator 1)."""

from __future__ import annotations

import math
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

from devtrail.llm.common import table, worker_cache
from devtrail.session import stage

WINDOW = 2048  # tokens of a sequence
SHARD = 1024  # documents of one BM25 index
K1, B = 1.2, 0.75
END = 1  # id after each document
SAMPLE = 2048  # texts, about, by which documents are routed to each other
PIVOTS = 512  # of them that are the places to be routed to
SAMPLE_CHARS = 32_768  # of such a text, at most
DENSE_BYTES = 64 << 20  # of an index's weights as a table, at most
CACHED_BYTES = 56 << 20  # of one generation of words with their ids, about
CACHED_CHARS = 64  # of a stretch that is kept
WORD_BYTES = 200  # of a kept word besides its text and ids
MERGED = 4096  # new words that one call merges
SHARD_TOKENS = 4_000_000  # tokens after which a shard is closed
TASK_TOKENS = 6_000_000  # tokens of a task's range, about
TOGETHER = 256  # documents whose tokens are sorted together
TEXT_BYTES = 4 << 20  # of texts whose words are looked up together
# Below U+0250 letters are single code points in normal form and in lower case, but for U+0130.
NOT_LATIN = re.compile("[^\\x00-\\u012f\\u0131-\\u024f]")
NOT_LATIN_RE2 = r"[^\x00-\x{12f}\x{131}-\x{24f}]"
PUNCTUATED = r"([a-z0-9\x{df}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}])([!-&(-/:-@\[-`{-~]+)\z"

MADE = "doc_id long, ids binary, n long, route long, near long"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class _Words(dict):
    """Ids of stretches without white space.  Two generations of at most
    CACHED_BYTES each are kept: when the newer is full it becomes the older, so
    frequent words stay.  Long stretches are not kept at all."""

    def __init__(self):
        super().__init__()
        self.old, self.size = {}, 0

    def keep(self, words: dict[str, bytes]) -> None:
        size = WORD_BYTES * len(words) + sum(map(len, words)) + sum(map(len, words.values()))
        if self.size + size <= CACHED_BYTES and max(map(len, words), default=0) <= CACHED_CHARS:
            self.update(words)
            self.size += size
            return
        for word, ids in words.items():
            if len(word) <= CACHED_CHARS:
                size = WORD_BYTES + len(word) + len(ids)
                if self.size + size > CACHED_BYTES:
                    self.old, self.size = dict(self), 0
                    self.clear()
                self[word] = ids
                self.size += size


def _gather(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``flat`` that end at ``ends`` (the first is a 0), taken in
    the order ``at``, and their ends."""
    size = np.diff(ends)[at]
    new = np.append(0, np.cumsum(size))
    index = np.repeat(ends[at] - new[:-1], size)
    index += np.arange(len(index))
    return flat[index], new


def _offsets(lists: pa.ListArray) -> np.ndarray:
    return np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))


class _Encoder:
    """texts -> ids as little-endian unsigned 16-bit bytes, equal to the
    tokenizer's own ids of the whole text.

    The tokenizer drops white space and no token spans it, so texts are split at
    white space and each distinct stretch of a few texts is looked up once.
    Stretches of Latin letters are set in lower case first, and the ASCII
    punctuation at their end is split off: it is a piece of its own to the
    tokenizer.  Ids are kept for reuse (``_Words``).  New words of letters alone
    are one piece each: the tokenizer's model merges many of them in one call,
    and the tokens that end a word tell them apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(1 << 16, bool)  # tokens that end a word
        self.last[[i for t, i in self.model.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = str.maketrans({c: letters(c)[0][0] for c in map(chr, range(0x80, 0x250)) if c.isalpha()})
        self.words = _Words()
        # Whether the shortcuts below hold for this tokenizer, by trial.
        trial = ["Über", "naïve", "WORD", "façade,", "ſo.", "it's.", "øre"]
        self.latin = bool(suffix)
        self.latin = self.latin and self.encode(trial) == self.ids(trial)
        self.words = _Words()

    def ids(self, texts: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters in lower case.  Each is one piece to the
        tokenizer, equal to its normal form, so that only its merges are left."""
        text = " ".join([w if w.isascii() else w.translate(self.letters) for w in words])
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
        ends = (2 * np.flatnonzero(self.last[ids]) + 2).tolist()
        if len(ends) != len(words):
            return self.ids(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def find(self, words: list[str]) -> dict[str, bytes]:
        """Ids of stretches that are in neither generation, or only in the older."""
        out, letters, rest = {}, [], []
        for w, ids in zip(words, map(self.words.old.get, words)):
            if ids is not None:
                out[w] = ids
            elif self.latin and w.isalpha() and (w.isascii() or not NOT_LATIN.search(w)):
                letters.append(w)
            else:
                rest.append(w)
        for k in range(0, len(letters), MERGED):
            some = letters[k:k + MERGED]
            out.update(zip(some, self.merged([w.lower() for w in some])))
        if rest:
            out.update(zip(rest, self.ids(rest)))
        self.words.keep(out)
        return out

    def parts(self, stretches: pa.Array) -> pa.ListArray:
        """Each stretch as a list of one or two that give the same ids."""
        if self.latin:
            plain = pc.invert(pc.match_substring_regex(stretches, "<[|]|" + NOT_LATIN_RE2))
            short = pc.replace_substring_regex(pc.ascii_lower(stretches), PUNCTUATED, r"\1 \2")
            stretches = pc.if_else(plain, short, stretches)
        return pc.ascii_split_whitespace(stretches)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        stretches = pc.ascii_split_whitespace(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        distinct = stretches.flatten().dictionary_encode()
        parts = self.parts(distinct.dictionary)
        pieces = parts.flatten().dictionary_encode()
        words = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [*map(self.words.get, words)]
        found = self.find([w for w, ids in zip(words, known) if ids is None])
        known = [found[w] if ids is None else ids for w, ids in zip(words, known)]
        # Ids of the distinct pieces, then of the distinct stretches, then of the texts.
        ends = np.append(0, np.cumsum(np.fromiter(map(len, known), np.int64, len(known)) >> 1))
        flat, ends = _gather(np.frombuffer(b"".join(known), "<u2"), ends, pieces.indices.to_numpy())
        flat, ends = _gather(flat, ends[_offsets(parts)], distinct.indices.to_numpy())
        raw, ends = flat.tobytes(), (2 * ends[_offsets(stretches)]).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


def _encoder(path: str) -> _Encoder:
    state = worker_cache(f"tokens:{path}")
    if not state:
        state["encoder"] = _Encoder(path)
    return state["encoder"]


def _few(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about TEXT_BYTES of text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        most = TEXT_BYTES + (int(ends[first - 1]) if first else 0)
        last = max(first + 1, int(np.searchsorted(ends, most, "right")))
        last = min(last, first + (1 << 14))
        yield batch.slice(first, last - first)
        first = last


def _tokenize(path: str, router: _Index | None = None):
    """doc_id, ``ids`` (the text's token ids and END, as little-endian unsigned
    16-bit bytes), ``n``, ``route`` (the document's three best pivots in order)
    and ``near``, the smallest hash of three tokens in a row: equal for texts
    that share most of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path), END.to_bytes(2, "little")
        for b in batches:
            for part in _few(b):
                ids, near = [], []
                for raw in encoder.encode(pc.fill_null(part.column("text"), "")):
                    ids.append(raw + end)
                    x = np.frombuffer(ids[-1], "<u2").astype(np.uint64)
                    h = (x[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ x[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ x[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
                    near.append(int(h.min() >> np.uint64(1)) if len(h) else 0)
                n = pa.array([len(x) // 2 for x in ids], pa.int64())
                route = router.routes([np.frombuffer(x, "<u2") for x in ids]) if router else np.zeros(len(ids), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), n, pa.array(route, pa.int64()), pa.array(near, pa.int64())], ["doc_id", "ids", "n", "route", "near"])

    return run


def _distinct(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, token and count of the distinct tokens of each of a few
    documents, by owner and token: one sort for all of them."""
    owner = np.repeat(np.arange(len(docs), dtype=np.uint32), [len(x) for x in docs])
    key = np.sort(owner << np.uint32(16) | np.concatenate(docs))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint32(16)).astype(np.int32), (key & np.uint32(0xFFFF)).astype(np.int64), count


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's documents per token: at most one row for each token."""
    worker_cache("packing")  # the words are no longer needed
    counts = np.zeros(1 << 16, np.int64)
    for b in batches:
        for part in (b.slice(k, TOGETHER) for k in range(0, b.num_rows, TOGETHER)):
            counts += np.bincount(_distinct([np.frombuffer(x.as_buffer(), "<u2") for x in part.column("ids")])[1], minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["token", "n"])


class _Index:
    """BM25 postings of one shard's documents."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        doc, term, tf = _distinct(ids)
        telling = idf[term] > 0
        doc, term, tf = doc[telling], term[telling], tf[telling]
        self.terms = np.split(term, np.searchsorted(doc, np.arange(1, len(ids))))
        length = np.array([len(x) for x in ids], float)[doc]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        order = np.argsort(term.astype(np.uint16), kind="stable")
        self.doc, self.weight = doc[order].astype(np.intp), weight[order]
        self.at = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.count = np.arange(len(term))
        self.n = len(ids)
        self.rows: np.ndarray | None = None

    def routes(self, docs: list[np.ndarray]) -> np.ndarray:
        """Per document its three best documents of the index, as one number
        that sorts by the best, then the second, then the third; the largest
        number for one without any."""
        owner, token, _ = _distinct(docs)
        held = np.flatnonzero(np.diff(self.at))
        if len(held) * self.n * 8 <= DENSE_BYTES and self.rows is None:
            # A row of weights for each token is summed faster than its postings.
            self.rows = np.zeros((len(held), self.n))
            self.rows[np.repeat(np.arange(len(held)), np.diff(self.at)[held]), self.doc] = self.weight
            self.row = np.full(len(self.at) - 1, -1)
            self.row[held] = np.arange(len(held))
        out = []
        for terms in np.split(token, np.searchsorted(owner, np.arange(1, len(docs)))):
            if self.rows is None:
                score = self.scores(terms)
            else:
                row = self.row[terms]
                score = self.rows.take(row[row >= 0], axis=0).sum(axis=0)
            route = 0
            for k in range(3):
                place = int(score.argmax())
                route = route * (self.n + 1) + (place if score[place] > 0 else self.n)
                if k + 1 < self.n:
                    score[place] = -1.0
            out.append(route)
        return np.array(out, np.int64)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        begin, size = self.at[terms], self.at[terms + 1] - self.at[terms]
        total = int(size.sum())
        at = np.repeat(begin - (np.cumsum(size) - size), size)
        at += self.count[:total]
        return np.bincount(self.doc[at], self.weight[at], self.n)

    def keep(self, free: np.ndarray) -> None:
        """Drop the postings of documents that are not ``free``."""
        kept = free[self.doc]
        self.doc, self.weight = self.doc[kept], self.weight[kept]
        self.at = np.concatenate([[0], np.cumsum(kept)])[self.at]


def _packer(idf: np.ndarray, mean: float, window: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("packing")  # the words are no longer needed
        first = TaskContext.get().partitionId() << 32
        sequence, filled = 0, 0
        seed: np.ndarray | None = None  # terms of the document that opened the window
        out: list[tuple] = []

        def place(doc_id, raw: bytes) -> bool:
            """Append a document, cut at window ends; whether a window ended."""
            nonlocal sequence, filled
            n, at, ended = len(raw) // 2, 0, False
            while at < n:
                take = min(window - filled, n - at)
                out.append((doc_id, at, take, n, first + sequence, filled, raw[2 * at: 2 * (at + take)]))
                at, filled = at + take, filled + take
                if filled == window:
                    sequence, filled, ended = sequence + 1, 0, True
            return ended

        def pack(docs: list[tuple]) -> None:
            nonlocal seed
            ids = [np.frombuffer(raw, "<u2") for _, raw in docs]
            index = _Index(ids, idf, mean)
            free, turn, scores, left, last = np.ones(len(docs), bool), 0, None, len(docs), len(docs)
            for _ in docs:
                while not free[turn]:
                    turn += 1
                best = turn
                if filled and seed is not None:
                    if scores is None:
                        scores = index.scores(seed)
                    k = int(np.argmax(np.where(free, scores, -1.0)))
                    best = k if scores[k] > 0 else turn
                fresh = not filled
                free[best] = False
                left -= 1
                if 4 * left < 3 * last:  # a query then reads no postings of used documents
                    index.keep(free)
                    last = left
                if place(*docs[best]) or fresh:
                    seed, scores = index.terms[best], None

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                out[:] = [(*p[:6], np.frombuffer(p[6], "<u2").astype("<u4").tobytes()) for p in out]
                names = [f.split()[0] for f in PIECES.split(", ")]
                kinds = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out.clear()

        waiting: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                waiting.append(row)
                size += len(row[1]) // 2
                if len(waiting) == shard or size >= SHARD_TOKENS:
                    # The last window stays open for the next shard.
                    pack(waiting)
                    waiting, size = [], 0
                    held = [p for p in out if p[4] == first + sequence]
                    del out[len(out) - len(held):]
                    yield from flush()
                    out.extend(held)
        if waiting:
            pack(waiting)
        if filled and (tail := [p for p in out if p[4] == first + sequence]):
            # A partition's last window is cut at powers of two, which need no padding.
            del out[len(out) - len(tail):]
            sizes = [1 << k for k in range(filled.bit_length() - 1, -1, -1) if filled >> k & 1]
            room, filled = sizes.pop(0), 0
            for doc_id, start, length, n, _, _, raw in tail:
                at = 0
                while at < length:
                    take = min(room - filled, length - at)
                    out.append((doc_id, start + at, take, n, first + sequence, filled, raw[2 * at: 2 * (at + take)]))
                    at, filled = at + take, filled + take
                    if filled == room:
                        sequence, filled = sequence + 1, 0
                        room = sizes.pop(0) if sizes else window
        yield from flush()

    return run


def _router(docs: DataFrame, path: str, shard: int) -> _Index | None:
    """A BM25 index of PIVOTS documents out of a sample of about SAMPLE, by the
    hash of their texts, so copies count once; its token frequencies are the
    sample's.  None if all documents fit one shard."""
    n = docs.count()
    if n <= shard:
        return None
    share = min(1.0, SAMPLE / n)
    key = F.xxhash64("text", F.lit("pivot"))
    held = docs.where(F.pmod(key, F.lit(1 << 30)) < int(share * (1 << 30))).where(F.length("text").between(1, SAMPLE_CHARS))
    held = held.groupBy(key.alias("key")).agg(F.min("text").alias("text")).orderBy("key").limit(2 * SAMPLE).select(F.lit(0).cast("long").alias("doc_id"), "text")
    ids = [np.frombuffer(r.ids, "<u2") for r in held.mapInArrow(_tokenize(path), MADE).select("ids").collect()]  # at most 2 * SAMPLE texts of bounded length
    if len(ids) < 2:
        return None
    df = np.bincount(_distinct(ids)[1], minlength=1 << 16)
    idf = np.maximum(np.log((len(ids) - df + 0.5) / (df + 0.5)), 0)
    idf[df == 0] = 0
    ids, mean = ids[:PIVOTS], sum(map(len, ids)) / len(ids)
    # Pivots in a chain of nearest unused neighbours, so that neighbouring numbers are of like vocabulary.
    index, chain, free = _Index(ids, idf, mean), [0], np.ones(len(ids), bool)
    while len(chain) < len(ids):
        free[chain[-1]] = False
        chain.append(int(np.argmax(np.where(free, index.scores(index.terms[chain[-1]]), -1.0))))
    return _Index([ids[k] for k in chain], idf, mean)


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None,
         window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """Pack all documents into sequences of ``window`` tokens: one row per piece
    with doc_id, start, length, doc_tokens, sequence_id, offset and ids
    (little-endian unsigned 32-bit).

    Document counts of all tokens give the inverse document frequencies (0 for
    tokens of half the documents or more); they are at most one number for each
    token of the vocabulary, so they travel to every task.

    Documents are routed to shards by lexical retrieval, too: a bounded sample
    of the table (``_router``) gives PIVOTS documents with a BM25 index of their
    own, every document looks up its three best pivots by all its tokens, and
    the order of shards is that of (best, second, third pivot, wording, id).
    So documents of like vocabulary lie beside each other wherever they were in
    the table, near copies meet, and a group of copies of any size is spread
    over ranges.  Each task streams its
    range, about TASK_TOKENS tokens of it, in shards of ``shard`` documents or
    SHARD_TOKENS tokens: a shard has its BM25 index, the document that opens a window queries it with all its tokens, and its best
    unused neighbours fill the window.  The document that overfills a window is
    cut there and opens the next.  Only the last window of a partition can be
    short; it is cut into powers of two.

    Null and empty texts are one END token; very long ones are cut at window
    ends like any other.  Documents of equal scores go in the range's order.
    Rows that repeat are packed each; null ids stay null.  An empty table gives
    no rows.  Only id and text are read: other columns do not matter.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    made = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = stage(made.mapInArrow(_tokenize(path, _router(made, path, shard)), MADE), "packing-tokens")
    n, total = made.agg(F.count("*"), F.sum("n")).first()
    counts = made.select("ids").mapInArrow(_document_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(1 << 16)
    df[counts["token"].to_numpy(np.int64)] = counts["n"]
    idf = np.maximum(np.log((n - df + 0.5) / (df + 0.5)), 0)
    parts = max(1, math.ceil((total or 0) / TASK_TOKENS))
    ranged = made.select("doc_id", "ids", "route", "near").repartitionByRange(parts, "route", "near", "doc_id").sortWithinPartitions(
        "route", "near", "doc_id", F.crc32("ids"))
    return ranged.select("doc_id", "ids").mapInArrow(_packer(idf, total / n if n else 1.0, window, shard), PIECES)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
