"""Counterfactual-regularised toxicity classifier (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm.common import fresh, table, worker_cache
from devtrail.session import stage

#: Identity terms by group; a counterfactual puts the next term of the group in
#: the place of each.  Mentions of a group alone must not move a score.
IDENTITY_TERMS = (
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("male", "female"), ("he", "she"), ("his", "her"),
    ("black", "white", "asian", "latino"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("gay", "straight", "lesbian", "bisexual"),
    ("trans", "cis"), ("old", "young"), ("immigrant", "native"), ("immigrants", "natives"), ("disabled", "able"),
    ("mann", "frau"), ("männer", "frauen"), ("muslime", "christen", "juden"), ("homme", "femme"), ("hommes", "femmes"),
    ("musulman", "chrétien", "juif"), ("hombre", "mujer"), ("hombres", "mujeres"), ("musulmán", "cristiano", "judío"),
)
MAX_TRAIN = 4_000  # labelled rows in the fitted sample
MAX_FEATURES = 200_000  # most frequent features of the sample
PREFIXES = (4, 5, 6)  # characters of word beginnings that are features
L1, COUNTERFACTUAL = 4e-4, 1.0
STEPS = 300
CACHED_CHUNKS, CHUNK_CHARS = 150_000, 64  # words whose features a worker keeps, and their length
PUNCTUATION = ".,;:!?\"'()[]{}<>*_|`~-…«»„“”‘’¿¡/\\&%$#@+=0123456789"


def _features(word: str) -> list[int]:
    """Hashes of a word and of its beginnings."""
    h = xxhash.xxh64_intdigest
    return [h(word.encode("utf-8", "surrogatepass"), 1), *(h(word[:n].encode("utf-8", "surrogatepass"), 2) for n in PREFIXES if len(word) >= n)]


def _words(text: str) -> set[str]:
    return {w for c in set(text.lower().split()) if (w := c.strip(PUNCTUATION))}


def _swaps() -> dict[str, str]:
    return {a: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, a in enumerate(group)}


def _sample_features(text: str, label: str):
    """Per labelled row: its features, and those of its counterfactual if the
    text has an identity term."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        swap, cache = _swaps(), {}

        def encode(words: set[str]) -> bytes:
            out: set[int] = set()
            for w in words:
                if w not in cache:
                    cache[w] = _features(w)
                out.update(cache[w])
            return np.fromiter(out, np.uint64, len(out)).tobytes()

        for b in batches:
            rows = []
            for t, y in zip(b[text], b[label]):
                words = _words(t or "")
                other = {swap.get(w, w) for w in words}
                rows.append((int(y), encode(words), encode(other) if other != words else None))
            yield pd.DataFrame(rows, columns=["y", "x", "swapped"])
    return run


def fit(sample: list[tuple[int, bytes, bytes | None]], steps: int = STEPS) -> tuple[dict[int, float], float]:
    """Sparse logistic regression by accelerated proximal gradient steps over a
    bounded sample: mean log-loss (classes weighted alike up to a ratio of 4)
    + L1 * |w| + COUNTERFACTUAL * mean squared change of the logit under the
    swap.  Returns the non-zero weights by feature hash, and the intercept."""
    xs = [np.frombuffer(x, np.uint64) for _, x, _ in sample]
    y = np.array([r[0] for r in sample], float)
    if not len(y) or y.min() == y.max():
        return {}, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
    names, counts = np.unique(np.concatenate(xs), return_counts=True)
    keep = np.flatnonzero(counts >= min(3, max(1, len(y) // 50)))
    keep = np.sort(keep[np.argsort(-counts[keep], kind="stable")[:MAX_FEATURES]])
    names, share = names[keep], counts[keep] / len(y)
    if not len(names):
        return {}, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))

    def csr(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        r, c = [], []
        for i, x in enumerate(rows):
            at = np.searchsorted(names, x)
            at[at == len(names)] = 0
            at = at[names[at] == x].astype(np.int32)
            c.append(at)
            r.append(np.full(len(at), i, np.int32))
        return np.concatenate(r), np.concatenate(c)

    r, c = csr(xs)
    pairs = [(x, np.frombuffer(s, np.uint64)) for (_, _, s), x in zip(sample, xs) if s is not None]
    pos = y.mean()
    weight = np.where(y > 0, min(4.0, (1 - pos) / pos) if pos < 0.5 else 1.0, 1.0 if pos < 0.5 else min(4.0, pos / (1 - pos)))
    weight /= weight.sum()
    # Frequent features are scaled down so that one step size suits all.
    scale = 1 / np.sqrt(share * len(y) / 10 + 1)
    if pairs:
        (ra, ca), (rb, cb) = csr([a for a, _ in pairs]), csr([b for _, b in pairs])

    def gradient(w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        ws = w * scale
        z = np.bincount(r, ws[c], len(y)) + bias
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(c, e[r], len(names))
        if pairs:
            d = (np.bincount(ra, ws[ca], len(pairs)) - np.bincount(rb, ws[cb], len(pairs))) * (2 * COUNTERFACTUAL / len(pairs))
            g += np.bincount(ca, d[ra], len(names)) - np.bincount(cb, d[rb], len(names))
        return g * scale, e.sum()

    # A step within the curvature of the loss, by power iteration on its bound.
    v = np.ones(len(names))
    for _ in range(8):
        v /= np.linalg.norm(v)
        u = np.bincount(c, (weight * np.bincount(r, (v * scale)[c], len(y)))[r], len(names)) * scale / 4
        if pairs:
            d = (np.bincount(ra, (v * scale)[ca], len(pairs)) - np.bincount(rb, (v * scale)[cb], len(pairs))) * (2 * COUNTERFACTUAL / len(pairs))
            u += (np.bincount(ca, d[ra], len(names)) - np.bincount(cb, d[rb], len(names))) * scale
        v = u
    step = 0.8 / (np.linalg.norm(v) + 0.25)
    w, bias, t = np.zeros(len(names)), 0.0, 1.0
    w_at, bias_at = w, bias
    for _ in range(steps):
        g, gb = gradient(w_at, bias_at)
        new = w_at - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        new_bias = bias_at - step * gb
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_at, bias_at = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    full = w * scale
    at = np.flatnonzero(full)
    return {int(n): float(x) for n, x in zip(names[at], full[at])}, float(bias)


def score_column(text: str | Column, weights: dict[int, float], bias: float) -> Column:
    """A pandas UDF: the probability that a text is toxic.  The non-zero
    weights (at most MAX_FEATURES) travel with it."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        known: dict[str, tuple] = worker_cache(f"toxicity:{len(weights)}:{bias}")
        out = np.empty(len(texts))
        for k, t in enumerate(texts):
            hits: set[int] = set()
            for chunk in set(t.lower().split()) if t else ():
                found = known.get(chunk)
                if found is None:
                    word = chunk.strip(PUNCTUATION)
                    found = tuple(f for f in _features(word) if f in weights) if word else ()
                    if len(known) >= CACHED_CHUNKS:
                        known.clear()
                    if len(chunk) <= CHUNK_CHARS:
                        known[chunk] = found
                if found:
                    hits.update(found)
            out[k] = bias + sum(weights[f] for f in sorted(hits))
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return score(F.col(text) if isinstance(text, str) else text)


def held_out(doc_id: str | Column) -> Column:
    """Whether a row's label is kept for testing (null ids: no)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
          max_train: int = MAX_TRAIN) -> tuple[dict[int, float], float]:
    """Fit on a bounded sample (``max_train`` rows, by a hash of their id) of
    the labelled documents that are not held out.  Null labels and ids are no
    rows; a label's repeats count once, the largest label stands."""
    rows = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    rows = rows.groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_y"))
    rows = stage(rows.orderBy(F.xxhash64("_id", F.lit(6)), "_id").limit(max_train), "toxicity-sample")
    (body,) = fresh(rows, "body")
    sample = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias(body)).join(rows, "_id")
    # A document id that repeats gives its first text: at most max_train rows.
    sample = sample.groupBy("_id", "_y").agg(F.min(body).alias(body))
    got = sample.mapInPandas(_sample_features(body, "_y"), "y int, x binary, swapped binary").toPandas()
    return fit(sorted(zip(got["y"], got["x"], got["swapped"]), key=lambda r: r[1]))


def classify_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic`` (1 if 0.5 or more).

    Only the text enters a score: the set of its words and of their beginnings.
    The penalty on score changes under swapped identity terms keeps neutral
    mentions of a group from carrying weight.  Null and empty texts score by
    the intercept alone, as a text without evidence; without labels every score
    is 0.5 or the labels' rate.  Long texts are read whole.  Rows that repeat
    score alike; repeated labels count once.  Columns of these names are
    replaced, all others stay; an empty table gives an empty one.
    """
    weights, bias = train(docs, labels, text, doc_id)
    bias = min(bias, -0.01)  # a text without evidence is not toxic
    return docs.withColumn("toxicity", score_column(text, weights, bias)).withColumn(
        "toxic", (F.col("toxicity") >= 0.5).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = classify_toxicity(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic").alias("predicted"))
