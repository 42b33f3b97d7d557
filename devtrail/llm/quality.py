"""Quality by an interpolated modified Kneser-Ney character model (operator 3)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm.common import fresh, table
from devtrail.operators.joins import sized_broadcast
from devtrail.session import stage

ORDER = 4  # characters of an n-gram; four 16-bit code points fill a long
PIECE = 4_000_000  # characters whose n-grams are gathered at once
BLOCK = 16_000_000  # characters, about, of the documents whose distinct n-grams are looked up together
LOW, HIGH = 0.002, 0.998  # quantiles of trusted perplexities that bound what is kept
SLACK = 1.05  # factor on both bounds
HELD = 5  # one in so many trusted texts is held out to set the bounds
FEW = 100  # held-out documents of a language below which it has the wider of its own and the overall bounds
ALPHABET = 1 << 16


def _grams(text: str) -> np.ndarray:
    """The n-grams that predict each character and the end, as longs; the first
    ones begin with padding."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    c = np.concatenate([[2] * (ORDER - 1), np.where(c > 0xFFFF, 0xFFFD, c), [3]]).astype(np.uint64)
    n = len(c) - ORDER + 1
    out = np.zeros(n, np.uint64)
    for k in range(ORDER):
        out = out << np.uint64(16) | c[k:k + n]
    return out.view(np.int64)


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct n-grams of whole texts, with their number in trusted texts and
    in those of them that are held out."""
    for b in batches:
        for part, rows in b.groupby("part"):
            for held in _pieces(rows["text"].tolist()):
                code, grams = pd.factorize(np.concatenate([_grams(t) for t in held]))
                n = np.bincount(code, minlength=len(grams))
                yield pd.DataFrame({"gram": grams, "n": n * (part >= 0), "held": n * (part > 0)})


def _distinct(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    seen = [pd.unique(np.concatenate([_grams(t) for t in held])) for held in _pieces(rows["text"].tolist())]
    grams = np.sort(pd.unique(np.concatenate(seen)))
    return pd.DataFrame({"block": np.full(len(grams), key[0], np.int64), "gram": grams})


def _score(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Perplexity of each text, and of a held-out one by the model that has not seen it."""
    index = pd.Index(known["gram"].to_numpy())
    logp, without = known["logp"].to_numpy(), known["without"].to_numpy()
    seen, unseen = np.zeros(len(rows)), np.full(len(rows), np.nan)
    for k, (t, part) in enumerate(zip(rows["text"], rows["part"])):
        at = index.get_indexer(_grams(t))
        seen[k] = logp[at].sum() / len(at)
        if part > 0:
            unseen[k] = without[at].sum() / len(at)
    return pd.DataFrame({"none": rows["none"], "id": rows["id"], "key": rows["key"], "perplexity": np.exp(-seen),
                         "unseen": pd.array(np.exp(-unseen), "Float64")})


def _discounts(counts: DataFrame) -> dict[int, list[float]]:
    """A model's modified discounts for counts of 1, 2 and 3 or more."""
    out = {}
    for model, *of in counts.groupBy("model").agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).collect():
        n1, n2 = of[:2]
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        out[model] = [min(float(k), max(0.05, k - (k + 1) * y * b / a)) if a else 0.5 for k, (a, b) in enumerate(zip(of, of[1:]), 1)]
    return out


def _by_model(values: dict[int, float]) -> Column:
    """The value of a row's model, null for other models."""
    out = F.lit(None).cast("double")
    for model, x in values.items():
        out = F.when(F.col("model") == model, float(x)).otherwise(out)
    return out


def log_probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(model, gram, logp) for every row of ``grams`` (model, gram), by its model's
    ``counts`` (model, gram, n).

    The highest order counts occurrences, each lower one the distinct
    characters before a gram.  A level joins its counts, the totals of its
    contexts and the next lower level's probabilities, all sharded by their
    keys; only the counts of counts reach the driver.
    """
    def level(width: int, grams: DataFrame, counts: DataFrame) -> DataFrame:
        """model, gram, p for ``grams`` of ``width`` characters."""
        discounts = _discounts(counts)
        cuts = [_by_model({model: d[k] for model, d in discounts.items()}) for k in range(3)]
        cut = F.when(F.col("n") == 1, cuts[0]).when(F.col("n") == 2, cuts[1]).when(F.col("n") >= 3, cuts[2])
        context = F.shiftrightunsigned("gram", 16)
        if width == 1:
            sums = counts.groupBy("model").agg(F.sum("n").alias("total"), F.sum(cut).alias("left")).collect()
            total = _by_model({r.model: r.total for r in sums})
            rest = F.coalesce(_by_model({r.model: r.left / r.total / ALPHABET for r in sums}), F.lit(1 / ALPHABET))
            return grams.join(counts, ["model", "gram"], "left").select(
                "model", "gram", (F.coalesce((F.col("n") - cut) / total, F.lit(0.0)) + rest).alias("p"))
        lower_mask = F.lit((1 << 16 * (width - 1)) - 1)
        suffix = F.col("gram").bitwiseAND(lower_mask)
        heads = counts.groupBy("model", context.alias("context")).agg(F.sum("n").alias("total"), F.sum(cut).alias("held"))
        lower_counts = stage(counts.groupBy("model", suffix.alias("gram")).agg(F.count("*").alias("n")), f"quality-{width - 1}")
        lower = level(width - 1, grams.select("model", suffix.alias("gram")).distinct(), lower_counts)
        out = grams.join(counts, ["model", "gram"], "left").withColumn("context", context).withColumn("suffix", suffix)
        out = out.join(heads, ["model", "context"], "left").join(lower.select("model", F.col("gram").alias("suffix"), F.col("p").alias("back")), ["model", "suffix"])
        seen = F.coalesce((F.col("n") - cut) / F.col("total"), F.lit(0.0))
        return out.select("model", "gram", (seen + F.coalesce(F.col("held") / F.col("total"), F.lit(1.0)) * F.col("back")).alias("p"))

    return level(ORDER, grams.select("model", "gram"), counts.where("n > 0")).select("model", "gram", F.log("p").alias("logp"))


def classify_quality(docs: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
                     low: float = LOW, high: float = HIGH) -> DataFrame:
    """``docs`` with ``perplexity`` (per character of the whole text), the bounds
    ``perplexity_low`` and ``perplexity_high`` of its language, and ``kept``.

    ``trusted``: one column of ids whose documents train the model; repeats
    count once.  The bounds are the ``low`` and ``high`` quantiles of the trusted
    documents' perplexities in the language, with some slack: text that is too
    surprising (noise, markup, shouting) or too predictable (repetition) goes.
    The bounds are set by trusted texts held out of the model, as in-sample
    perplexities are too low for unseen text: one in HELD by a hash of the text,
    and in each language at least the text of the smallest hash, so a language
    with a single trusted text still has a bound.  A language of fewer than FEW
    held-out documents has the wider of its own bounds and those of all.
    Scoring deals whole texts into blocks by a hash; a block's distinct n-grams
    are joined with the sharded log-probabilities and come back to score it.

    Null or empty texts have no perplexity and are not kept.  A language without
    trusted text has the bounds of all trusted text; without any trusted text
    all other documents are kept.  A null language is one of its own.  Rows with
    equal id and text share a score.  Long texts are scored whole.  Columns of
    the new names are replaced, all others stay; an empty table gives an empty
    one.
    """
    new = ("perplexity", "perplexity_low", "perplexity_high", "kept")
    docs = docs.drop(*new)
    (own,) = trusted.columns
    ids = trusted.select(F.col(own).cast("long").alias("own")).where("own IS NOT NULL").distinct()
    ids = stage(ids.withColumn("yes", F.lit(True)), "quality-trusted")
    body = docs.select(F.col(doc_id).isNull().alias("none"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
                       F.col(text).alias("text"), F.col(lang).alias("lang")).where(F.length("text") > 0)
    mine = body.join(sized_broadcast(ids), (F.col("id") == F.col("own")) & ~F.col("none"), "left").select(
        "none", "id", F.xxhash64("text").alias("key"), "text", "lang", F.coalesce("yes", F.lit(False)).alias("yes"))
    # Held out by the text, so copies share their side; a language's smallest hash is always held out.
    first = stage(mine.where("yes").groupBy("lang").agg(F.min("key").alias("first")).select("first", F.lit(True).alias("least")).distinct(), "quality-held")
    held = F.coalesce("least", F.lit(False)) | (F.pmod("key", F.lit(HELD)) == 0)
    part = F.when(~F.col("yes"), -1).when(held, 1).otherwise(0).cast("int").alias("part")
    flagged = mine.join(sized_broadcast(first), F.col("key") == F.col("first"), "left").select("none", "id", "key", "text", part)
    counts = flagged.select("text", "part").mapInPandas(_counts, "gram long, n long, held long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))
    counts = stage(counts, "quality-counts")
    # Model 0 of all trusted text scores every n-gram, model 1 those of held-out text by the counts of the others.
    models = counts.select("gram", F.inline(F.array(
        F.struct(F.lit(0).alias("model"), F.col("n"), F.lit(True).alias("asked")),
        F.struct(F.lit(1).alias("model"), (F.col("n") - F.col("held")).alias("n"), (F.col("held") > 0).alias("asked")))))
    known = log_probabilities(models.where("asked"), models.select("model", "gram", "n"))
    known = known.groupBy("gram").agg(*[F.max(F.when(F.col("model") == k, F.col("logp"))).alias(c) for k, c in enumerate(("logp", "without"))])
    known = stage(known, "quality-model")

    blocks = max(1, math.ceil((body.agg(F.sum(F.length("text"))).first()[0] or 0) / BLOCK))
    dealt = flagged.withColumn("block", F.pmod(F.xxhash64("none", "id", "key"), F.lit(blocks)))
    looked = dealt.groupBy("block").applyInPandas(_distinct, "block long, gram long").join(known, "gram").select("block", *known.columns)
    scored = dealt.groupBy("block").cogroup(looked.groupBy("block")).applyInPandas(
        _score, "none boolean, id long, key long, perplexity double, unseen double")
    scored = stage(scored.groupBy("none", "id", "key").agg(F.min("perplexity").alias("perplexity"), F.min("unseen").alias("unseen")), "quality-scores")

    n_none, n_id, n_key, n_own, n_lang, n_yes = fresh(docs, "none", "id", "key", "own", "lang", "yes")
    scores = scored.select(F.col("none").alias(n_none), F.col("id").alias(n_id), F.col("key").alias(n_key), "perplexity")
    out = docs.join(scores, (F.col(doc_id).isNull() == F.col(n_none)) & (F.coalesce(F.col(doc_id).cast("long"), F.lit(0)) == F.col(n_id))
                    & (F.xxhash64(F.col(text)) == F.col(n_key)) & F.col(text).isNotNull(), "left").drop(n_none, n_id, n_key)
    langs = body.select("none", "id", "lang").join(scored.where("unseen IS NOT NULL"), ["none", "id"])
    # Trusted documents are judged by what the model knows of them, so the lower bound looks at both perplexities.
    least, most = F.least("perplexity", "unseen"), F.greatest("perplexity", "unseen")
    both = [F.percentile_approx(least, low, 10_000).alias("lo"), F.percentile_approx(most, high, 10_000).alias("hi"), F.count("*").alias("n")]
    q = langs.agg(*both).first()
    lo, hi = (q.lo / SLACK, q.hi * SLACK) if q.n else (0.0, float("inf"))
    few, own_lo, own_hi = F.col("n") < FEW, F.col("lo") / SLACK, F.col("hi") * SLACK
    bounds = stage(langs.groupBy("lang").agg(*both).select(
        F.col("lang").alias(n_lang), F.when(few, F.least(own_lo, F.lit(lo))).otherwise(own_lo).alias("lo"),
        F.when(few, F.greatest(own_hi, F.lit(hi))).otherwise(own_hi).alias("hi")), "quality-bounds")
    out = out.join(sized_broadcast(bounds), F.col(lang).eqNullSafe(F.col(n_lang)), "left")
    out = out.select(*docs.columns, "perplexity", F.coalesce("lo", F.lit(lo)).alias("perplexity_low"), F.coalesce("hi", F.lit(hi)).alias("perplexity_high"))
    return out.withColumn("kept", F.coalesce(F.col("perplexity").between(F.col("perplexity_low"), F.col("perplexity_high")), F.lit(False)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document; documents labelled of good
    quality are the trusted text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return classify_quality(docs, trusted).drop("text")
