"""Secret scans: keyword prefilter, anchored patterns, checksums (operator 2)."""

from __future__ import annotations

import re
import zlib

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm.common import table

#: Kinds in the order that spans with the same start are listed.
KINDS = ("assign", "access", "hex", "github", "npm")
#: Kind, its keywords in lower case, and the pattern anchored at a keyword.
ANCHORED = (
    ("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
     r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""),
    ("access", ("akia",), r"AKIA[A-Z0-9]+"),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    ("npm", ("npm_",), r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
)
HEX_CHARS = 24  # of a hexadecimal run, at least
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "array<struct<kind:string,start:long,end:long,checked:boolean>>"


def checksum_ok(token: str) -> bool:
    """Whether the last six characters of a prefixed token are the CRC-32 of
    the 30 before them, in base 62."""
    body, tail = token[4:-6], token[-6:]
    value = 0
    for c in tail:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body.encode())


def _hex_spans(text: str, probe: re.Pattern, run: re.Pattern) -> list[tuple[int, int]]:
    """Maximal runs of HEX_CHARS or more hexadecimal characters.  Such a run
    covers two neighbours among every twelfth character, so only there the
    pattern is tried."""
    step, out, done = HEX_CHARS // 2, [], 0
    for m in probe.finditer(text[step - 1::step]):
        for at in range((m.start() + 1) * step - 1, m.end() * step, step):
            if at < done:
                continue
            begin = at
            while begin > done and text[begin - 1] in "0123456789abcdef":
                begin -= 1
            done = run.match(text, begin).end()
            if done - begin >= HEX_CHARS:
                out.append((begin, done))
    return out


def secret_spans(text: str | Column) -> Column:
    """Spans of secrets of a text: array of (kind, start, end, checked), by
    start and then kind; code points, end exclusive.

    One pass of an Aho-Corasick automaton over the text finds the keywords of
    all kinds; each kind's pattern is tried only there, anchored, from left to
    right and not inside its previous match.  ``access`` needs 20 characters,
    the value of ``assign`` 6, ``hex`` 24.  Tokens that embed a checksum
    (github, npm) are kept if it is right (checked true); the other kinds embed
    none (checked null).  A null or empty text has no span.
    """

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        machine = ahocorasick.Automaton()
        patterns = [re.compile(p) for _, _, p in ANCHORED]
        for k, (_, keys, _) in enumerate(ANCHORED):
            for key in keys:
                machine.add_word(key, (k, len(key)))
        machine.make_automaton()
        probe, run = re.compile("[0-9a-f]{2,}"), re.compile("[0-9a-f]+")

        def scan(text: str | None) -> list[dict]:
            if not text:
                return []
            # Lower case of A-Z only: positions must stay.
            low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            found, done = [], [0] * len(ANCHORED)
            for end, (k, n) in machine.iter(low):
                if (at := end - n + 1) >= done[k] and (m := patterns[k].match(text, at)):
                    kind, done[k] = ANCHORED[k][0], m.end()
                    checked = checksum_ok(m[0]) if kind in ("github", "npm") else None
                    if checked is False or kind == "assign" and len(m[2]) < 6 or kind == "access" and len(m[0]) < 20:
                        continue
                    found.append((at, kind, m.end(), checked))
            found += [(s, "hex", e, None) for s, e in _hex_spans(text, probe, run)]
            found.sort(key=lambda x: (x[0], KINDS.index(x[1])))
            return [{"kind": kind, "start": s, "end": e, "checked": c} for s, kind, e, c in found]

        return texts.map(scan, na_action=None)

    return spans(F.col(text) if isinstance(text, str) else text)


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the secret spans of each text in ``out`` (a column of that
    name is replaced; all others stay).  Rows are scanned one by one: no
    shuffle, no state, so rows that repeat have the same spans and an empty
    table gives an empty one.  A null or empty text has no span; a long one is
    scanned whole."""
    return docs.withColumn(out, secret_spans(text))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts of the base kinds, the digest of their spans, and
    all spans."""
    docs = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    return docs.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                       F.sha2(said(base), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"))
