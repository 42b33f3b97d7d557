import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_lines import brute
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_every_stage_against_brute_force(spark, docs):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    now, seen = docs, {}
    for name, step in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in now.collect()]
        out = step(spark, now, SF)
        if name != "packing":
            assert out.columns == list(corpus_pipeline.COLUMNS)
            out = spark.createDataFrame(out.collect(), docs.schema)
            assert out.where("n_chars <> length(text)").count() == 0
        after = [(r.doc_id, r.text, r.source) if name != "packing" else r for r in out.collect()]
        if name == "toxicity":
            gone = {i for i, _, _ in before} - {i for i, _, _ in after}
            assert gone and sum(labels.get(i, 1) for i in gone) >= 0.97 * len(gone)
            assert sum(labels.get(i, 0) for i, _, _ in after) <= 0.1 * sum(labels.values())
        elif name == "line dedup":
            assert {i: t for i, t, _ in after} == brute(before)
        elif name == "simhash near-dedup":
            want = brute_components({i: brute_fingerprint(t) for i, t, _ in before})
            assert sorted(i for i, _, _ in after) == sorted(set(want.values())) and len(after) < len(before)
        elif name == "mixing":
            words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
            sizes, taken, texts = {}, {}, {i: t for i, t, _ in before}
            for i, t, s in before:
                sizes[s] = sizes.get(s, 0) + len(words(t))
            for i, t, s in after:
                taken[s] = taken.get(s, 0) + len(words(t))
                assert texts[i].startswith(t)
            for s, want in brute_targets(sizes).items():
                assert abs(taken[s] - want) <= 1
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = sorted(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in before)
            assert sum(want) == sum(r.length for r in after) == sum(len(np.frombuffer(r.ids, "<u4")) for r in after)
        seen[name], now = len(after), out
    assert all(seen.values())


def test_empty_documents(spark, docs):
    now = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        now = step(spark, now, SF)
        assert now.count() == 0


def test_odd_documents(spark, odd_docs):
    now = odd_docs.withColumn("extra", F.lit(1))
    for name, step in corpus_pipeline.STAGES:
        now = step(spark, now, SF)
        assert now.count() > 0, name
