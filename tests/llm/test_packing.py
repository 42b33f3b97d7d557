import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from devtrail.llm import packing
from devtrail.llm.packing import WINDOW, _Encoder, _Index, op1_pack, pack
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def own(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(rows, want, window=WINDOW):
    """Every id in exactly one piece, sequences gapless and full or a power of two."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == sorted(want)
    for i, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[i])
            assert p.ids_crc32 == zlib.crc32(want[i][at:at + p.length].tobytes())
            at += p.length
        assert at == len(want[i])
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or at < window and at & (at - 1) == 0


def test_query(spark, docs, tokenizer):
    want = {r.doc_id: own(tokenizer, r.text) for r in docs.select("doc_id", "text").collect()}
    check(op1_pack(spark, SF).collect(), want)


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    rnd = random.Random(1)
    encoder = _Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(packing, "CACHED_BYTES", 100_000)
    bits = ["Hello", "world,", "it's", "IT'S", "é", "É", "é", " ́x", "Σ", "ΣΑΣ", "İ", "<|endoftext|>", "<|ENDOFTEXT|>", "\x1c", "\x85", "\xa0", "　",
            "​", "123", "½", "…", "😀", "ß", "ſ", "中文", "\n", "\t", " ", "don't", "'", "ll", "x" * 80, "&amp;", ",", ".", "a.", "b,", "'s.", "...", "﻿", "ä"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 12))) for _ in range(4000)]
    for k in range(0, len(texts), 16):
        for t, got in zip(texts[k:k + 16], encoder.encode(texts[k:k + 16])):
            assert np.frombuffer(got, "<u2").tolist() == own(tokenizer, t)[:-1].tolist(), repr(t)


def test_index_scores():
    rnd = np.random.default_rng(2)
    ids = [rnd.integers(0, 50, rnd.integers(1, 60)) for _ in range(30)]
    idf = np.maximum(rnd.normal(1, 1, 50), 0)
    index = _Index(ids, idf, 30.0)
    for seed in range(30):
        want = [sum(idf[t] * (x == t).sum() * 2.2 / ((x == t).sum() + 1.2 * (0.25 + 0.75 * len(x) / 30)) for t in set(ids[seed].tolist())) for x in ids]
        assert np.allclose(index.scores(index.terms[seed]), want)


def test_neighbours_share_a_window(spark):
    topics = [[f"{w}{t}" for w in ("alpha", "beta", "gamma", "delta", "kappa", "omega")] for t in "abcdefgh"]
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices(topics[i % 8], k=60))) for i in range(160)]
    out = pack(spark.createDataFrame(rows, "doc_id long, text string"), window=1024).collect()
    same = mixed = 0
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, set()).add(r.doc_id)
    for docs in seqs.values():
        for a in docs:
            for b in docs:
                same, mixed = same + (a < b and a % 8 == b % 8), mixed + (a < b and a % 8 != b % 8)
    assert same > mixed  # one pair in eight by chance


def test_odd_rows(spark, odd_docs, tokenizer):
    rows = pack(odd_docs).collect()
    per = {}
    for r in odd_docs.select("doc_id", "text").collect():
        per[r.doc_id] = per.get(r.doc_id, 0) + len(own(tokenizer, r.text))
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == per
    assert pack(odd_docs.limit(0)).count() == 0


def test_cache_is_bounded_by_bytes_and_keeps_no_long_stretch(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_BYTES", 200_000)
    rnd = random.Random(2)
    encoder = _Encoder(public_tokenizers.path("word_bpe_49k.json"))
    size = lambda d: sum(packing.WORD_BYTES + len(w) + len(i) for w, i in d.items())
    long = ["".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(2000)), "x" * 5000, "ab," * 900]
    for k in range(40):
        text = " ".join(["".join(rnd.choices("abcdefgh", k=9)) for _ in range(100)] + long + ["the", "the,"])
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == own(tokenizer, text)[:-1].tolist()
        assert size(encoder.words) <= 200_000 and size(encoder.words.old) <= 200_000
        assert not any(len(w) > packing.CACHED_CHARS for w in (*encoder.words, *encoder.words.old))
    assert len(encoder.words.old) > 100


def test_ranges_follow_the_tokens(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_TOKENS", 500)
    monkeypatch.setattr(packing, "SHARD_TOKENS", 120)
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 40)) for i in range(100)], "doc_id long, text string")
    rows = pack(docs, window=64).collect()
    assert len({r.sequence_id >> 32 for r in rows}) >= 8
    assert sorted({r.doc_id for r in rows}) == list(range(100))


def test_neighbours_meet_over_all_shards(spark, monkeypatch):
    """Documents of 26 topics, dealt at random, share windows with their own
    topic however many shards there are."""
    monkeypatch.setattr(packing, "TASK_TOKENS", 40_000)
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    topics = [[word() for _ in range(400)] for _ in range(26)]
    docs = [(i, " ".join(rnd.choices(topics[i % 26], k=100))) for i in range(2600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for shard in (1024, 64):
        windows = {}
        for r in pack(df, shard=shard).select("doc_id", "sequence_id").distinct().collect():
            windows.setdefault(r.sequence_id, []).append(r.doc_id % 26)
        pairs = [a == b for m in windows.values() for i, a in enumerate(m) for b in m[:i]]
        assert sum(pairs) >= 0.9 * len(pairs), shard


def test_router_without_vocabulary(spark):
    docs = spark.createDataFrame([(i, None if i % 3 else " ") for i in range(50)], "doc_id long, text string")
    assert pack(docs, shard=4).count() == 50
    same = spark.createDataFrame([(i, "one text for all") for i in range(50)], "doc_id long, text string")
    rows = pack(same, shard=4, window=64).collect()
    assert sorted(r.doc_id for r in rows if r.start == 0) == list(range(50))


def test_routes_are_the_three_best_scores(monkeypatch):
    rnd = np.random.default_rng(5)
    docs = [rnd.integers(0, 80, rnd.integers(0, 90)).astype("<u2") for _ in range(50)]
    idf = np.maximum(rnd.normal(1, 1, 1 << 16), 0)
    for n in (2, 20):
        want = []
        for x in docs:
            score, route = _Index(docs[:n], idf, 40.0).scores(np.unique(x[idf[x] > 0])), 0
            best = np.argsort(-score, kind="stable")
            for k in range(3):
                place = best[min(k, n - 1)]
                route = route * (n + 1) + (place if score[place] > 0 else n)
            want.append(route)
        index = _Index(docs[:n], idf, 40.0)
        assert index.routes(docs).tolist() == want and index.rows is not None
        monkeypatch.setattr(packing, "DENSE_BYTES", 0)
        index = _Index(docs[:n], idf, 40.0)
        assert index.routes(docs).tolist() == want and index.rows is None
        monkeypatch.undo()


def test_used_documents_leave_the_index():
    rnd = np.random.default_rng(6)
    docs = [rnd.integers(0, 60, 50).astype("<u2") for _ in range(40)]
    index, whole = (_Index(docs, np.ones(1 << 16), 50.0) for _ in range(2))
    free = rnd.random(40) < 0.5
    index.keep(free)
    assert len(index.doc) == free[whole.doc].sum() < len(whole.doc)
    for terms in whole.terms:
        assert np.array_equal(index.scores(terms), np.where(free, whole.scores(terms), 0))


def test_punctuation_at_the_end_is_split_off(tokenizer, monkeypatch):
    encoder = _Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(3)
    marks = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'"]
    texts = [rnd.choice(["word", "Über", "x1", "it's", "9", "naïve,b"]) + "".join(rnd.choices(marks, k=rnd.randint(1, 4))) for _ in range(800)]
    texts += ["a<|endoftext|>", "a,<|endoftext|>", "<|startoftext|>b!", "a<|", "###"]
    for t in texts:
        assert np.frombuffer(encoder.encode([t])[0], "<u2").tolist() == own(tokenizer, t)[:-1].tolist(), repr(t)
    encoder.encode(["###", "word"])
    monkeypatch.setattr(encoder, "ids", None)  # the whole tokenizer is not asked
    encoder.encode(["word###"])

def test_punctuated_forms_take_no_room_in_the_cache(tokenizer):
    encoder = _Encoder(public_tokenizers.path("word_bpe_49k.json"))
    words = ["".join(random.Random(k).choices("abcdefgh", k=9)) for k in range(100)]
    texts = [" ".join(w + m for w in words) for m in ("", ",", ".", ";", ":", "!", "?", ").", '",')]
    for t, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == own(tokenizer, t)[:-1].tolist()
    assert len(encoder.words) + len(encoder.words.old) <= len(words) + 8  # a form each of 100 words, and the marks


def test_new_words_of_many_texts_are_merged_in_one_call(tokenizer, monkeypatch):
    encoder = _Encoder(public_tokenizers.path("word_bpe_49k.json"))
    encoder.encode([", ."])
    rnd, calls, merged = random.Random(8), [], encoder.merged
    words = ["".join(rnd.choices("abcdefghéü", k=9)) for _ in range(600)]
    texts = [" ".join(rnd.choice([w, w.title(), w + ",", w + "."]) for w in rnd.choices(words, k=80)) for _ in range(60)]
    monkeypatch.setattr(encoder, "merged", lambda w: calls.append(w) or merged(w))
    monkeypatch.setattr(encoder, "ids", None)  # the whole tokenizer is not asked
    got = encoder.encode(texts)
    assert len(calls) == 1
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == own(tokenizer, t)[:-1].tolist()
    encoder.encode(texts)
    assert len(calls) == 1


def test_every_latin_letter_and_mark(tokenizer):
    encoder = _Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [f"a{c}b {c} {c}, x{c}. {c}{c}! don{c}t" for c in map(chr, range(1, 0x260))]
    texts += [f"1{c},{c}' '{c}s ́{c} H̱{c}, <|endoftext|>{c}, {c}　z." for c in map(chr, range(1, 0x260, 3))]
    for t, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == own(tokenizer, t)[:-1].tolist(), repr(t)
    assert encoder.encode([]) == [] and encoder.encode(["", " "]) == [b"", b""]


def test_texts_are_taken_by_their_bytes(monkeypatch):
    monkeypatch.setattr(packing, "TEXT_BYTES", 100)
    texts = ["x" * n for n in (250, 0, 40, 60, 1, 99, 100, 0)] + [None] * 3
    batch = packing.pa.RecordBatch.from_pydict({"text": packing.pa.array(texts, packing.pa.string())}).slice(1)
    parts = list(packing._few(batch))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts[1:]
    sizes = [[len(t or "") for t in p.column("text").to_pylist()] for p in parts]
    assert all(sum(s) <= 100 or len(s) == 1 for s in sizes) and len(parts) < 6


def test_a_worker_keeps_two_small_generations_of_words():
    """Two workers of an executor share what its heap leaves of 3000 MB."""
    assert 2 * 2 * packing.CACHED_BYTES <= 256 << 20
