import gzip
import hashlib
import io
import random
import subprocess
import sys
import zlib

import pytest

from devtrail.llm.warc import page_of, read_warc, records_of, write_warc

SCHEMA = "page_id long, url string, html string, chunk_no int, data string"


def pages(rnd):
    big = "".join(rnd.choices("añ😀b \r\n<>", k=40_000))
    twice = "x" * 999 + "é"
    rows = [(i, f"http://h/{i}", "".join(rnd.choices("abcé\r\n", k=rnd.randint(0, 3000)))) for i in range(60)]
    rows += [(100, None, None), (101, "u v\n", ""), (102, "u", big), (103, "u", big), (104, "u", "\r\n\r\n" * 500), (105, "u", "x" * 999), (106, "u", "x" * 999),
             (107, "u", twice), (108, "u", twice), (109, "u", twice), (None, "u", twice), (None, "u", "lone" * 400)]
    return [(*r, 1, "clash") for r in rows]


def payload(html):
    return (html or "").encode()


def test_round_trip_in_chunks(spark, tmp_path):
    rows = pages(random.Random(1))
    archives = write_warc(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "w"), chunk=1000, roll=20_000)
    assert archives.count() > 3 and sum(r.records for r in archives.collect()) == len(rows)
    got = read_warc(archives, chunk=700).withColumn("page", page_of("record_id")).collect()
    assert max(len(r.data) for r in got) == 700
    chunks = {}
    for r in got:
        chunks.setdefault((r.page, r.record_type, r.declared_digest), []).append(r)
    assert len(chunks) == len(rows)
    want = {(p, hashlib.sha1(payload(h)).hexdigest()): payload(h) for p, _, h, *_ in rows}
    for (page, kind, digest), cs in chunks.items():
        cs.sort(key=lambda r: r.chunk_no)
        whole, done = want[(page, digest)], b""
        assert cs[0].declared_bytes == len(whole) and [c.last for c in cs] == [False] * (len(cs) - 1) + [True]
        for at, c in enumerate(cs):
            done += c.data
            assert (c.chunk_no, c.payload_bytes, c.payload_digest) == (at, len(done), hashlib.sha1(done).hexdigest())
        assert done == (b"" if kind == "revisit" else whole)
    revisits = {(r.page, int(r.refers_to.removeprefix("urn:page:"))) for r in got if r.record_type == "revisit"}
    assert revisits == {(102, 103), (107, 109), (108, 109), (None, 109)}
    assert {r.target_uri for r in got if r.page in (100, 101)} == {None, "u%20v%0A"}


def test_files_are_plain_warc(spark, tmp_path):
    rows = [(1, "http://a/", "é" * 600, 1, ""), (2, "http://b/", "é" * 600, 1, "")]
    archives = write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "w")).collect()
    with open(archives[0].path.removeprefix("file:"), "rb") as f:
        packed = f.read()
    plain = gzip.decompress(packed)
    assert packed.count(b"\x1f\x8b\x08") >= 2 and plain.count(b"WARC/1.1\r\n") == 2 and plain.endswith(b"\r\n\r\n")
    assert b"WARC-Refers-To: <urn:page:2>" in plain and plain.count("é".encode()) == 600
    for text in (packed, plain):
        assert [(r["record_type"], r["payload_bytes"]) for r in records_of(io.BytesIO(text), 1 << 16, True)] in ([("revisit", 0), ("response", 1200)],)
    for bad in (packed[:-30], plain[:-6], plain[:-700], plain[:-4] + b"abcd"):
        with pytest.raises(ValueError):
            list(records_of(io.BytesIO(bad), 1 << 16, True))


def test_other_records(spark):
    def record(kind, more, block):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{more}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    text = record("warcinfo", "WARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\n", b"software: x\r\n\r\n")
    text += record("response", "Content-Type: application/http; msgtype=response\r\n", b"no header at all")
    text += record("response", "Content-Type: application/http\r\nWARC-Payload-Digest: sha1:ZZ!\r\n", b"HTTP/1.0 200 OK\r\n\r\n")
    got = list(records_of(io.BytesIO(text), 8, True))
    assert [(r["record_type"], r["chunk_no"], r["data"]) for r in got] == [
        ("warcinfo", 0, b"software"), ("warcinfo", 1, b": x\r\n\r\n"), ("response", 0, b"no heade"), ("response", 1, b"r at all"), ("response", 0, b"")]
    assert got[0]["record_id"] == "urn:uuid:1" and got[-1]["declared_digest"] is None


def test_memory_is_a_chunk(tmp_path):
    """A record of 256 MB is read in chunks within a few MB."""
    path = tmp_path / "big.warc.gz"
    n = 256 << 20
    with open(path, "wb") as f:
        z = zlib.compressobj(1, zlib.DEFLATED, 31)
        f.write(z.compress(f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {n}\r\n\r\n".encode()))
        for _ in range(256):
            f.write(z.compress(bytes(1 << 20)))
        f.write(z.compress(b"\r\n\r\n") + z.flush())
    code = ("import resource,sys\nfrom devtrail.llm.warc import records_of\nbase=resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            f"n=sum(len(r['data']) for r in records_of(open({str(path)!r},'rb'),1<<16,True))\n"
            "print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss-base)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120).stdout.split()
    assert int(out[0]) == n and int(out[1]) < 20_000  # KB


def test_shuffled_when_repeats_are_many_and_empty_table(spark, tmp_path, monkeypatch):
    import devtrail.llm.warc as warc

    monkeypatch.setattr(warc, "MAX_ROWS", 1)
    rows = pages(random.Random(1))
    df = spark.createDataFrame(rows, SCHEMA)
    got = read_warc(write_warc(df), data=False).where("record_type = 'revisit'").select(page_of("record_id").alias("p"), "refers_to", "data").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(102, "urn:page:103", None), (107, "urn:page:109", None), (108, "urn:page:109", None), (None, "urn:page:109", None)], key=str)
    assert read_warc(write_warc(df.limit(0))).count() == 0
    again = df.where("page_id = 109").union(df.where("page_id = 109"))
    assert [r.record_type for r in read_warc(write_warc(again)).where("last").collect()] == ["response"] * 2
