"""WARC archives written and read as a chunked record table (operator 11)."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devtrail.llm.common import table
from devtrail.operators.joins import sized_broadcast
from devtrail.session import scratch_path, stage

CHUNK = 64 << 10  # bytes of payload in a row
REVISIT_BYTES = 1000  # payloads from this size on are written once
ROLL = 256 << 20  # bytes after which an archive file is closed
HEAD = 1 << 20  # bytes of a record's or response's header, at most
FLUSH = 8 << 20  # bytes of rows handed to Spark at a time
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_ROWS, MAX_BYTES = 1_000_000, 64 << 20  # of repeated digests that are broadcast; beyond it they are joined by a shuffle

CHUNKS = ("record_id string, record_type string, target_uri string, refers_to string, declared_bytes long, declared_digest string, "
          "chunk_no long, data binary, payload_bytes long, payload_digest string, last boolean")


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")))


def page_of(record_id: str | Column) -> Column:
    """The page id in the id of a record that ``write_warc`` wrote, else null."""
    return F.regexp_extract(record_id, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")


def _http_head(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def _record_head(row: dict) -> bytes:
    """The header of a record, and that of the response in it."""
    inner = _http_head(row["bytes"])
    revisit = row["refers_to"] is not None
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", DATE)]
    if row["uri"]:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["uri"])))
    if revisit:
        fields += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(row['digest'])).decode()}"),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(inner) + (0 if revisit else row["bytes"])))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + inner


def _writer(folder: str, roll: int, level: int):
    """Rows of chunks, each record's in order, into archives: a gzip member a
    record.  Names are unique to the attempt; a file counts once its row is out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        out = member = name = None
        records = size = 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64()), pa.array([size], pa.int64())],
                                              ["path", "records", "bytes"])

        names = ("record_id", "uri", "refers_to", "bytes", "digest")
        for b in batches:
            heads, first, last, data = b.select(list(names)), b.column("first"), b.column("last"), b.column("data")
            for i in range(b.num_rows):
                piece = b""
                if first[i].as_py():
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        system.create_dir(root, recursive=True)
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    member = zlib.compressobj(level, zlib.DEFLATED, 31)
                    piece = member.compress(_record_head(heads.slice(i, 1).to_pylist()[0]))
                piece += member.compress(data[i].as_py())
                if last[i].as_py():
                    piece += member.compress(b"\r\n\r\n") + member.flush()
                    records += 1
                out.write(piece)
                size += len(piece)
                if last[i].as_py() and size >= roll:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def write_warc(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html",
               revisit_bytes: int = REVISIT_BYTES, chunk: int = CHUNK, roll: int = ROLL, level: int = 6) -> DataFrame:
    """Archives (path, records, bytes) with one record per row of ``pages``,
    under ``folder`` (default: the session's shared folder).

    A record holds the page as an HTTP response, its payload the UTF-8 of
    ``html``.  Of rows with equal payloads of ``revisit_bytes`` or more, the one
    with the largest id is written as response, the others as revisits that
    refer to it.  Digests of payloads are grouped with partial sums, and only
    those that repeat are joined back (broadcast if few, else by a shuffle), so
    the payloads themselves stay where they were read.  They reach the writer
    in chunks: no task holds a record's bytes twice.  Files are named by
    attempt, and only those in the returned table, written once their task was
    done, count: a lost executor's half files are never read.

    A null html is empty; a null url has no target; null ids sort before all
    others, and payloads of null ids only are all responses; rows that repeat
    id and payload are records of their own, with the same decision; an empty
    table gives no archive; other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("uri"),
                        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    same = F.when(F.col("bytes") >= revisit_bytes, F.sha2("payload", 256))
    held = rows.select("id", same.alias("same")).where("same IS NOT NULL").groupBy("same").agg(F.max("id").alias("keeper"), F.count("*").alias("n"))
    held = sized_broadcast(held.where("n > 1").select("same", "keeper"), MAX_ROWS, MAX_BYTES)
    rows = rows.withColumn("same", same).join(held, "same", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    pieces = F.greatest(F.lit(1), F.ceil(F.when(revisit, F.lit(0)).otherwise(F.col("bytes")) / chunk)).cast("int")
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    rows = rows.select(
        _record_id(F.col("id")).alias("record_id"), "uri", F.when(revisit, _record_id(F.col("keeper"))).alias("refers_to"), "bytes",
        F.sha1("payload").alias("digest"), pieces.alias("pieces"),
        F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: F.substring(body, i * chunk + 1, F.lit(chunk))).alias("chunks"))
    rows = rows.select("record_id", "uri", "refers_to", "bytes", "digest", "pieces", F.posexplode("chunks").alias("at", "data"))
    rows = rows.select("record_id", "uri", "refers_to", "bytes", "digest", (F.col("at") == 0).alias("first"),
                       (F.col("at") == F.col("pieces") - 1).alias("last"), "data")
    return stage(rows.mapInArrow(_writer(folder, roll, level), "path string, records long, bytes long"), "warc-archives")


class _Bytes:
    """A file's bytes, unpacked member by member if it is compressed."""

    def __init__(self, file):
        self.file, self.held, self.gz = file, bytearray(), None
        self.raw = file.read(256 << 10)
        self.packed = self.raw[:2] == b"\x1f\x8b"

    def more(self) -> bool:
        while self.raw or (self.gz is not None and self.gz.unconsumed_tail):
            if not self.packed:
                self.held += self.raw
                self.raw = self.file.read(256 << 10)
                return True
            if self.gz is None:
                self.gz = zlib.decompressobj(31)
            got = self.gz.decompress(self.gz.unconsumed_tail or self.raw, 256 << 10)
            if self.gz.eof:
                self.raw, self.gz = self.gz.unused_data or self.file.read(256 << 10), None
            elif not self.gz.unconsumed_tail:
                self.raw = self.file.read(256 << 10)
                if not self.raw and not got:
                    raise ValueError("the archive ends within a record")
            if got:
                self.held += got
                return True
        if self.gz is not None:
            raise ValueError("the archive ends within a record")
        return False

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes."""
        while len(self.held) < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def head(self, most: int) -> bytes | None:
        """The bytes through the next empty line; None at the end of the file,
        or if ``most`` bytes hold no empty line (nothing is taken then)."""
        seen = 0
        while (at := self.held.find(b"\r\n\r\n", max(0, seen - 3), most)) < 0:
            seen = len(self.held)
            if seen >= most or not self.more():
                return None
        return self.take(at + 4)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def _hex_digest(value: str | None) -> str | None:
    kind, _, text = (value or "").partition(":")
    if kind.lower() != "sha1":
        return None
    if len(text) == 40:
        return text.lower()
    try:
        return base64.b32decode(text.upper()).hex()
    except ValueError:
        return None


def records_of(file, chunk: int, data: bool) -> Iterator[dict]:
    """The chunk rows of an archive, record by record; at most a chunk and what
    a read unpacks are held."""
    stream = _Bytes(file)
    while (head := stream.head(HEAD)) is not None:
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        f = _fields(head)
        left, kind = int(f["content-length"]), f.get("warc-type")
        bare = lambda name: f[name].strip("<>") if name in f else None
        length = None
        if "application/http" in f.get("content-type", "") and (inner := stream.head(min(left, HEAD))) is not None:
            left -= len(inner)
            length = _fields(inner).get("content-length", "")
        row = {"record_id": bare("warc-record-id"), "record_type": kind, "target_uri": bare("warc-target-uri"), "refers_to": bare("warc-refers-to"),
               "declared_bytes": int(length) if length and length.isdigit() else None, "declared_digest": _hex_digest(f.get("warc-payload-digest"))}
        sha, done, number = hashlib.sha1(), 0, 0
        while True:
            piece = stream.take(min(chunk, left))
            left -= len(piece)
            done += len(piece)
            sha.update(piece)
            yield row | {"chunk_no": number, "data": piece if data else None, "payload_bytes": done, "payload_digest": sha.hexdigest(), "last": not left}
            number += 1
            if not left:
                break
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def _reader(chunk: int, data: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
        schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in CHUNKS.split(", "))])
        held, size = [], 0
        for b in batches:
            for path in b.column("path").to_pylist():
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_stream(at, compression=None) as file:
                    for row in records_of(file, chunk, data):
                        held.append(row)
                        size += 500 + len(row["data"] or b"")
                        if size >= FLUSH:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)

    return run


def read_warc(archives: DataFrame, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunked record table of archives (a table with their ``path``):
    record_id and chunk_no identify a row.

    A payload streams as rows of at most ``chunk`` bytes (``data``; null if
    ``data`` is false), each with the bytes and the SHA-1 of the payload up to
    its end: the row marked ``last`` has those of the whole payload, so nothing
    has to gather a record.  The declared bytes and digest are those of the
    headers; for revisits, whose payload is elsewhere, they are the payload's.
    Each file is read from its start by one task; files are of bounded size.
    An empty payload is one empty chunk; a payload whose response has no
    header is the record's whole block; an archive that ends within a record
    fails the task.  Compressed and plain archives are read.
    """
    n = max(1, archives.count())
    paths = archives.select("path").repartition(n)
    return paths.mapInArrow(_reader(chunk, data), CHUNKS)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page its record, read back from the archives."""
    ends = read_warc(write_warc(table(spark, sf_dir, "pages")), data=False).where("last")
    revisit = F.col("record_type") == "revisit"
    return ends.select(
        page_of("record_id").alias("page_id"), F.when(revisit, F.col("declared_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type",
        F.when(revisit, page_of("refers_to")).alias("refers_to"))


OP11_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS digest, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {REVISIT_BYTES} AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {REVISIT_BYTES} AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM q
"""
