"""WARC archives with revisit resolution.

Where pages are read, payloads are spooled to the shared folder, compressed, and only their
headers go on: page_id, url, payload digest, length and the place in the spool.  Headers
are shuffled by digest and reduced to the smallest page_id of each digest that occurs more
than once; each header is joined to that, and becomes a ``response`` or a ``revisit`` that
refers to the original response.  Resolved headers, ranged by spool and place, are written
with fresh headers of their own: a new record id, the digest, the length, a fixed date; a
response takes its payload from the spool, a revisit none.  So no payload is ever shuffled,
whatever the number of revisits.  Every record is a gzip member.  Archives hold at most
``file_bytes`` of payload each; a task writes about ``task_bytes`` of spool.

A hot payload (one digest with a third of all pages) meets its row of the reduced table
where its headers are (``join_hot_apart``), and the reduction combines before it shuffles.

Cases: a null html is the empty payload; payloads smaller than ``min_bytes`` are all
responses; rows that repeat the smallest page_id of a payload are responses too, and so
are rows without page_id (nothing can refer to them); a null url leaves its header out;
line ends in a url are escaped; an archive that ends inside a record raises EOFError when
it is read; an empty table gives no archive; extra columns are dropped.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow.llm._shared import _in_store, bounded_batches, join_hot_apart, opened, read_table, staged, workspace, written_once

#: Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


HEADERS = "page_id long, url string, digest string, bytes long, spool string, at long, length long"


def _spooled(folder: str):
    """Arrow batches of (page_id, url, html) to HEADERS; payloads to a file of the task's own attempt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, at, out = f"{folder}/{uuid.uuid4().hex}.spool", 0, None
        for batch in batches:
            if out is None:
                store, path = opened(uri)
                store.create_dir(os.path.dirname(path), recursive=True)
                out = store.open_output_stream(path)
            digest, size, place, length = [], [], [], []
            for html in batch.column(2):
                payload = html.as_buffer().to_pybytes()
                digest.append(base32_sha1(payload))
                size.append(len(payload))
                data = zlib.compress(payload, 1)
                out.write(data)
                place.append(at)
                length.append(len(data))
                at += len(data)
            columns = [pa.array(digest, pa.string()), pa.array(size, pa.int64()), pa.array([uri] * len(size), pa.string()), pa.array(place, pa.int64()), pa.array(length, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["page_id", "url", "digest", "bytes", "spool", "at", "length"])
        if out is not None:
            out.close()

    return run


def resolved(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """HEADERS with refers_to, null for responses."""
    originals = headers.where((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1")
    originals = staged(originals, "originals")
    refers = F.when((F.col("page_id") != F.col("original")) & (F.col("bytes") >= min_bytes), F.col("original"))
    return join_hot_apart(headers, originals, "digest", "n", headers.count(), "left").select(*headers.columns, refers.alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _archives(folder: str, file_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, out, held, uri = TaskContext.get().partitionId(), [], None, None

        def payload(spool: str, at: int, length: int) -> bytes:
            nonlocal held, uri
            if spool != uri:
                store, path = opened(spool)
                held, uri = store.open_input_file(path), spool
            held.seek(at)
            return zlib.decompress(held.read(length))

        todo = (row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(8))))
        row = next(todo, None)
        while row is not None:
            archive, size, n = f"{folder}/{task:06d}-{len(out):05d}.warc.gz", 0, 0
            with written_once(archive) as f:
                while row is not None and (not n or size < file_bytes):
                    page_id, url, digest, bytes_, spool, at, length, refers_to = row
                    gz = zlib.compressobj(1, wbits=31)
                    f.write(gz.compress(record(page_id, url, b"" if refers_to is not None else payload(spool, at, length), digest, bytes_, refers_to, date)) + gz.flush())
                    size, n, row = size + bytes_, n + 1, next(todo, None)
            out.append((archive, n))
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], names=["uri", "records"])

    return run


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = 256 << 20, date: str = "2024-01-01T00:00:00Z", task_bytes: int = 64 << 20) -> DataFrame:
    """Write deduplicated archives of pages (page_id, url, html) under folder; returns their manifest: uri, records."""
    spark, spool = pages.sparkSession, workspace(pages.sparkSession, "spool")
    bounded_batches(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    headers = staged(rows.mapInArrow(_spooled(spool), HEADERS), "warc-headers")
    total = headers.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(-(-total // task_bytes), min(headers.count(), spark.sparkContext.defaultParallelism), 1)
    ordered = resolved(headers, min_bytes).repartitionByRange(tasks, "spool", "at").sortWithinPartitions("spool", "at")
    manifest = staged(ordered.mapInArrow(_archives(folder, file_bytes, date), "uri string, records long"), "warc-manifest")
    store, path = _in_store(spark, spool)
    store.delete(path, True)
    return manifest


class _Unzipped:
    """Reads through the members of a gzip stream (or a plain one), a chunk at a time."""

    def __init__(self, raw, chunk: int = 1 << 20):
        self.raw, self.chunk, self.buffer, self.gz = raw, chunk, b"", None
        self.pending = raw.read(chunk)
        self.plain = self.pending[:2] != b"\x1f\x8b"

    def _more(self) -> bool:
        if not self.pending:
            self.pending = self.raw.read(self.chunk)
            if not self.pending:
                return False
        if self.plain:
            self.buffer, self.pending = self.buffer + self.pending, b""
            return True
        self.gz = self.gz or zlib.decompressobj(31)
        self.buffer += self.gz.decompress(self.pending)
        self.pending = self.gz.unused_data if self.gz.eof else b""
        if self.gz.eof:
            self.gz = None
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                return None
        out, self.buffer = self.buffer[:at], self.buffer[at + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise EOFError("an archive ends inside a record")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out


def records(raw) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive."""
    stream = _Unzipped(raw)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n") if ": " in line)
        fields = {k.lower(): v for k, v in fields.items()}
        yield fields, stream.take(int(fields["content-length"]))
        stream.take(4)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda v: None if v is None else int(v)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            store, path = opened(uri)
            rows, held = [], 0
            with store.open_input_file(path) as raw:
                for h, block in records(raw):
                    if h["warc-type"] == "response":
                        payload = block.split(b"\r\n\r\n", 1)[1]
                        size, digest = len(payload), base32_sha1(payload)
                    else:
                        payload, size, digest = None, int(h["x-payload-length"]), h["warc-payload-digest"].removeprefix("sha1:")
                    rows.append((number(h.get("x-page-id")), h.get("warc-target-uri"), size, digest, h["warc-type"], number(h.get("x-refers-to-page")), payload))
                    held += len(block)
                    if held > 8 << 20:
                        yield packed(rows)
                        rows, held = [], 0
            if rows:
                yield packed(rows)


def read_warc(manifest: DataFrame) -> DataFrame:
    """A row for each record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for
    revisits).  Responses are measured and digested anew, revisits state what their headers say."""
    files = manifest.select("uri")
    return files.repartition(max(1, files.count())).mapInArrow(_read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_warc(read_table(spark, sf_dir, "pages"), workspace(spark, "warc"))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op8_warc_revisits": op8_warc_revisits}
_digits = ", ".join(f"substr('{BASE32}', cast((cast('0x' || substr(h, {10 * g + 1}, 10) as bigint) >> {35 - 5 * j}) & 31 as integer) + 1, 1)" for g in range(4) for j in range(8))
SQL = {
    "op8_warc_revisits": f"""
with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as h from pages),
o as (select *, min(page_id) over (partition by h) as original from p)
select page_id, cast(n as bigint) as payload_bytes, concat({_digits}) as payload_digest,
  case when page_id <> original then 'revisit' else 'response' end as record_type, case when page_id <> original then original end as refers_to
from o
"""
}
