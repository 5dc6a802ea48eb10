"""WARC archives: a writer with one gzip member per record, and a sequential reader.

The reader holds one piece of input at a time: it decompresses member by member, takes the
block by its Content-Length, and checks block and payload digests. Archives are files in
a folder that all executors reach, opened through `pyarrow.fs` (local, HDFS or object stores).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.session import freeze, scratch_path

READ_BYTES = 1 << 18
PAYLOAD = "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, archive string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {date}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"Content-Type: {PAYLOAD}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str, date: str, batches):
    """Writes the task's rows as one archive; a task that runs again replaces the whole file."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    context = TaskContext.get()
    final = f"{base}/part-{context.partitionId():06d}.warc.gz"
    draft = f"{final}.{context.taskAttemptId()}.draft"
    out, count, size = None, 0, 0
    for batch in batches:
        for row in batch.to_pylist():
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(draft)
            html = (row["html"] or "").encode()
            member = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = member.compress(record(row["page_id"], row["url"], html, row["first"], row["revisit"], date)) + member.flush()
            out.write(data)
            count, size = count + 1, size + len(data)
    if out is not None:
        out.close()
        store.move(draft, final)
        name = f"{folder.rstrip('/')}/{final.rsplit('/', 1)[1]}"
        yield pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([count], pa.int64()), "bytes": pa.array([size], pa.int64())})


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives and returns their list: archive, records, bytes.

    Of records of equal payload those with the smallest id are responses, the others revisits of it.
    A null html is an empty payload. Rows without an id are responses and named by no other. Other columns are not
    read; an empty table writes nothing.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    body = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.sha2(body, 256).alias("same"))
    first = rows.groupBy("same").agg(F.min("page_id").alias("first"))
    typed = rows.join(first, "same").select("page_id", "url", "html", "first", F.coalesce(F.col("page_id") != F.col("first"), F.lit(False)).alias("revisit"))
    write = partial(_write, folder, date)
    written = typed.mapInArrow(lambda x: write(x), "archive string, records long, bytes long")
    # The list has a row per task; it goes to few files, as on a local file system each one makes the JVM start processes.
    return freeze(written.repartition(spark.sparkContext.defaultParallelism), "archives")


class _Stream:
    """The decompressed bytes of an archive, one gzip member after another."""

    def __init__(self, source):
        self.source, self.raw = source, b""
        self.member, self.ready = None, bytearray()

    def next_member(self) -> bool:
        """True if another member begins."""
        if not self.raw:
            self.raw = self.source.read(READ_BYTES)
        self.member, self.ready = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def more(self) -> bool:
        """Decompresses a little more of this member; False at its end."""
        while not self.member.eof:
            if not self.raw:
                self.raw = self.source.read(READ_BYTES)
                if not self.raw:
                    raise ValueError("archive ends inside a record")
            got = self.member.decompress(self.raw, READ_BYTES)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if got:
                self.ready += got
                return True
        return False

    def head(self) -> list[str]:
        """Lines up to the next empty one."""
        while (end := self.ready.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise ValueError("record without an end of its header")
        lines = bytes(self.ready[:end]).decode().split("\r\n")
        del self.ready[: end + 4]
        return lines

    def take(self, count: int):
        """Pieces that hold the next `count` bytes."""
        while count:
            if not self.ready and not self.more():
                raise ValueError("record shorter than its Content-Length")
            piece = bytes(self.ready[:count])
            del self.ready[:count]
            count -= len(piece)
            yield piece


def records(source, keep: bool):
    """Header, payload digest and length, and payload (if kept) of each record; wrong digests raise."""
    stream = _Stream(source)
    while stream.next_member():
        version, *fields = stream.head()
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in fields)}
        left = int(head["content-length"])
        block, payload, size, kept, lead = hashlib.sha1(), hashlib.sha1(), 0, [], bytearray()
        inside = not head.get("content-type", "").startswith("application/http")
        for piece in stream.take(left):
            block.update(piece)
            if not inside:
                lead += piece
                if (end := lead.find(b"\r\n\r\n")) < 0:
                    continue
                piece, inside = bytes(lead[end + 4:]), True
            payload.update(piece)
            size += len(piece)
            if keep:
                kept.append(piece)
        if b"".join(stream.take(4)) != b"\r\n\r\n" or stream.more() or stream.ready:
            raise ValueError("record does not end where its Content-Length says")
        checks = [("warc-block-digest", block)] + [("warc-payload-digest", payload)] * (head["warc-type"] != "revisit")
        for name, found in checks:
            if name in head and head[name] != "sha1:" + base64.b32encode(found.digest()).decode():
                raise ValueError(f"{name} of {head.get('warc-record-id')} does not match")
        yield head, size, b"".join(kept)


def _read(keep: bool, batches):
    from pyarrow import fs

    number = lambda x: int(x.rsplit(":", 1)[1].rstrip(">")) if x else None
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("archive", pa.string())])
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            store, path = fs.FileSystem.from_uri(archive)
            with store.open_input_stream(path, compression=None) as source:
                rows, held = [], 0
                for head, size, payload in records(source, keep):
                    rows.append((number(head.get("warc-record-id")), head.get("warc-target-uri"), head["warc-type"], number(head.get("warc-refers-to")), int(head.get("x-payload-length", size)), head["warc-payload-digest"].removeprefix("sha1:"), payload if keep else None, archive))
                    held += len(payload)
                    if len(rows) == 1000 or held > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_warc(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the listed archives (column `archive`), dealt in turn over the tasks, digests verified."""
    read = partial(_read, payloads)
    spark: SparkSession = archives.sparkSession
    spread = archives.select("archive").repartition(max(1, min(archives.count(), 4 * spark.sparkContext.defaultParallelism)))
    return spread.mapInArrow(lambda x: read(x), RECORDS)
