"""WARC archives: writing pages as records, one gzip member each, and reading archives back in sequence.

Archives are written by tasks into a shared folder and read from it through the file system that the folder's URI
names. A writer's table of files is kept, so that files of failed or repeated attempts are never read.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import pages, text_of, written
from tidemark.session import work_dir

#: Payloads below this many bytes are never written as revisits.
MIN_REVISIT = 0
#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 18
LEVEL = 4
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = b"\r\n"


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _named(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page_of(name: str | None) -> int | None:
    tail = (name or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail else None


def _http(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None, revisit: bool, date: str) -> bytes:
    """One record as a gzip member. A revisit holds the HTTP head alone; digest and length are those of the payload."""
    block = _http(payload) if revisit else _http(payload) + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_named(page_id)}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", f"<{_named(original)}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(_CRLF * 2) + packer.flush()


class Damaged(ValueError):
    """An archive that does not follow the format, or whose bytes do not match a digest."""


class _Member:
    """The bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, source: BinaryIO, ahead: bytes):
        self.source, self.ahead, self.ready = source, ahead, b""
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        if not self.ahead:
            self.ahead = self.source.read(CHUNK)
            if not self.ahead:
                raise Damaged("the archive ends inside a record")
        self.ready += self.inflate.decompress(self.ahead, CHUNK)
        self.ahead = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def line(self) -> bytes:
        while (end := self.ready.find(_CRLF)) < 0:
            if not self._more():
                raise Damaged("a record's head has no end")
        line, self.ready = self.ready[:end], self.ready[end + 2 :]
        return line

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self._more():
                raise Damaged("a record is shorter than its Content-Length")
            part, self.ready = self.ready[:n], self.ready[n:]
            n -= len(part)
            yield part

    def rest(self) -> bytes:
        while self._more():
            if len(self.ready) > 2 * CHUNK:
                raise Damaged("a record is longer than its Content-Length")
        return self.ready


def read_records(source: BinaryIO) -> Iterator[dict]:
    """The records of an archive in order: `headers` (names in lower case), `http` head lines and `payload`.

    One record is in memory at a time, inflated by chunks. Content-Length frames the block, and block and payload
    are held against their digests as they arrive; `Damaged` is raised where they differ. Of a revisit the payload
    is empty and its digest is that of the original, so only the block is verified.
    """
    ahead = source.read(CHUNK)
    while ahead:
        member = _Member(source, ahead)
        if not member.line().startswith(b"WARC/1."):
            raise Damaged("no WARC version line")
        headers = {}
        while line := member.line():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        whole, body, head = hashlib.sha1(), hashlib.sha1(), b""
        payload, in_body = [], False
        for part in member.exactly(int(headers["content-length"])):
            whole.update(part)
            if not in_body:
                head += part
                at = head.find(_CRLF * 2)
                if at < 0:
                    continue
                head, part, in_body = head[:at], head[at + 4 :], True
            body.update(part)
            payload.append(part)
        if member.rest() != _CRLF * 2:
            raise Damaged("a record is not followed by two line ends")
        _verify(headers, "warc-block-digest", whole)
        if headers.get("warc-type") == "response":
            _verify(headers, "warc-payload-digest", body)
        yield {"headers": headers, "http": head.decode("latin-1").split("\r\n"), "payload": b"".join(payload)}
        ahead = member.ahead or source.read(CHUNK)


def _verify(headers: dict, name: str, found) -> None:
    if name in headers and headers[name].rpartition(":")[2] != base64.b32encode(found.digest()).decode():
        raise Damaged(f"{name} of {headers.get('warc-record-id')} does not match")


def _opened(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def originals(rows: DataFrame, page_id: str, payload: str) -> DataFrame:
    """(digest, original): for each payload that several rows share, its digest and largest page id.

    Ids and digests alone are shuffled, combined in each task. The result has a row per shared payload.
    """
    counted = rows.groupBy(F.sha1(F.col(payload).cast("binary")).alias("digest")).agg(
        F.max(page_id).alias("original"), F.count(F.lit(1)).alias("n")
    )
    return counted.where("n > 1").select("digest", "original")


def write_archives(
    docs: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record per row into archives below `folder`, an URI that all executors reach; (file, records, bytes) of each.

    Among rows of equal payloads of `min_revisit` bytes or more, the one with the largest page id is a response and
    the others are revisits of it. A null html is an empty payload; a null page id is smaller than any other. Rows
    that repeat the largest id with the same payload are responses too: none of them could name another. Each task
    writes its rows in sequence under names of its own; a name counts once its task has ended.
    """
    rows = docs.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), text_of(html).alias("html"))
    shared = written(originals(rows, "page_id", "html"), "shared")
    joined = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).join(shared, "digest", "left").drop("digest")
    date = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        files, base = _opened(folder)
        files.create_dir(base, recursive=True)
        out, name, records, size = None, "", 0, 0
        closed = []
        try:
            for batch in batches:
                for page, address, text, original in zip(*(batch.column(i) for i in range(4))):
                    payload, page, original = text.as_py().encode(), page.as_py(), original.as_py()
                    revisit = original is not None and original != page and len(payload) >= min_revisit
                    data = record(page, address.as_py(), payload, original, revisit, date)
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(data)
                    records, size = records + 1, size + len(data)
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        closed.append((name, records, size))
        finally:
            if out is not None:
                out.close()
                closed.append((name, records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in closed], pa.string()), pa.array([x[1] for x in closed], pa.int64()), pa.array([x[2] for x in closed], pa.int64())],
            names=["file", "records", "bytes"],
        )

    return written(joined.select("page_id", "url", "html", "original").mapInArrow(run, "file string, records long, bytes long"), "archives")


#: Tasks that read archives, at most; beyond it a task reads several, one after the other.
MAX_READERS = 20_000


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and
    with `payloads` the payload itself (null for revisits).

    An archive is read by one task from start to end. `payload_bytes` is the length that the record's HTTP head
    states, which for a response is held against its payload.
    """

    def run(batches):
        files, base = _opened(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows: list[tuple] = []
                held = 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for found in read_records(source):
                        rows.append(_row(found))
                        held += len(found["payload"])
                        if not payloads:
                            rows[-1] = (*rows[-1][:-1], None)
                        if held > 8 * CHUNK or len(rows) >= 5000:
                            yield _batch(rows, payloads)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, payloads)

    names = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # about one archive to a task: a stated number of partitions is not merged into fewer, however short the names are
    spread = archives.select("file").repartitionByRange(max(1, min(archives.count(), MAX_READERS)), "file")
    return spread.mapInArrow(run, names + (", payload binary" if payloads else ""))


def _row(found: dict) -> tuple:
    headers = found["headers"]
    stated = next(int(x.split(":")[1]) for x in found["http"] if x.lower().startswith("content-length:"))
    kind = headers["warc-type"]
    if kind == "response" and stated != len(found["payload"]):
        raise Damaged(f"the payload of {headers.get('warc-record-id')} has not the stated length")
    return (
        _page_of(headers["warc-record-id"]), headers["warc-target-uri"], stated,
        headers["warc-payload-digest"].rpartition(":")[2], kind, _page_of(headers.get("warc-refers-to")),
        found["payload"] if kind == "response" else None,
    )


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    n = len(kinds) if payloads else len(kinds) - 1
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(columns[i], kinds[i]) for i in range(n)], names=names[:n])


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Whole `pages`, written and read back."""
    folder = work_dir(spark, "llm-warc")
    archives = write_archives(pages(spark, sf_dir), folder)
    return read_archives(archives, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP9_SQL = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
spread AS (
  SELECT page_id, hex, unnest(range(32)) AS i FROM hashed),
digits AS (
  -- base32: digit i is bits 5i to 5i + 4 of the 160; two bytes hold them
  SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    ((CAST('0x' || substr(hex || '00', 1 + 2 * ((5 * i) // 8), 4) AS BIGINT) >> (11 - (5 * i) % 8)) & 31) AS BIGINT), 1), ''
    ORDER BY i) AS payload_digest
  FROM spread GROUP BY page_id),
tops AS (SELECT hex, max(page_id) AS top FROM hashed GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM hashed JOIN digits USING (page_id) JOIN tops USING (hex)
"""
