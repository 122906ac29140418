"""WARC archives as a chunked record table: records are written and read in pieces, never as a whole."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import lookup_join, replaced, written
from quern.session import scratch_dir

CHUNK = 1 << 18
#: A task begins another archive after this much payload.
ARCHIVE_BYTES = 1 << 28
#: Format fixed by the WARC 1.1 standard.
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
#: The first half of record ids made from page ids; the second half is the page id.
ID_SPACE = 0x7175_6572_6E00_4000


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that holds ``uri`` and the path in it, for any scheme that Arrow and the cluster share."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, digest: str) -> str:
    """A page's record id holds its page id; a page without one is named after its payload."""
    if page_id is None:
        return f"<{uuid.uuid5(uuid.NAMESPACE_URL, 'sha1:' + digest).urn}>"
    return f"<{uuid.UUID(int=(ID_SPACE << 64) | (page_id & ((1 << 64) - 1))).urn}>"


def base32(sha) -> str:
    return base64.b32encode(sha.digest()).decode()


def page_of(urn: str) -> int:
    low = uuid.UUID(urn.strip("<>")).int & ((1 << 64) - 1)
    return low - (1 << 64) if low >> 63 else low


def header_line(text: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def write_archives(typed: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``page_id, url, html, refers_to, is_response`` as archives below ``root``; returns the table of
    their names (``archive, records``). A task begins another archive after ``archive_bytes`` of payload.

    Each record is a gzip member of its own. A payload is hashed and then compressed in pieces of its Arrow buffer; only
    the names that finished tasks return count, so a task that is run again leaves a file that nobody reads.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        fs.create_dir(base, recursive=True)
        name, n, size, sink = "", 0, 0, None

        def closed() -> pa.RecordBatch:
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["archive", "records"])

        for b in batches:
            ids, urls, refers, first = (b.column(k).to_pylist() for k in (0, 1, 3, 4))
            for i, piece in enumerate(payloads(b.column(2))):
                if sink is None:
                    name, n, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = fs.open_output_stream(f"{base}/{name}", compression=None)
                write_record(sink, ids[i], urls[i], piece, refers[i], first[i])
                n += 1
                size += len(piece)
                if size >= archive_bytes:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    rows = typed.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), "refers_to", "is_response")
    return written(rows.mapInArrow(run, "archive string, records long"), "archives")


def payloads(column: pa.Array) -> Iterator[memoryview]:
    """The UTF-8 of each string where it lies in the Arrow buffer; nothing is copied."""
    bits = 8 if pa.types.is_large_string(column.type) else 4
    _, offsets, data = column.buffers()
    at = memoryview(offsets).cast("q" if bits == 8 else "i")[column.offset : column.offset + len(column) + 1] if offsets else [0] * (len(column) + 1)
    raw = memoryview(data) if data else memoryview(b"")
    valid = column.is_valid()
    for i in range(len(column)):
        yield raw[at[i] : at[i + 1]] if valid[i].as_py() else raw[:0]


def pieces_of(payload: memoryview) -> Iterator[memoryview]:
    for at in range(0, len(payload), CHUNK):
        yield payload[at : at + CHUNK]


def write_record(sink, page_id: int | None, url: str | None, payload: memoryview, refers_to: int | None, response: bool) -> None:
    sha = hashlib.sha1()
    for piece in pieces_of(payload):
        sha.update(piece)
    digest = base32(sha)
    head = [
        ("WARC-Type", "response" if response else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", NO_DATE),
        ("WARC-Target-URI", header_line(url or "")),
        ("WARC-Payload-Digest", "sha1:" + digest),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if not response:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    head.append(("Content-Length", str(len(payload) if response else 0)))
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    sink.write(gz.compress(VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"))
    if response:
        for piece in pieces_of(payload):
            sink.write(gz.compress(piece))
    sink.write(gz.compress(END) + gz.flush())


class Unzipped:
    """The bytes of a file of gzip members, a piece at a time."""

    def __init__(self, stream):
        self.stream, self.held, self.rest = stream, bytearray(), b""
        self.gz = zlib.decompressobj(31)
        self.over = False

    def fill(self) -> None:
        if not self.rest:
            self.rest = self.stream.read(CHUNK)
            if not self.rest:
                self.over = True
                return
        self.held += self.gz.decompress(self.rest, CHUNK)
        self.rest = self.gz.unconsumed_tail
        if self.gz.eof:
            self.rest = self.gz.unused_data
            self.gz = zlib.decompressobj(31)

    def until(self, mark: bytes) -> bytes:
        """Up to and with ``mark``; nothing at the end of the file."""
        while (at := self.held.find(mark)) < 0:
            if self.over:
                if self.held:
                    raise ValueError("the archive ends inside a record")
                return b""
            self.fill()
        out = bytes(self.held[: at + len(mark)])
        del self.held[: at + len(mark)]
        return out

    def some(self, most: int) -> bytes:
        while not self.held:
            if self.over:
                raise ValueError("the archive ends inside a payload")
            self.fill()
        out = bytes(self.held[:most])
        del self.held[: len(out)]
        return out


CHUNKS = (
    "archive string, record_no long, record_id string, page_id long, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, chunk_no int, chunk_bytes long, running_digest string, last boolean"
)


def read_chunks(archives: DataFrame, root: str, data: bool = False, chunk: int = CHUNK) -> DataFrame:
    """The records of archives as rows of record and chunk number, each with the digest of the payload up to its end.

    A payload comes in chunks of at most ``chunk`` bytes (``data`` adds them in a column of that name); a record without payload has
    one chunk of none. The last chunk's running digest is checked against the record's; ``payload_bytes`` and
    ``payload_digest`` of a revisit are those of the payload it stands for. Archives are dealt out over the tasks.
    """
    schema = CHUNKS + (", chunk binary" if data else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for row in records(Unzipped(stream), name, data, chunk):
                        rows.append(row)
                        size += row[9]
                        if len(rows) >= 2048 or data and size >= 16 * chunk:
                            yield batch(rows)
                            rows, size = [], 0
                yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]
    types += [pa.binary()] * data
    names = [x.split()[0] for x in schema.split(", ")]
    # A name is a few bytes, so the engine would put all of them into one task unless it is told their number.
    n = archives.count()
    return archives.select("archive").repartition(max(1, n), "archive").mapInArrow(run, schema)


def records(source: Unzipped, archive: str, data: bool, chunk: int = CHUNK) -> Iterator[tuple]:
    no = 0
    while head := source.until(END):
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"{archive}: a record starts with {lines[0][:40]!r}")
        fields = dict(x.split(": ", 1) for x in lines[1:] if x)
        kind = fields["WARC-Type"]
        page = int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None
        refers = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        fixed = (archive, no, fields["WARC-Record-ID"], page, kind, refers, int(fields["X-Payload-Length"]), digest)
        left, k, sha = int(fields["Content-Length"]), 0, hashlib.sha1()
        while True:
            piece = source.some(min(left, chunk)) if left else b""
            sha.update(piece)
            left -= len(piece)
            if not left and kind == "response" and base32(sha) != digest:
                raise ValueError(f"{archive}, record {no}: the payload has another digest")
            yield *fixed, k, len(piece), base32(sha), not left, *([piece] if data else [])
            k += 1
            if not left:
                break
        if source.until(END) != END:
            raise ValueError(f"{archive}, record {no}: no end after the payload")
        no += 1


def typed_pages(pages: DataFrame) -> DataFrame:
    """Add ``is_response`` and ``refers_to``: of equal payloads that of the largest ``page_id`` is the response.

    Payloads are told apart by SHA-1 and length. Digests are grouped with a partial maximum in each task first, and a
    payload that many pages share is looked up by broadcast.
    """
    html = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    base = replaced(pages, ["is_response", "refers_to"]).withColumn("_q_sha", F.concat(F.sha1(html), F.hex(F.octet_length(html))))
    largest = written(base.groupBy("_q_sha").agg(F.max("page_id").alias("_q_top")), "largest")
    out = lookup_join(base, largest, ["_q_sha"])
    first = F.col("page_id").eqNullSafe(F.col("_q_top"))
    return out.withColumns({"is_response": first, "refers_to": F.when(~first, F.col("_q_top"))}).drop("_q_sha", "_q_top")


def archive_pages(pages: DataFrame, root: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> tuple[DataFrame, str]:
    """Write a record per page below ``root`` (a new scratch folder by default); the archives' names and the folder.

    Columns read: ``page_id, url, html``. Null html is the empty payload. Rows that repeat the largest page id are
    responses each. A null page id is never the largest: such a page is a response only if no page with an id has its
    payload. An empty table gives no archive.
    """
    root = root or scratch_dir(pages.sparkSession, "warc")
    return write_archives(typed_pages(pages), root, archive_bytes), root


def read_pages(archives: DataFrame, root: str) -> DataFrame:
    """One row per record from the chunks: ``page_id, payload_bytes, payload_digest, record_type, refers_to, n_chunks``.

    Size and digest of a response are those of its chunks as read: the sum of their sizes and the last running digest.
    """
    chunks = read_chunks(archives, root)
    by = ["archive", "record_no", "record_id", "page_id", "record_type", "refers_to"]
    read = chunks.groupBy(*by).agg(
        F.sum("chunk_bytes").alias("_q_bytes"), F.max(F.when(F.col("last"), F.col("running_digest"))).alias("_q_digest"),
        F.count("*").alias("n_chunks"), F.first("payload_bytes").alias("_q_said"), F.first("payload_digest").alias("_q_said_digest"),
    )
    whole = F.col("record_type") == "response"
    return read.select(
        "page_id",
        F.when(whole, F.col("_q_bytes")).otherwise(F.col("_q_said")).alias("payload_bytes"),
        F.when(whole, F.col("_q_digest")).otherwise(F.col("_q_said_digest")).alias("payload_digest"),
        "record_type", "refers_to", "n_chunks",
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, html, CAST(strlen(html) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS top,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31 AS INT), 1)), '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""
