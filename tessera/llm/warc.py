"""WARC archives as a chunked record table.

Payloads travel as rows (record, chunk number, bytes) of bounded size between
Spark and the archives. The writer streams the chunks of a record into a gzip
member; the reader streams an archive back into chunk rows, each carrying the
payload bytes and SHA-1 so far, so neither side ever allocates a record.
Equal payloads are stored once: one record is the response, the others are
revisits that name it.

Each writing task attempt creates archives of its own name, and only those in
the manifest that Spark commits are read: attempts that were lost or run twice
leave files that nobody looks at.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import column_of, staged
from tessera.session import staging_path

CHUNK_BYTES = 1 << 16
ARCHIVE_BYTES = 256 << 20

_CHUNKS = "page_id long, url string, hex string, length long, refers_to long, chunk int, data binary"
_READ = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("chunk", pa.int32()),
    ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_()),
])


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def record_uri(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _head(row: dict, block: int, http: bytes) -> bytes:
    """The WARC header of a record whose block has ``block`` bytes."""
    revisit = row["refers_to"] is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(row['page_id'])}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%20" for c in row["url"]))
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if revisit:
        lines += [f"WARC-Refers-To: {record_uri(row['refers_to'])}", f"X-Refers-To-Page-ID: {row['refers_to']}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(row['hex']))}", f"X-Payload-Length: {row['length']}", "Content-Type: application/http;msgtype=response", f"Content-Length: {block}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Writer:
    """Archives of one task attempt, one gzip member per record."""

    def __init__(self, folder: str):
        self.fs, self.folder = _filesystem(folder)
        self.stream, self.done, self.open_member = None, [], None

    def _roll(self) -> None:
        if self.stream is not None and self.stream.tell() >= ARCHIVE_BYTES:
            self.close_archive()
        if self.stream is None:
            self.fs.create_dir(self.folder, recursive=True)
            self.path, self.records = f"{self.folder}/{uuid.uuid4().hex}.warc.gz", 0
            self.stream = self.fs.open_output_stream(self.path, compression=None)

    def begin(self, row: dict) -> None:
        self._roll()
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['length']}\r\n\r\n".encode()
        block = len(http) + (row["length"] if row["refers_to"] is None else 0)
        self.open_member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.records += 1
        self.write(_head(row, block, http))

    def write(self, data: bytes) -> None:
        self.stream.write(self.open_member.compress(data))

    def end(self) -> None:
        if self.open_member is not None:
            self.write(b"\r\n\r\n")
            self.stream.write(self.open_member.flush())
            self.open_member = None

    def close_archive(self) -> None:
        if self.stream is not None:
            size = self.stream.tell()
            self.stream.close()
            self.done.append((self.path, self.records, size))
            self.stream = None


def classified(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages with payload, SHA-1 (hex), length and refers_to: of records with
    equal payloads of at least ``least`` bytes the largest id is the response."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    src = src.withColumns({"hex": F.sha1("payload"), "length": F.octet_length("payload").cast("long")})
    top = src.groupBy("hex", "length").agg(F.max("page_id").alias("top"))
    refers = F.when((F.col("length") >= least) & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    return src.join(top, ["hex", "length"]).withColumn("refers_to", refers).drop("top")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write ``classified`` records under ``folder``; the manifest
    (path, records, bytes) of the archives that were committed."""
    stored = F.col("refers_to").isNull()
    chunks = F.when(stored, F.greatest(F.ceil(F.col("length") / CHUNK_BYTES), F.lit(1))).otherwise(1).cast("int")
    rows = records.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    data = F.when(stored, F.substring(F.col("payload"), F.col("chunk") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)))
    rows = rows.select("page_id", "url", "hex", "length", "refers_to", "chunk", data.alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Writer(folder)
        for b in batches:
            names = b.schema.names
            for values in zip(*(c.to_pylist() for c in b.columns)):
                row = dict(zip(names, values))
                if row["chunk"] == 0:  # the chunks of a record follow each other
                    out.end()
                    out.begin(row)
                out.write(row["data"] or b"")
        out.end()
        out.close_archive()
        cols = list(zip(*out.done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["path", "records", "bytes"])

    return staged(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


class _Inflated:
    """Reads the gzip members of an archive as one stream of bytes."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.data, self.member = stream, size, b"", zlib.decompressobj(31)

    def _more(self) -> bool:
        raw = self.member.unconsumed_tail
        if self.member.eof:
            raw, self.member = self.member.unused_data, zlib.decompressobj(31)
        raw = raw or self.stream.read(self.size)
        out = self.member.decompress(raw, self.size)  # without input: what is still pending
        self.data += out
        return bool(raw or out)

    def until(self, mark: bytes) -> bytes | None:
        while (i := self.data.find(mark)) < 0:
            if not self._more():
                if self.data:
                    raise ValueError("an archive ends inside a header")
                return None
        out, self.data = self.data[:i], self.data[i + len(mark) :]
        return out

    def take(self, most: int) -> bytes:
        while not self.data:
            if not self._more():
                raise ValueError("an archive ends inside a block")
        out, self.data = self.data[:most], self.data[most:]
        return out


def _records(stream, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    """Chunk rows of an archive, in _READ's columns."""
    src = _Inflated(stream, chunk_bytes)
    while (head := src.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        kind, declared = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        page = fields.get("X-Page-ID")
        who = (fields["WARC-Record-ID"], kind, page and int(page))
        left = int(fields["Content-Length"])
        left -= len(src.until(b"\r\n\r\n")) + 4  # the HTTP header
        if kind == "revisit":
            yield (*who, int(fields["X-Refers-To-Page-ID"]), 0, None, int(fields["X-Payload-Length"]), declared, True)
        else:
            digest, n, total = hashlib.sha1(), 0, left
            while True:
                parts, size = [], min(chunk_bytes, left)
                while size:
                    parts.append(src.take(size))
                    size -= len(parts[-1])
                data = b"".join(parts)
                left -= len(data)
                digest.update(data)
                so_far = base32(digest.digest())  # of a copy of the state
                if not left and (so_far != declared or total != int(fields["X-Payload-Length"])):
                    raise ValueError(f"{who[0]}: the payload does not match its digest")
                yield (*who, None, n, data if with_data else None, total - left, so_far, not left)
                n += 1
                if not left:
                    break
        tail = b""
        while len(tail) < 4:
            tail += src.take(4 - len(tail))


def read_archives(spark: SparkSession, manifest: DataFrame, with_data: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of all archives in a manifest: record_id, record_type,
    page_id, refers_to, chunk, data, bytes_so_far, digest_so_far, last.

    Payload digests are checked while reading; a mismatch raises."""
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in column_of(b, "path").to_pylist():
                fs, name = _filesystem(path)
                held: list[tuple] = []
                with fs.open_input_stream(name, compression=None) as stream:
                    for row in _records(stream, chunk_bytes, with_data):
                        held.append(row)
                        if len(held) >= (16 if with_data else 4096):
                            yield _batch(held)
                            held = []
                if held:
                    yield _batch(held)

    return manifest.select("path").repartition(n).mapInArrow(run, "record_id string, record_type string, page_id long, refers_to long, chunk int, data binary, bytes_so_far long, digest_so_far string, last boolean")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)


def archive_round_trip(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write all pages to archives, read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, one row per page row.

    Null html is an empty payload and null urls are left out of the record.
    Repeated rows keep a record each; those that share the largest id of a
    payload are all responses. A null id is a revisit of the payload's largest
    id, or a response where it has none. An empty table writes no archive."""
    spark = pages.sparkSession
    manifest = write_archives(classified(pages, least), folder or staging_path(spark, "llm-warc"))
    read = read_archives(spark, manifest, with_data=False)
    return read.where("last").select("page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to")
