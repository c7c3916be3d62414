"""WARC archives: writing, normalising of monolithic gzip files, and reading by offset.

An archive compressed as one gzip stream can only be read from its start. ``normalize``
inflates such a stream once, in pieces, rewrites every record as a gzip member of its own and
writes an index file beside the archive: a line a record with offset, length, type and id.
``read`` cuts the members out by these offsets. A task holds one record at a time when
it reads and some pieces of a stream when it rewrites, whatever the size of the archive.

Files are written by tasks to the folder given, under names that no other attempt uses; a table
names the files of the attempts that ended well, and only these are read. So a lost executor
costs a repeated task and leaves at most an unused file.

Of records with equal payloads of at least ``LEAST`` bytes, that with the largest page id is the
response, the others revisit it; smaller ones are all responses.

Defined results: a null html is an empty payload; rows that tie for the largest id are
all responses; a null page id counts as smaller than any other, among null ids alone all are
responses; a null url is left to the record's id; an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import batches, open_input, open_output, use_workers
from hourgrid.session import materialize, scratch_path

LEAST = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 20
MANIFEST = "path string, index string, records long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


# --- records ------------------------------------------------------------------------

def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = record_id(page_id)
    target = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url is not None else name[1:-1]
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if url is None:
        head.append("X-No-URI: true")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:] if ":" in line)}


class Inflated:
    """A gzip file (of one stream or of several members) as a stream of bytes."""

    def __init__(self, source, piece: int = PIECE):
        self.source, self.piece, self.buffer = source, piece, bytearray()
        self.machine, self.fresh, self.ended = zlib.decompressobj(31), True, False

    def _more(self) -> bool:
        raw = self.machine.unconsumed_tail or (self.machine.unused_data if self.machine.eof else b"") or self.source.read(self.piece)
        if not raw:
            if not self.fresh and not self.machine.eof:
                raise ValueError("the gzip stream breaks off")
            self.ended = True
            return False
        if self.machine.eof:
            self.machine = zlib.decompressobj(31)
        self.fresh = False
        self.buffer += self.machine.decompress(raw, self.piece)
        return True

    def head(self) -> bytes | None:
        """Up to the next blank line; None at the end."""
        seen = 0
        while (at := self.buffer.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(self.buffer) - 3)
            if not self._more():
                if self.buffer:
                    raise ValueError("the archive ends within a header")
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[: at + 4]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends within a record")
            part = bytes(self.buffer[:n])
            del self.buffer[:n]
            n -= len(part)
            if part:
                yield part


def rewrite(source, sink, level: int = 6) -> Iterator[tuple[int, int, str, str]]:
    """Copy records, each as its own member; (offset, length, type, id) of each."""
    stream, offset = Inflated(source), 0
    while (head := stream.head()) is not None:
        fields = headers(head)
        machine = zlib.compressobj(level, zlib.DEFLATED, 31)
        size = 0
        for part in chain((head + b"\r\n\r\n",), _bodies(stream, int(fields["content-length"]))):
            raw = machine.compress(part)
            size += sink.write(raw) if raw else 0
        size += sink.write(machine.flush())
        yield offset, size, fields.get("warc-type", ""), fields.get("warc-record-id", "")
        offset += size


def _bodies(stream: Inflated, length: int) -> Iterator[bytes]:
    yield from stream.take(length)
    if b"".join(stream.take(4)) != b"\r\n\r\n":
        raise ValueError("a record does not end with two line ends")
    yield b"\r\n\r\n"


def parse(member: bytes) -> tuple:
    """The columns of ``RECORD`` from one member; a response's digest is checked against its payload."""
    raw = zlib.decompress(member, 31)
    at = raw.index(b"\r\n\r\n")
    fields, block = headers(raw[:at]), raw[at + 4: -4]
    cut = block.index(b"\r\n\r\n")
    http, payload = block[:cut].decode("latin-1"), block[cut + 4:]
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = fields["warc-type"]
    if kind == "response":
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"digest of {fields['warc-record-id']} does not fit its payload")
    else:
        size, payload = int(re.search(r"(?i)\r\nContent-Length: *(\d+)", http)[1]), None
    url = None if "x-no-uri" in fields else fields["warc-target-uri"]
    return page_of(fields["warc-record-id"]), url, size, digest, kind, page_of(fields.get("warc-refers-to")), payload


# --- tables -------------------------------------------------------------------------

def _name(folder: str, kind: str) -> str:
    context = TaskContext.get()
    return f"{folder}/{kind}-{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex}.warc.gz"


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, refers_to): what each page's record is.

    The largest id of each repeated payload is found by digest with partial aggregation and written; it
    is joined to the pages by digest, so the planner may broadcast it when its files are small.
    """
    use_workers(pages.sparkSession)
    payload = F.encode(F.coalesce(pages[html_col], F.lit("")), "UTF-8")
    given = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    large = F.octet_length("payload") >= least
    keyed = given.select("*", F.when(large, F.sha1("payload")).alias("digest"), F.octet_length("payload").alias("size"))
    leaders = materialize(
        keyed.filter(large).groupBy("digest", "size").agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "leaders",
    )
    first = F.when(F.coalesce(F.col("page_id") < F.col("leader"), F.col("leader").isNotNull()), F.col("leader"))
    return keyed.join(leaders, ["digest", "size"], "left").select("page_id", "url", "payload", first.alias("refers_to"))


def write_monolithic(decided: DataFrame, folder: str, level: int = 6, date: str = DATE) -> DataFrame:
    """One archive a partition, compressed as a whole; the table of archives."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, sink, count, machine = _name(folder, "whole"), None, 0, zlib.compressobj(level, zlib.DEFLATED, 31)
        for batch in batches(rows, 256):
            sink = sink or open_output(path)
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if raw := machine.compress(record(*row, date)):
                    sink.write(raw)
                count += 1
        if sink:
            sink.write(machine.flush())
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([None], pa.string()), pa.array([count], pa.int64())], names=["path", "index", "records"])

    return _committed(decided.select("page_id", "url", "payload", "refers_to").mapInArrow(run, MANIFEST))


def _committed(manifest: DataFrame) -> DataFrame:
    written = materialize(manifest, "archives")
    return written.repartition(max(1, written.count()))


def normalize(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Archives with a member a record, each with its index file; the table of them."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for source_path in batch.column(0).to_pylist():
                path = _name(folder, "members")
                with open_input(source_path) as source, open_output(path) as sink, open_output(f"{path}.idx") as index:
                    count = 0
                    for entry in rewrite(source, sink, level):
                        index.write("\t".join(map(str, entry)).encode() + b"\n")
                        count += 1
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([f"{path}.idx"]), pa.array([count], pa.int64())], names=["path", "index", "records"])

    return _committed(archives.mapInArrow(run, MANIFEST))


def read_index(archives: DataFrame) -> DataFrame:
    """(path, offset, length, record_type, record_id) of all records."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for entries in _entries(index):
                    columns = list(zip(*entries))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(entries)), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2]), pa.array(columns[3])],
                        names=["path", "offset", "length", "record_type", "record_id"],
                    )

    return archives.mapInArrow(run, "path string, offset long, length long, record_type string, record_id string")


def _entries(index: str, most: int = 256) -> Iterator[list]:
    with open_input(index) as source:
        held, rest = [], b""
        while part := source.read(PIECE):
            *lines, rest = (rest + part).split(b"\n")
            for line in lines:
                a, b, kind, name = line.decode().split("\t")
                held.append((int(a), int(b), kind, name))
                if len(held) == most:
                    yield held
                    held = []
        if held:
            yield held


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records (``RECORD``), cut out by the offsets of the index."""
    schema = RECORD if with_payload else RECORD.removesuffix(", payload binary")
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_input(path) as source:
                    for entries in _entries(index):
                        found = []
                        for offset, length, _, _ in entries:
                            source.seek(offset)
                            found.append(parse(source.read(length))[: len(names)])
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    return archives.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to monolithic archives, normalised, and read back by offset."""
    from hourgrid.llm.common import table

    folder = scratch_path(spark, "warc")
    whole = write_monolithic(decide(table(spark, sf_dir, "pages")), f"{folder}/whole", level=1)
    return read(normalize(whole, f"{folder}/members")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS leader FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= {LEAST} AND page_id < leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST} AND page_id < leader THEN leader END AS refers_to
FROM m
"""
