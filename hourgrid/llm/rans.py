"""Token ids in files of a static range asymmetric numeral system (rANS).

One table of frequencies, counted over all documents and brought to a sum of a power of two,
serves all files. The ids of documents in ascending id order are cut into blocks of
``BLOCK`` ids. A block is coded by ``LANES`` interleaved states (id i by state i mod LANES), so the
array code takes a step for all lanes at once, and stands alone: its entry in the file's
directory is a checkpoint (place in the file, size, ids before it, crc32 of its ids), so
blocks are decoded in parallel or one by one. A file also lists its documents (id, token count) and
its crc32s are checked when it is read.

File: ``MAGIC``, blocks, then documents and directory as JSON lengths and zlib-compressed arrays, and
the footer's length in the last eight bytes.

Documents are tokenized once, into a table in the shared folder; counts by id (at most the
vocabulary) come from it, and it is dealt by ranges of the id. Each task writes one file, under
a name no other attempt uses; the written table of files names those that count.

Defined results: a null text is empty (the end id alone); a null id comes first; rows that share
an id stand one after the other, ordered by their ids' bytes; an empty table gives no file and no row.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm import tokens
from hourgrid.llm.common import batches, open_input, open_output, texts
from hourgrid.session import materialize, scratch_path

MAGIC = b"RANS0001"
BLOCK, LANES = 1 << 18, 1024
END = 1
LOW = np.uint64(1 << 31)        # a state is at least this and below LOW << 32
FILES = "path string, first long, n_docs long, n_tokens long, n_bytes long, number int"


# --- the coder ----------------------------------------------------------------------

class Table:
    """Frequencies of ids, summing to ``2 ** bits``."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.int64)[order]
        self.bits = min(28, max(16, int(len(ids)).bit_length() + 4))
        total, size = max(1, int(counts.sum())), 1 << self.bits
        # Largest remainders, at least one for each id.
        exact = counts.astype(np.float64) * (size - len(counts)) / total
        frequency = np.floor(exact).astype(np.int64) + 1
        rest = size - int(frequency.sum())
        if len(counts):
            frequency[np.argsort(-(exact - np.floor(exact)), kind="stable")[:rest]] += 1
        self.frequency = frequency.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(frequency)[:-1]]).astype(np.uint64) if len(counts) else np.zeros(0, np.uint64)
        self._slots: np.ndarray | None = None
        self._place: np.ndarray | None = None

    def place(self, ids: np.ndarray) -> np.ndarray:
        if self._place is None:
            self._place = np.full(int(self.ids[-1]) + 1, -1, np.int64)
            self._place[self.ids] = np.arange(len(self.ids))
        return self._place[ids]

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.frequency.astype(np.int64))
        return self._slots


def encode(ids: np.ndarray, table: Table, lanes: int = LANES) -> bytes:
    """A block: the final states, then the 32-bit words in the order the decoder wants them."""
    symbols = table.place(ids.astype(np.int64))
    if len(symbols) and symbols.min() < 0:
        raise ValueError("an id is not in the frequency table")
    steps = -(-len(symbols) // lanes)
    state = np.full(lanes, LOW, np.uint64)
    shift, words = np.uint64(table.bits), []
    for step in range(steps - 1, -1, -1):
        s = symbols[step * lanes: (step + 1) * lanes]
        n = len(s)
        x, f = state[:n], table.frequency[s]
        full = x >= (f << np.uint64(63 - table.bits))
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x[full] >>= np.uint64(32)
        whole = x // f
        x[:] = (whole << shift) + (x - whole * f) + table.start[s]
    return state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode(raw: bytes, count: int, table: Table, lanes: int = LANES) -> np.ndarray:
    state = np.frombuffer(raw, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(raw, "<u4", offset=8 * lanes)
    out, at = np.empty(count, np.int64), 0
    shift, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    for first in range(0, count, lanes):
        n = min(lanes, count - first)
        x = state[:n]
        slot = x & mask
        s = table.slots[slot]
        x[:] = table.frequency[s] * (x >> shift) + slot - table.start[s]
        short = np.flatnonzero(x < LOW)
        if len(short):
            x[short] = (x[short] << np.uint64(32)) | words[at: at + len(short)].astype(np.uint64)
            at += len(short)
        out[first: first + n] = table.ids[s]
    return out.astype("<u4")


# --- files --------------------------------------------------------------------------

class Writer:
    """A file of documents given in order; at most one block waits."""

    def __init__(self, sink, table: Table, block: int = BLOCK, lanes: int = LANES):
        self.sink, self.table, self.block, self.lanes = sink, table, block, lanes
        self.waiting: list[np.ndarray] = []
        self.size = self.before = 0
        self.at = sink.write(MAGIC)
        self.directory: list[list[int]] = []
        self.docs: list[int] = []
        self.lengths: list[int] = []
        self.unnamed = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.unnamed += doc_id is None
        self.docs.append(0 if doc_id is None else doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= self.block:
            held = np.concatenate(self.waiting)
            whole = len(held) // self.block * self.block
            for k in range(0, whole, self.block):
                self._put(held[k: k + self.block])
            self.waiting, self.size = [held[whole:]], len(held) - whole

    def _put(self, ids: np.ndarray) -> None:
        raw = encode(ids, self.table, self.lanes)
        self.directory.append([self.at, len(raw), len(ids), self.before, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(raw)])
        self.at += self.sink.write(raw)
        self.before += len(ids)

    def close(self) -> tuple[int, int]:
        """Ids and bytes of the file."""
        held = np.concatenate([np.zeros(0, np.uint32), *self.waiting])
        if len(held):
            self._put(held)
        docs = zlib.compress(np.diff(np.array(self.docs, "<i8"), prepend=0).tobytes())
        lengths = zlib.compress(np.array(self.lengths, "<i8").tobytes())
        directory = zlib.compress(np.array(self.directory, "<i8").tobytes())
        head = json.dumps({
            "docs": len(docs), "lengths": len(lengths), "directory": len(directory), "lanes": self.lanes, "unnamed": self.unnamed,
        }).encode()
        footer = docs + lengths + directory + head + len(head).to_bytes(8, "little")
        self.at += self.sink.write(footer)
        return self.before, self.at


class Reader:
    """Random access to the blocks and documents of a file."""

    def __init__(self, source, table: Table):
        self.source, self.table = source, table
        size = source.size()
        if source.read_at(8, 0) != MAGIC:
            raise ValueError("not a file of this format")
        n = int.from_bytes(source.read_at(8, size - 8), "little")
        head = json.loads(source.read_at(n, size - 8 - n))
        at = size - 8 - n - head["docs"] - head["lengths"] - head["directory"]
        raw = source.read_at(size - 8 - n - at, at)
        a, b = head["docs"], head["docs"] + head["lengths"]
        self.docs = np.cumsum(np.frombuffer(zlib.decompress(raw[:a]), "<i8"))
        self.lengths = np.frombuffer(zlib.decompress(raw[a:b]), "<i8")
        self.directory = np.frombuffer(zlib.decompress(raw[b:]), "<i8").reshape(-1, 6)
        self.lanes, self.unnamed = head["lanes"], head["unnamed"]

    def block(self, k: int) -> np.ndarray:
        at, size, count, _, crc, raw_crc = (int(x) for x in self.directory[k])
        raw = self.source.read_at(size, at)
        if zlib.crc32(raw) != raw_crc:
            raise ValueError(f"block {k} is damaged")
        ids = decode(raw, count, self.table, self.lanes)
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {k} does not decode to its ids")
        return ids

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the file, ids) in order, a block at a time."""
        held, base, nxt = np.zeros(0, "<u4"), 0, 0
        start = 0
        for k, (doc_id, n) in enumerate(zip(self.docs.tolist(), self.lengths.tolist())):
            parts = [held[start - base: start - base + n]]
            while start + n > base + len(held):
                base += len(held)
                held, nxt = self.block(nxt), nxt + 1
                parts.append(held[: start + n - base])
            yield (None if k < self.unnamed else doc_id), start, np.concatenate(parts) if len(parts) > 1 else parts[0]
            start += n


# --- jobs ---------------------------------------------------------------------------

def tokenize(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END) -> DataFrame:
    """(doc_id, ids): ids as little-endian integers of 16 bits (``wide`` false) or 32."""
    path = tokenizer or tokens.default_path()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        narrow = len(encoder.last) <= 1 << 16 and end_id < 1 << 16
        for batch in batches(rows, 1024):
            raw = [tokens.with_end(x, end_id) for x in encoder.encode(batch.column(1))]
            if narrow:
                raw = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([not narrow] * len(raw)), pa.array(raw, pa.binary())], names=["doc_id", "wide", "ids"])

    return texts(documents, id_col, text_col).mapInArrow(run, "doc_id long, wide boolean, ids binary")


def count_ids(tokenized: DataFrame) -> DataFrame:
    """(id, n) over all documents: a row an id and task before the shuffle."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches(rows):
            for ids in _ids(batch, 0):
                if len(ids):
                    seen = np.bincount(ids)
                    if len(seen) > len(total):
                        total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
                    total[: len(seen)] += seen
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    return tokenized.select("wide", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _ids(batch: pa.RecordBatch, wide_col: int, joined: int = 256) -> Iterator[np.ndarray]:
    """Ids of a batch, some documents together."""
    wide, raw = batch.column(wide_col).to_pylist(), batch.column(wide_col + 1).to_pylist()
    for k in range(0, len(raw), joined):
        yield np.frombuffer(b"".join(raw[k: k + joined]), "<u4" if wide[k] else "<u2")


def write(tokenized: DataFrame, table: Table, folder: str, block: int = BLOCK, lanes: int = LANES) -> DataFrame:
    """Files of documents in ascending id order; the table of files (``FILES``)."""
    shared = tokenized.sparkSession.sparkContext.broadcast(table)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        path, writer, first = f"{folder}/{number:06d}-{uuid.uuid4().hex}.rans", None, None
        for batch in batches(rows, 512):
            for doc_id, wide, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    writer, first = Writer(open_output(path), shared.value, block, lanes), doc_id
                writer.add(doc_id, np.frombuffer(raw, "<u4" if wide else "<u2").astype(np.uint32))
        if writer:
            count, size = writer.close()
            writer.sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([first], pa.int64()), pa.array([len(writer.docs)], pa.int64()), pa.array([count], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([number], pa.int32())],
                names=["path", "first", "n_docs", "n_tokens", "n_bytes", "number"],
            )

    ordered = tokenized.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    return materialize(ordered.select("doc_id", "wide", "ids").mapInArrow(run, FILES), "rans-files")


def read(files: DataFrame, table: Table) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids): all documents, decoded and checked; start counts the ids of all files before."""
    shared = files.sparkSession.sparkContext.broadcast(table)
    # One row a file: a running sum over the few rows of the table of files.
    before = F.sum("n_tokens").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    based = files.select("path", F.coalesce(before, F.lit(0)).alias("base"), F.lit(1).alias("one"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_input(path) as source:
                    held: list[tuple] = []
                    for doc_id, start, ids in Reader(source, shared.value).documents():
                        raw = ids.astype("<u4").tobytes()
                        held.append((doc_id, base + start, len(ids), zlib.crc32(raw), raw))
                        if len(held) == 512:
                            yield _read_batch(held)
                            held = []
                    if held:
                        yield _read_batch(held)

    return based.repartition(max(1, files.count())).select("path", "base").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def frequency_table(tokenized: DataFrame) -> Table:
    """The shared table; at most a row for each id of the vocabulary comes to the driver."""
    counts = count_ids(tokenized).toArrow()
    return Table(counts.column("id").to_numpy(), counts.column("n").to_numpy())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents tokenized, written and read back."""
    from hourgrid.llm.common import table

    tokenized = tokenize(table(spark, sf_dir, "documents"))
    path = scratch_path(spark, "tokens")
    tokenized.write.option("compression", "zstd").parquet(path)
    tokenized = spark.read.parquet(path)
    frequencies = frequency_table(tokenized)
    files = write(tokenized, frequencies, scratch_path(spark, "rans"))
    return read(files, frequencies).drop("ids")
