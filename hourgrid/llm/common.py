"""Helpers of the operators: tables, worker set-up, files in the shared folder, bytes of texts as arrays."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLAB = 1 << 21      # bytes of text that the array code works on at a time (one text may be longer)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def use_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where the cluster sees the same folders (else ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def bound_batches(spark: SparkSession) -> None:
    """Unless the session says otherwise, Arrow batches end at ``BATCH_BYTES``, so that long texts do not fill a worker."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, so that no further column can clash; a null text is empty."""
    use_workers(df.sparkSession)
    return df.select(df[id_col].cast("long").alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the table has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % mod


def open_output(path: str):
    """A stream to a file of the shared folder, by URI or path; its parent folder is made."""
    fs, name = filesystem(path)
    fs.create_dir(os.path.dirname(name), recursive=True)
    return fs.open_output_stream(name, compression=None)


def open_input(path: str):
    fs, name = filesystem(path)
    return fs.open_input_file(name)


def filesystem(path: str):
    from pyarrow import fs as pafs

    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
    return pafs.LocalFileSystem(), path


# --- texts as arrays ------------------------------------------------------------

def slabs(column: pa.Array, limit: int = SLAB) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
NOT_SPACE = ~SPACE
#: ASCII letters and digits and every byte of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def runs(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes of a kind, and each text's place in them (n + 1 entries)."""
    inside = kind[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class SpanHash:
    """64-bit hashes of byte spans: a polynomial over scrambled byte values, from prefix sums."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.power = self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            with np.errstate(over="ignore"):
                for name, factor in (("power", self.base), ("back", self.inverse)):
                    steps = np.full(n, factor, np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.cumprod(steps))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.values[data] * self.power[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            spans = (sums[ends] - sums[starts]) * self.back[starts]
            return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.of(self.sums(data), starts, ends)


_HASHES: dict[int, SpanHash] = {}


def hasher(seed: int = 1) -> SpanHash:
    if seed not in _HASHES:
        _HASHES[seed] = SpanHash(seed)
    return _HASHES[seed]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    return hasher(seed)(data, starts, ends)


class Lookup:
    """Places of 64-bit hashes in an array of distinct ones, -1 for others: two slots each, a sorted list for the few that miss both."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys if len(keys) else np.zeros(1, np.uint64)       # place -1 reads the last entry, and stays -1
        self.bits = max(8, int(len(keys)).bit_length() + 1)
        self.slots = np.full((2, 1 << self.bits), -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        for way in range(2):
            place = self._place(keys[left], way)
            self.slots[way, place] = left
            left = left[self.slots[way, place] != left]
        order = np.argsort(keys[left])
        self.rest, self.rest_keys = left[order], keys[left][order]

    def _place(self, hashes: np.ndarray, way: int) -> np.ndarray:
        return ((hashes >> np.uint64(way * self.bits)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = self.slots[0, self._place(hashes, 0)]
        out[self.keys[out] != hashes] = -1
        missing = np.flatnonzero(out < 0)
        second = self.slots[1, self._place(hashes[missing], 1)]
        second[self.keys[second] != hashes[missing]] = -1
        out[missing] = second
        if len(self.rest):
            missing = missing[second < 0]
            at = np.minimum(np.searchsorted(self.rest_keys, hashes[missing]), len(self.rest) - 1)
            out[missing] = np.where(self.rest_keys[at] == hashes[missing], self.rest[at], -1)
        return out


def ngram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on (len - n + 1 entries)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[k: k + count]
            out ^= out >> np.uint64(29)
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def batches(rows: Iterator[pa.RecordBatch], limit: int = 2048) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for work that needs several times the size of a batch."""
    for batch in rows:
        for k in range(0, batch.num_rows, limit):
            yield batch.slice(k, limit)


def trimmed(work: Callable) -> Callable:
    """The same work on batches. What it has freed goes back to the system at its end: idle workers would keep it beside the stages that follow."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(rows)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc
            if trim is not None:
                trim(0)

    return run
