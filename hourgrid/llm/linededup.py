"""Line dedup: hashes dealt by range with a secondary sort by document and position; keep bitmaps come back.

A line's key is the line without white space at both ends and with A-Z lower-cased. Of a
key of at least ``LEAST`` code points that more than one document holds, only the smallest
document id keeps its lines; all other lines stay.

1. Each batch of documents hashes its lines (two independent 64-bit hashes, 128 bits
   together). Of the documents of a batch that hold a key, only the smallest can keep it:
   the others' lines are dropped at once, and one row a key and batch is left. So a line of
   a third of all documents leaves a row a batch, not a row a document.
2. These rows, a table in the shared folder, are dealt by ranges of the hash, sorted by
   hash, document and position, and streamed: the first document of each key keeps it.
3. Dropped positions meet by document and become a zlib-compressed bitmap of kept lines.

Defined results: a null or empty text is one empty line; null ids count as one document
after all others; rows that share an id are one document, equal rows give equal bitmaps;
an empty table gives no row. A text without dropped lines has a null bitmap (all kept).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import LOWER, SPACE, batches, free_names, signed, slabs, span_hash, texts
from hourgrid.session import materialize

LEAST = 10
SLICE = 256             # rows of a batch that are rewritten together
NO_ID = (1 << 63) - 1
ROW = "h1 long, h2 long, doc long, part long, final boolean, positions binary"
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
NAMES = [c.split()[0] for c in ROW.split(", ")]


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with the key of a row: its id and the hash of its text."""
    return texts(df, id_col, text_col).select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("part"), "text"
    )


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the stripped lines and each text's place in them (n + 1 entries)."""
    breaks = np.flatnonzero(data == 10)
    count = len(offsets) - 1
    text_of = np.searchsorted(offsets, breaks, "right") - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    order = np.lexsort((starts, np.concatenate([np.arange(count), text_of])))
    starts = starts[order]
    owner = np.concatenate([np.arange(count), text_of])[order]
    place = np.searchsorted(owner, np.arange(count + 1))
    ends = np.concatenate([starts[1:] - 1, offsets[-1:]])
    ends[place[1:] - 1] = offsets[1:]
    solid = np.flatnonzero(~SPACE[data])
    if not len(solid):
        return starts, starts.copy(), place
    left = np.searchsorted(solid, starts)
    right = np.searchsorted(solid, ends) - 1
    empty = right < left
    first = np.where(empty, starts, solid[np.minimum(left, len(solid) - 1)])
    last = np.where(empty, starts, solid[np.maximum(right, 0)] + 1)
    return first, last, place


def _collapse(rows: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        doc, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        h1, h2, row, position = [], [], [], []
        for first, _, data, offsets in slabs(batch.column(2)):
            starts, ends, place = lines(data, offsets)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            long = np.flatnonzero(points[ends] - points[starts] >= least)
            owner = np.searchsorted(place, long, "right") - 1
            lower = LOWER[data]
            for out, seed in ((h1, 1), (h2, 2)):
                out.append(signed(span_hash(lower, starts[long], ends[long], seed)))
            row.append(owner + first)
            position.append(long - place[owner])
        if not h1:
            continue
        h1, h2, row, position = map(np.concatenate, (h1, h2, row, position))
        if not len(h1):
            continue
        d, p = doc[row], part[row]
        order = np.lexsort((position, p, d, h2, h1))
        h1, h2, d, p, position = (x[order] for x in (h1, h2, d, p, position))
        head = np.ones(len(h1), bool)
        head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = d[np.flatnonzero(head)][np.cumsum(head) - 1] == d
        # Rows of a batch's first document, by key; other rows are dropped for good, by document.
        for final, keep in ((False, first), (True, ~first)):
            a, b, x, y, z = (v[keep] for v in (h1, h2, d, p, position))
            if not len(a):
                continue
            if final:
                order = np.lexsort((z, y, x))
                a, b, x, y, z = a[order], b[order], x[order], y[order], z[order]
                cut = np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
            else:
                cut = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
            at = np.concatenate([[0], cut])
            bounds = [*cut.tolist(), len(a)]
            z = z.astype("<u4")
            raw = z.tobytes()
            held = [raw[4 * s: 4 * e] for s, e in zip(at.tolist(), bounds)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[at]), pa.array(b[at]), pa.array(x[at]), pa.array(y[at]), pa.array(np.full(len(at), final)), pa.array(held, pa.binary())],
                names=NAMES,
            )


def _later(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows, those whose document is not the first with the key."""
    last = None
    for batch in rows:
        h1, h2, doc = (batch.column(k).to_numpy() for k in range(3))
        if not len(h1):
            continue
        head = np.ones(len(h1), bool)
        head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = doc[np.flatnonzero(head)][np.cumsum(head) - 1]
        if last is not None and last[:2] == (h1[0], h2[0]):
            head[0] = False
            end = np.flatnonzero(head)
            first[: end[0] if len(end) else len(first)] = last[2]
        last = (h1[-1], h2[-1], first[-1])
        drop = pa.array(doc != first)
        yield pa.RecordBatch.from_arrays([batch.column(2).filter(drop), batch.column(3).filter(drop), batch.column(5).filter(drop)], names=["doc", "part", "positions"])


def dropped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc, part, positions): lists of dropped line positions, for the rows that lose lines."""
    given = _rows(df, id_col, text_col).select("doc", "part", "text")
    local = materialize(given.mapInArrow(lambda rows: _collapse(rows, least), ROW), "lines")
    sorted_rows = local.filter(~F.col("final")).repartitionByRange("h1").sortWithinPartitions("h1", "h2", "doc", "positions")
    later = sorted_rows.mapInArrow(_later, "doc long, part long, positions binary")
    both = later.unionByName(local.filter("final").select("doc", "part", "positions"))
    return both.groupBy("doc", "part").agg(F.collect_list("positions").alias("positions"))


def _joined(df: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    gone = dropped(df, id_col, text_col, least)
    return _rows(df, id_col, text_col).join(gone, ["doc", "part"], "left").select("doc_id", "text", "positions")


def _bitmap(n: int, positions: list[bytes] | None) -> np.ndarray:
    keep = np.ones(n, bool)
    for p in positions or ():
        keep[np.frombuffer(p, "<u4")] = False
    return keep


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep): the bitmap is zlib-compressed, most significant bit first; null: all kept."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            counts = [t.count("\n") + 1 for t in batch.column(1).to_pylist()]
            keeps = [_bitmap(n, p) if p else None for n, p in zip(counts, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()),
                 pa.array([0 if k is None else int((~k).sum()) for k in keeps], pa.int64()),
                 pa.array([None if k is None else zlib.compress(np.packbits(k).tobytes()) for k in keeps], pa.binary())],
                names=["doc_id", "n_lines", "n_dropped", "keep"],
            )

    return _joined(df, id_col, text_col, least).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, keep binary")


def kept_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): the kept lines, joined again."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            out, counts, gone = [], [], []
            for text, positions in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n, lost = text.count("\n") + 1, 0
                if positions:
                    keep = _bitmap(n, positions)
                    lost = int((~keep).sum())
                    text = "\n".join([line for line, k in zip(text.split("\n"), keep.tolist()) if k])
                out.append(text)
                counts.append(n)
                gone.append(lost)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "text"],
            )

    return _joined(df, id_col, text_col, least).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, text string")


def drop_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None, least: int = LEAST) -> DataFrame:
    """The table itself with the texts that lose lines replaced, and their number of code points in ``chars_col``."""
    doc, part, positions = free_names(df, "dedup_doc", "dedup_part", "dedup_positions")
    gone = dropped(df, id_col, text_col, least).select(F.col("doc").alias(doc), F.col("part").alias(part), F.col("positions").alias(positions))
    key = (F.coalesce(df[id_col].cast("long"), F.lit(NO_ID)) == F.col(doc)) & (F.xxhash64(F.coalesce(df[text_col], F.lit(""))) == F.col(part))

    @F.arrow_udf("string")
    def keep(text: pa.Array, gone: pa.Array) -> pa.Array:
        # Only texts that lose lines become Python objects, a slice of the batch at a time.
        parts = []
        for at in range(0, len(text), SLICE):
            some, lists = text.slice(at, SLICE), gone.slice(at, SLICE)
            changed = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
            out = []
            for k in changed.tolist():
                lines_of = (some[k].as_py() or "").split("\n")
                out.append("\n".join([line for line, kept in zip(lines_of, _bitmap(len(lines_of), lists[k].as_py()).tolist()) if kept]))
            mask = np.zeros(len(some), bool)
            mask[changed] = True
            parts.append(pc.replace_with_mask(some, pa.array(mask), pa.array(out, some.type)))
        return pa.chunked_array(parts, text.type).combine_chunks() if parts else text

    both = df.join(gone, key, "left").withColumn(text_col, keep(F.col(text_col), F.col(positions)))
    if chars_col:
        both = both.withColumn(chars_col, F.when(F.col(positions).isNull(), F.col(chars_col)).otherwise(F.length(text_col)).cast(df.schema[chars_col].dataType))
    return both.select(*df.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what each document keeps."""
    from hourgrid.llm.common import table

    kept = kept_texts(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = f"""
WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
           FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents) t),
k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {LEAST} GROUP BY key),
m AS (SELECT k.doc_id, k.i, k.line, length(k.key) < {LEAST} OR f.first = k.doc_id AS keep FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keep), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
