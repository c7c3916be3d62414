"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every training window.

Words are runs of ASCII letters and digits and of all other non-ASCII characters, with
A-Z lower-cased. An item's windows are its runs of 13 words; an item of fewer words,
but not none, is one window. Hashes of all windows of a document, of each length that
occurs, are looked up in the set; each hit is verified on the words themselves.

The set goes to the workers whole while the items' text is at most ``ITEM_BYTES`` (it is
measured first). Beyond that, items are dealt by hash into parts of about that size, each
part is written to the shared folder, and a task looks a batch up in one part after the
other: memory stays bounded and no window is left out. Documents are never shuffled.

Defined results: a null text has no words; an item without words has no window; repeated
items each count by their id, a null item id is left out of the list of ids but its
windows count as hits; repeated documents give repeated rows; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import ALNUM, LOWER, batches, ngram_hash, open_input, open_output, runs, slabs, span_hash, texts
from hourgrid.session import scratch_path

WINDOW = 13
ITEM_BYTES = 32 << 20
SHARE = 20          # contaminated: SHARE * hit words >= words
SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "item_ids array<long>, spans array<struct<first:long,last:long>>"
)
SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
BITS = 22           # of the table that tells most windows that are no hits


class Windows:
    """Windows of items by length: sorted hashes, their words and the items that have them."""

    def __init__(self, items: list[tuple[int | None, str]], window: int):
        self.window = window
        found: dict[int, dict[int, dict[bytes, list]]] = {}
        column = pa.array([t for _, t in items], pa.large_string())
        for first, _, data, offsets in slabs(column):
            lower = LOWER[data]
            starts, ends, place = runs(data, offsets, ALNUM)
            hashes = span_hash(lower, starts, ends)
            for k in range(len(offsets) - 1):
                a, b = int(place[k]), int(place[k + 1])
                n = min(window, b - a)
                if n:
                    for at, h in enumerate(ngram_hash(hashes[a:b], n).tolist(), a):
                        words = joined(lower, starts, ends, at, n)
                        owners = found.setdefault(n, {}).setdefault(h, {}).setdefault(words, [])
                        owners.append(items[first + k][0])
        self.by_length = {}
        for n, hashes in found.items():
            table = np.zeros(1 << BITS, bool)
            table[np.array(list(hashes), np.uint64) >> np.uint64(64 - BITS)] = True
            self.by_length[n] = (table, hashes)

    def hits(self, lower, starts, ends, hashes, place):
        """(document, first word, length, item ids) of each verified occurrence; places within the slab."""
        for n, (table, known) in self.by_length.items():
            grams = ngram_hash(hashes, n)
            at = np.flatnonzero(table[grams >> np.uint64(64 - BITS)])
            doc = np.searchsorted(place, at, "right") - 1
            at, doc = (x[at + n <= place[doc + 1]] for x in (at, doc))      # not across documents
            for k, d, h in zip(at.tolist(), doc.tolist(), grams[at].tolist()):
                if (owners := known.get(h)) and (ids := owners.get(joined(lower, starts, ends, k, n))) is not None:
                    yield d, k, n, ids


def joined(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, n: int) -> bytes:
    return b" ".join(lower[s:e].tobytes() for s, e in zip(starts[at: at + n].tolist(), ends[at: at + n].tolist()))


def _parts(items: DataFrame, window: int, item_bytes: int) -> list:
    """One broadcast part, or names of files of parts."""
    spark = items.sparkSession
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    if total <= item_bytes:
        return [(uuid.uuid4().hex, spark.sparkContext.broadcast([tuple(r) for r in items.collect()]))]
    count, folder = -(-total // (item_bytes // 2)), scratch_path(spark, "windows")
    names = []
    for k in range(count):
        part = items.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)) == k).toArrow()
        names.append(f"{folder}/{k}.arrow")
        with open_output(names[-1]) as sink, pa.ipc.new_stream(sink, part.schema) as writer:
            writer.write_table(part)
    return names


_LOADED: dict = {}


def _load(part, window: int) -> Windows:
    """A worker keeps the last part it used."""
    key = (part if isinstance(part, str) else part[0], window)
    if key not in _LOADED:
        if isinstance(part, str):
            with open_input(part) as source:
                read = pa.ipc.open_stream(source).read_all()
            items = list(zip(read.column(0).to_pylist(), read.column(1).to_pylist()))
        else:
            items = part[1].value
        _LOADED.clear()
        _LOADED[key] = Windows(items, window)
    return _LOADED[key]


def scan(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """One row per document (``SCHEMA``): hit words, items, the contamination verdict and the hit spans of words."""
    parts = _parts(texts(items, item_col, item_text_col), window, item_bytes)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            yield _batch(batch, [lambda p=p: _load(p, window) for p in parts])

    return texts(documents, id_col, text_col).mapInArrow(run, SCHEMA)


def _batch(batch: pa.RecordBatch, parts: list) -> pa.RecordBatch:
    n = batch.num_rows
    words, covered, found, spans = np.zeros(n, np.int64), np.zeros(n, np.int64), [set() for _ in range(n)], [[] for _ in range(n)]
    for part in parts:
        windows = part()
        for first, _, data, offsets in slabs(batch.column(1)):
            lower = LOWER[data]
            starts, ends, place = runs(data, offsets, ALNUM)
            words[first: first + len(offsets) - 1] = np.diff(place)
            for d, at, length, ids in windows.hits(lower, starts, ends, span_hash(lower, starts, ends), place):
                a = at - int(place[d])
                spans[first + d].append((a, a + length))
                found[first + d].update(i for i in ids if i is not None)
    merged = []
    for k, hit in enumerate(spans):
        out: list[list[int]] = []
        for a, b in sorted(hit):
            if out and a <= out[-1][1]:
                out[-1][1] = max(b, out[-1][1])
            else:
                out.append([a, b])
        covered[k] = sum(b - a for a, b in out)
        merged.append([{"first": a, "last": b - 1} for a, b in out])
    lists = [sorted(ids) for ids in found]
    digests = [hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest() for ids in lists]
    bad = (covered > 0) & (SHARE * covered >= words)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(words), pa.array(covered), pa.array([len(x) for x in lists], pa.int64()),
         pa.array(digests), pa.array(bad), pa.array(lists, pa.list_(pa.int64())), pa.array(merged, pa.list_(SPAN))],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids", "spans"],
    )


def contaminated_column(items: DataFrame, text: Column, item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> Column:
    """The verdict as a column, so that a filter needs no join."""
    parts = _parts(texts(items, item_col, item_text_col), window, item_bytes)

    @F.arrow_udf("boolean")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for k in range(0, len(column), 2048):
            part = column.slice(k, 2048)
            rows = pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.int64()), part], names=["doc_id", "text"])
            out += _batch(rows, [lambda p=p: _load(p, window) for p in parts]).column(5).to_pylist()
        return pa.array(out, pa.bool_())

    return run(text)


def remove_spans(documents: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with the words of the hit spans cut out; ids must be unique."""
    hit = scanned.filter(F.size("spans") > 0).select(F.col("doc_id").alias("_id"), "spans")
    given = texts(documents, id_col, text_col)
    both = given.join(hit, given.doc_id.eqNullSafe(hit._id), "left").select("doc_id", "text", "spans")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            out = batch.column(1).to_pylist()
            cuts = batch.column(2).to_pylist()
            for first, _, data, offsets in slabs(batch.column(1)):
                starts, ends, place = runs(data, offsets, ALNUM)
                for k in range(len(offsets) - 1):
                    if cuts[first + k]:
                        raw, at, kept = data[offsets[k]: offsets[k + 1]].tobytes(), 0, []
                        for s in cuts[first + k]:
                            kept.append(raw[at: int(starts[place[k] + s["first"]] - offsets[k])])
                            at = int(ends[place[k] + s["last"]] - offsets[k])
                        out[first + k] = b"".join([*kept, raw[at:]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return both.mapInArrow(run, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    from hourgrid.llm.common import table

    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("item_ids", "spans")


_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWERED)} AS w FROM documents),
b AS (SELECT item_id, w, least({WINDOW}, len(w)) AS n FROM (SELECT item_id, {_WORDS.format(_LOWERED)} AS w FROM benchmark) t WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b) t),
lengths AS (SELECT DISTINCT n FROM g),
p AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n),
hits AS (SELECT p.r, p.i, p.n, g.item_id FROM p JOIN g ON p.n = g.n AND array_to_string(p.w[p.i:p.i + p.n - 1], ' ') = g.gram),
covered AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM hits) t GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits) t GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND {SHARE} * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c ON c.r = d.r LEFT JOIN named m ON m.r = d.r
"""
