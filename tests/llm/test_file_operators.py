"""WARC archives, token files, packing."""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import ODD, SF

from hourgrid.llm import packing, rans, tokens, warc
from hourgrid.llm.common import open_input, open_output
from hourgrid.session import scratch_path

ROWS = [(r[0], r[1]) for r in ODD]


def ids_of(text):
    from tokenizers import Tokenizer

    global LIBRARY
    LIBRARY = globals().get("LIBRARY") or Tokenizer.from_file(tokens.default_path())
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


# --- tokens ---------------------------------------------------------------------------

def test_cached_words_equal_the_library(documents):
    texts = [r.text or "" for r in documents.collect()] + [r[1] or "" for r in ODD] + ["a\tb  c ſ ŉ ǆ", "'S it'S 's''s &&&'s ²½ 12a3", "é ́a x"]
    encoder = tokens.UnitEncoder(tokens.default_path())
    for _ in range(2):
        assert all(tokens.with_end(x, 1) == ids_of(t).tobytes() for x, t in zip(encoder.encode(texts), texts))


def test_table_is_bounded(monkeypatch):
    """Also with slots so few that units push each other out."""
    for units, bits in ((50, 21), (700_000, 3)):
        monkeypatch.setattr(tokens, "UNITS", units)
        monkeypatch.setattr(tokens, "SLOT_BITS", bits)
        encoder = tokens.UnitEncoder(tokens.default_path())
        for k in range(20):
            text = " ".join(f"w{k}x{j}, it's" for j in range(30)) + " the end"
            assert tokens.with_end(encoder.encode([text, "", None])[0], 1) == ids_of(text).tobytes()
        assert units > 50 or len(encoder.hashes) <= 150


# --- rANS -----------------------------------------------------------------------------

def test_coder_round_trip():
    rng = np.random.default_rng(0)
    ids = (rng.zipf(1.3, 50_000) % 40_000).astype(np.uint32)
    table = rans.Table(*np.unique(ids, return_counts=True))
    assert int(table.frequency.sum()) == 1 << table.bits and table.frequency.min() >= 1
    for n in (0, 1, 63, 64, 65, 1000, 50_000):
        assert (rans.decode(rans.encode(ids[:n], table, 64), n, table, 64) == ids[:n]).all()
    one = rans.Table(np.array([7]), np.array([3]))
    assert (rans.decode(rans.encode(np.full(100, 7), one, 8), 100, one, 8) == 7).all()
    with pytest.raises(ValueError):
        rans.encode(np.array([39_999_0]), one, 8) if one.ids[-1] > 399_990 else rans.encode(np.array([3]), one, 8)


class Held(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at: at + n]


def test_file_blocks_and_damage():
    rng = np.random.default_rng(1)
    docs = [(None, 3), (5, 0), (6, 900), (7, 2500), (7, 10)]
    ids = [rng.integers(0, 300, n).astype(np.uint32) for _, n in docs]
    table = rans.Table(*np.unique(np.concatenate(ids), return_counts=True))
    sink = Held()
    writer = rans.Writer(sink, table, block=512, lanes=16)
    for (doc_id, _), x in zip(docs, ids):
        writer.add(doc_id, x)
    assert writer.close()[0] == 3413
    reader = rans.Reader(sink, table)
    start = 0
    for (doc_id, n), x, (got_id, got_start, got) in zip(docs, ids, reader.documents(), strict=True):
        assert (got_id, got_start) == (doc_id, start) and (got == x).all()
        start += n
    whole = np.concatenate(ids)
    for k in reversed(range(len(reader.directory))):        # blocks stand alone
        assert (reader.block(k) == whole[512 * k: 512 * (k + 1)]).all()
    raw = bytearray(sink.getvalue())
    raw[int(reader.directory[2][0]) + 40] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.Reader(Held(bytes(raw)), table).block(2)


def test_token_files(spark, odd, empty):
    tokenized = rans.tokenize(odd)
    table = rans.frequency_table(tokenized)
    files = rans.write(tokenized, table, scratch_path(spark, "rans"), block=4096, lanes=32)
    got = rans.read(files, table).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((i, ids_of(t).tobytes()) for i, t in ROWS)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id or -1 for r in got] == sorted(r[0] or -1 for r in ROWS)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    none = rans.tokenize(empty)
    table = rans.frequency_table(none)
    assert rans.read(rans.write(none, table, scratch_path(spark, "rans")), table).count() == 0


def test_token_query(spark, documents):
    rows = sorted((r.doc_id, ids_of(r.text)) for r in documents.select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in rans.query(spark, SF).collect())
    starts = np.cumsum([0] + [len(x) for _, x in rows])[:-1].tolist()
    assert got == [(i, s, len(x), zlib.crc32(x.tobytes())) for (i, x), s in zip(rows, starts)]


# --- packing --------------------------------------------------------------------------

def check_pieces(pieces, rows, most=2048, segments=256):
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    want = Counter()
    for i, t in rows:
        want[i] += len(ids_of(t))
    assert {i: sum(p.length for p in ps) for i, ps in by_doc.items()} == dict(want)
    sequences: dict = {}
    for p in pieces:
        assert p.length > 0
        sequences.setdefault(p.sequence_id, []).append(p)
    padding = total = 0
    for ps in sequences.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == list(np.cumsum([0] + [p.length for p in ps])[:-1]) and len(ps) <= segments
        n = sum(p.length for p in ps)
        assert n <= most
        padding += 0 if n & (n - 1) == 0 else most - n
        total += n
    return padding / total


def test_packing_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    pieces = packing.query(spark, SF).collect()
    assert check_pieces(pieces, rows) < 0.01
    ids = {i: ids_of(t) for i, t in rows}
    for p in pieces:
        assert zlib.crc32(ids[p.doc_id][p.start: p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])


@pytest.mark.parametrize("limits", [(2048, 256, 2048), (64, 2, 64), (100, 3, 40)])
def test_packing_odd_rows(odd, empty, limits):
    check_pieces(packing.pack_texts(odd, limits=limits).collect(), ROWS, limits[0], limits[1])
    assert packing.pack_texts(empty).count() == 0


def test_packing_examples(spark):
    rng = np.random.default_rng(2)
    rows = [(str(k), int(rng.integers(1, 900)), int(rng.integers(1, 9)), None, "x") for k in range(500)]
    rows = [(i, n, s, int(n * rng.random()), x) for i, n, s, _, x in rows] + [("big", 5000, 1, 10, "x"), (None, None, None, None, None), ("0", 10, 1, 1, "x")]
    df = spark.createDataFrame(rows, "example_id string, n_tokens long, n_segments long, n_loss long, sequence_id string").coalesce(1)
    got = packing.pack_examples(df, limits=(2048, 12, 700)).collect()
    assert Counter((r.example_id, r.n_tokens) for r in got) == Counter((r[0], r[1] or 0) for r in rows)
    assert {r.example_id for r in got if r.sequence_id is None} == {r[0] for r in rows if (r[1] or 0) > 2048 or (r[3] or 0) > 700}
    bins: dict = {}
    for r in got:
        if r.sequence_id is not None:
            bins.setdefault(r.sequence_id, []).append(r)
    for rs in bins.values():
        assert sum(r.n_tokens for r in rs) <= 2048 and sum(r.n_segments for r in rs) <= 12 and sum(r.n_loss for r in rs) <= 700
    fill = max(sum(f) for f in zip(*[(sum(r.n_tokens for r in rs) / 2048, sum(r.n_segments for r in rs) / 12, sum(r.n_loss for r in rs) / 700) for rs in bins.values()]))
    assert fill / len(bins) > 0.9
    assert packing.pack_examples(df.limit(0)).count() == 0


# --- WARC -----------------------------------------------------------------------------

PAGES = [
    (1, "http://a/ x", "p" * 1500), (3, "http://b/", "p" * 1500), (2, None, "p" * 1500), (4, "http://c/", "short"), (5, "http://c/", "short"),
    (6, "http://d/\r\nX: y", None), (7, "", ""), (None, "http://e/", "p" * 1500), (8, "http://é/", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n" * 60),
    (9, "u", "q" * 1000), (9, "u", "q" * 1000), (10, "u", "q" * 999), (11, "u", "q" * 999), (None, "n", "r" * 2000), (None, "n", "r" * 2000),
]


def expected(rows):
    leader: dict = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            leader[html] = max(i, leader.get(html, i))
    out = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        first = leader.get(html)
        again = first is not None and (i is None or i < first)
        out[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first if again else None)] += 1
    return out


def archives(spark, pages):
    folder = scratch_path(spark, "warc")
    whole = warc.write_monolithic(warc.decide(pages), f"{folder}/a", level=1)
    return whole, warc.normalize(whole, f"{folder}/b")


def test_warc_odd_rows(spark):
    df = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, digest string, leader int").repartition(3)
    whole, members = archives(spark, df)
    got = warc.read(members, with_payload=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(PAGES)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert {r.url is None for r in got if r.page_id == 2} == {True}
    none = archives(spark, df.limit(0))[1]
    assert warc.read(none).count() == 0


def test_warc_members_and_index(spark):
    """The archive inflates to the same bytes, and each index entry cuts out one whole record."""
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    whole, members = archives(spark, df)
    with open_input(whole.first().path) as f:
        before = gzip.decompress(f.read())
    path = members.first().path
    with open_input(path) as f:
        raw = f.read()
    assert gzip.decompress(raw) == before
    entries = warc.read_index(members).orderBy("offset").collect()
    assert len(entries) == len(PAGES) and entries[-1].offset + entries[-1].length == len(raw)
    for e in entries:
        cut = gzip.decompress(raw[e.offset: e.offset + e.length])
        assert cut.startswith(b"WARC/1.1\r\n") and cut.endswith(b"\r\n\r\n") and e.record_id.encode() in cut
    # Archives that have members already, and archives that break off.
    sink = io.BytesIO()
    assert len(list(warc.rewrite(io.BytesIO(raw), sink))) == len(PAGES) and gzip.decompress(sink.getvalue()) == before
    with pytest.raises(ValueError):
        list(warc.rewrite(io.BytesIO(gzip.compress(before)[:-60]), io.BytesIO()))
    with pytest.raises(ValueError):
        list(warc.rewrite(io.BytesIO(gzip.compress(before[:-9])), io.BytesIO()))


def test_shared_files(spark):
    for path in (scratch_path(spark, "x") + "/f", "file://" + scratch_path(spark, "x").removeprefix("file://") + "/f"):
        with open_output(path) as f:
            f.write(b"abc")
        with open_input(path) as f:
            assert f.read() == b"abc"
