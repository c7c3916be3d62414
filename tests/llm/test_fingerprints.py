"""Fingerprints by invertible Bloom lookup sketches: paragraphs, likeness, retries and odd rows against sets of paragraphs."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import LONG, ODD
from pyspark.sql import functions as F

from hourgrid.llm import iblt

ROWS = [(r[0], r[1]) for r in ODD]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chosen(seed, unit, every):
    return signed(xxhash.xxh64_intdigest(unit.encode(), xxhash.xxh64_intdigest(struct.pack("<i", seed), 42))) % every == 0


def every(at):
    level, end = 0, iblt.NEAR
    while at >= end and level < iblt.LEVELS:
        level += 1
        end += iblt.NEAR << level
    return iblt.EVERY << level


def cut(units, seed):
    return "".join(u + "\n" if chosen(seed, u, every(k)) else u for k, u in enumerate(units))


def paragraphs(text):
    words = re.split("(?<=[ \n])", text)
    words = [cut(list(w), 6) if len(w) > iblt.WORD else w for w in words]
    return set(cut(words, 5).split("\n"))


def versions(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    for k, (doc_id, text) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        yield doc_id, text, text[: len(text) - half] + nxt[:half], nxt


def near(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return round(len(a & b) / len(a | b), 9)


def check_versions(df, rows):
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in iblt.compare_versions(df).collect())
    assert got == Counter((i, len(t), hashlib.sha256(e.encode()).hexdigest(), near(t, e), near(t, n)) for i, t, e, n in versions(rows))


def test_odd_rows(odd, empty):
    check_versions(odd, [(i, t or "") for i, t in ROWS])
    assert iblt.compare_versions(empty).count() == 0


def test_equal_texts_have_equal_fingerprints(odd):
    prints = {(r.doc_id, r.fingerprint) for r in iblt.compare_versions(odd).filter("doc_id IN (1, 7)").collect()}
    assert len({p for _, p in prints}) == 1


def test_single_document(odd):
    check_versions(odd.filter("doc_id = 5"), [(5, LONG)])


def test_documents(documents):
    check_versions(documents, [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()])


def test_many_rows_of_one_id(spark, monkeypatch):
    """The rows of an id that fills several buckets are split between them, those without an id too."""
    rows = [(7 if k % 3 else None if k % 2 else k, f"text {k}\nsecond line {k % 5}") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    sized = []
    original = iblt.Window.partitionBy
    monkeypatch.setattr(iblt.Window, "partitionBy", lambda *c: sized.append(c) or original(*c))
    check_versions(df, rows)
    keyed = iblt.with_next(df, ["text"], buckets=16)
    assert keyed.count() == 900 and sized


def test_buckets():
    assert iblt._buckets([3, 5, 5, 5, 9]) == ([3, 5, 9], [0, 1, 5, 6], [0, 3, 0])
    assert iblt._buckets([]) == ([], [0], [])


def test_retries_grow_until_all_are_peeled(spark):
    text = lambda a, b: "\n".join(f"line {k}" for k in range(a, b))
    rows = [(1, text(0, 300)), (2, text(5000, 5020)), (3, text(20_000, 26_000)), (4, text(0, 305))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_versions(df, rows)
    cells = {r.doc_id: r.cells_next for r in iblt.compare_versions(df).collect()}
    assert cells[3] >= 7000 and cells[2] > iblt.CELLS


def test_digests_are_recovered(spark):
    rows = [(k, list(range(20)), list(range(k, 20 + k))) for k in range(12)]
    pairs = spark.createDataFrame(rows, "row long, a array<long>, b array<long>")
    got = {(r.row, r.side, r.digest) for r in iblt.recovered(pairs, ["row"], iblt.CELLS).collect()}
    want = {(k, 1, x) for k, a, b in rows for x in set(a) - set(b)} | {(k, -1, x) for k, a, b in rows for x in set(b) - set(a)}
    assert got == want


def test_long_lines(spark):
    """Half of a single long line is unchanged: with blanks, without them, and in one word."""
    rng = np.random.default_rng(3)
    texts = [
        " ".join(f"w{x}" for x in rng.integers(0, 9999, 600)), "".join(chr(0x4E00 + x) for x in rng.integers(0, 2000, 900)), "".join(chr(97 + x) for x in rng.integers(0, 26, 3000)),
        " ".join(f"v{x}" for x in rng.integers(0, 9999, 45)),
    ]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_versions(df, rows)
    for r in iblt.compare_versions(df).collect():
        assert r.near_edited > 0.2 and r.near_next < 0.05 and r.fingerprint.count("-") > 15


def test_plan_is_native_and_deals_pairs_once(spark, documents):
    plan = iblt.compare_versions(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    pairs = spark.range(4).select(F.col("id").alias("row"), F.array(F.lit(1).cast("long")).alias("a"), F.array(F.lit(2).cast("long")).alias("b"))
    physical = iblt.outcome(pairs.repartition("row"), ["row"], iblt.CELLS)._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange") == 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None), (None, "")]])
def test_nulls_only(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = iblt.compare_versions(df).collect()
    assert [(r.n_chars, r.near_edited, r.near_next) for r in got] == [(0, 1.0, 1.0)] * len(rows)
