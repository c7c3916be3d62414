"""Line dedup, decontamination, Jaccard join, fingerprints: odd rows and brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from hourgrid.llm import components, decontaminate, jaccard, linededup

ROWS = [(r[0], r[1]) for r in ODD]


# --- line dedup -----------------------------------------------------------------------

def test_line_dedup_rows(odd):
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in linededup.kept_texts(odd).collect())
    want = Counter()
    for (doc_id, text), keep in zip(ROWS, brute.keep_lines(ROWS)):
        lines = (text or "").split("\n")
        want[(doc_id, len(lines), keep.count(False), "\n".join(x for x, k in zip(lines, keep) if k))] += 1
    assert got == want


def test_line_dedup_bitmaps(odd):
    flags = dict(zip(((i, t or "") for i, t in ROWS), brute.keep_lines(ROWS)))
    rows = linededup.keep_bitmaps(odd).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.keep is not None:
            bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8))[: r.n_lines].astype(bool).tolist()
            assert r.n_dropped == bits.count(False)
            assert any(bits == f for (i, _), f in flags.items() if i == r.doc_id)


def test_line_dedup_table(odd, empty):
    out = linededup.drop_lines(odd)
    assert out.columns == odd.columns and out.count() == len(ROWS)
    assert out.filter("doc_id = 2").first().text is None
    for df in (linededup.kept_texts(empty), linededup.keep_bitmaps(empty), linededup.drop_lines(empty)):
        assert df.count() == 0


def test_line_hot_over_partitions(spark):
    """A line of every document leaves a row a batch, and only the smallest id keeps it."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very common line\nown line of "), F.col("id").cast("string")).alias("text"))
    got = linededup.kept_texts(df.repartition(40))
    assert got.filter("n_dropped = 0").select("doc_id").collect() == [(0,)]
    assert got.agg(F.sum("n_dropped")).first()[0] == 2999


# --- decontamination --------------------------------------------------------------------

ITEMS = [
    (1, "one two three four five six seven"), (2, " ".join(f"w{k}" for k in range(40))), (3, None), (4, "!!"), (5, "plage"),
    (6, " ".join(f"word{k % 977} item{k % 31}" for k in range(100, 120))), (None, "a row without an id and of some length"), (1, "one two"),
]


@pytest.mark.parametrize("item_bytes", [1 << 20, 64])
def test_decontamination(spark, odd, item_bytes):
    """Also with the set in several parts."""
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.scan(odd, items, item_bytes=item_bytes).collect())
    want = Counter()
    for doc_id, text in ROWS:
        n, hit, ids, bad = brute.contaminated(text, ITEMS)
        want[(doc_id, n, hit, len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bad)] += 1
    assert got == want


def test_decontamination_empty_and_column(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.scan(empty, items).count() == 0
    assert decontaminate.scan(odd, items.limit(0)).filter("n_hit > 0").count() == 0
    flagged = odd.filter(decontaminate.contaminated_column(items, odd.text)).count()
    assert flagged == decontaminate.scan(odd, items).filter("contaminated").count() > 0


def test_decontamination_spans(spark):
    df = spark.createDataFrame([(1, "Intro text. One two three, four five six seven! The end."), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.remove_spans(df, decontaminate.scan(df, items)).collect()}
    assert got == {1: "Intro text. ! The end.", 2: "clean"}


# --- Jaccard join -----------------------------------------------------------------------

def test_bands_reach_the_recall():
    for threshold, recall, rows in ((0.8, 0.999, 6), (0.5, 0.9, 3)):
        bands = jaccard.plan_bands(threshold, recall, rows)
        assert 1 - (1 - threshold**rows) ** bands >= recall > 1 - (1 - threshold**rows) ** (bands - 1)


def test_jaccard_odd_rows(odd, empty):
    got = {(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in jaccard.join(odd).collect()}
    named = {r[0]: r for r in got}
    assert named[1] == (1, 1, 2, 2) and named[7] == (7, 1, 2, 2)
    assert named[5] == (5, 5, 1, 0) and named[6] == (6, 5, 1, 0)
    for k in (2, 3, 9, 10):
        assert named[k] == (k, k, 0, 0)
    assert named[None] == (None, None, 0, 0)
    assert jaccard.join(empty).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 8, 9, 10]


@pytest.mark.parametrize("block", [400_000, 300])
def test_jaccard_against_brute_force(spark, block):
    """Near copies in chains and a large group, also with groups cut into many blocks."""
    rng = np.random.default_rng(1)
    base = [[f"w{x}" for x in rng.integers(0, 500, 60)] for _ in range(6)]
    texts = []
    for k in range(150):
        w = list(base[k % 6 if k < 90 else 0])
        for at in rng.integers(0, 60, int(rng.integers(0, 3))):
            w[int(at)] = f"x{rng.integers(0, 9999)}"
        texts.append(" ".join(w))
    texts += ["too short", "too short", "other words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(df, recall=0.999999, block=block).collect()}
    roots, links = brute.groups(texts)
    assert got == {k: (roots[k], links[k]) for k in range(len(texts))}


def test_jaccard_on_documents(documents):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    roots, links = brute.groups([r.text for r in rows])
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(documents).collect()}
    assert got == {r.doc_id: (rows[a].doc_id, n) for r, a, n in zip(rows, roots, links)}


def test_jaccard_repeated_ids_without_words(spark):
    """Rows without words that share the ids of near copies change no link."""
    words = [f"w{k}" for k in range(100)]
    texts = [" ".join([*words, f"x{k}"]) for k in range(8)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(k, x) for k in range(8) for x in (None, "", "!!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard.join(df).collect())
    assert all(got[(k, 0, 7)] == 1 and got[(k, k, 0)] == 3 for k in range(1, 8)), got


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 90), (95, 100), (7, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
