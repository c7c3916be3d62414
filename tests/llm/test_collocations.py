"""Phrase collocations: the trie, its runs and merges, and whole results against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from hourgrid.llm import collocations as co

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least=10, cover=50, top=2000):
    """Rows of the result from (text, lang) rows."""
    counts: dict[str, Counter] = {}
    for text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            for n in (1, 2, 3):
                own.update(tuple(words[i: i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        chosen = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found, most = [], Counter()
        for p, a in chosen.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    most[part] = max(most[part], a)
        for p, a in chosen.items():
            if most[p] and 100 * most[p] >= cover * a:
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df, **how):
    return sorted(tuple(r) for r in co.collocations(df, **how).collect())


def made(seed, count):
    rng = random.Random(seed)
    words = ["the", "of", "New", "YORK", "city", "hall", "é", "日本", "a\xa0b", *[f"w{k}" for k in range(12)]]
    rows = []
    for _ in range(count):
        text = "".join(rng.choice(["new york ", "New York City ", rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", ";", ""])]) for _ in range(rng.randrange(30)))
        rows.append((text, rng.choice(["en", "en", "fr", None, "und", ""])))
    return rows


def test_plain_counts(spark):
    rows = made(1, 600)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    assert got(df) == plain(rows)
    assert got(df, least=3, top=7) == plain(rows, least=3, top=7)
    assert got(df, least=30, cover=80) == plain(rows, least=30, cover=80)


def test_odd_rows(spark, odd, empty):
    rows = [(r[1], r[2]) for r in ODD]
    assert got(odd) == plain(rows)
    assert got(odd, least=1, top=None) == plain(rows, least=1, top=10**9)
    assert co.collocations(empty).count() == 0


def test_hot_pair_and_language(spark):
    """One pair in every row, one language with nearly all of them; more partitions than documents of the other."""
    rows = [(f"hot pair u{k % 40} x{k % 7}", "en" if k % 100 else "de") for k in range(4000)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(30)
    assert got(df) == plain(rows)


def test_trie_bursts_spills_and_merges(monkeypatch):
    """Small containers, a small trie and small merges give the counts of a dictionary."""
    monkeypatch.setattr(co, "BURST", 16)
    monkeypatch.setattr(co, "CHUNK", 8)
    monkeypatch.setattr(co, "MERGED", 50)
    rng = np.random.default_rng(3)
    want: Counter = Counter()
    found: Counter = Counter()
    trie = co.HatTrie(3, held=600)
    spills = deep = 0
    for _ in range(60):
        keys = [rng.zipf(1.4, 300).astype(np.uint64) % np.uint64(50) for _ in range(3)]
        want.update(zip(*[k.tolist() for k in keys]))
        for columns, counts in trie.add(keys):
            spills += 1
            found.update(dict(zip(zip(*[c.tolist() for c in columns]), counts.tolist())))
        deep = max(deep, sum(isinstance(c, co.Node) for c in trie.root.children))
    for columns, counts in trie.rest():
        assert len(set(zip(*[c.tolist() for c in columns]))) == len(counts)
        found.update(dict(zip(zip(*[c.tolist() for c in columns]), counts.tolist())))
    assert found == want and spills and deep


def test_a_full_trie_is_given_in_pieces():
    """A task that has read its texts needs little beside its trie to give the counts on."""
    import tracemalloc

    rng = np.random.default_rng(5)
    list(co.chunks(([np.ones(2, np.uint64)] * 3, np.ones(2, np.int64)), 8))     # what is imported at the first use does not count
    tracemalloc.start()
    try:
        trie = co.HatTrie(3, held=300_000)
        for _ in range(6):
            assert not list(trie.add([rng.integers(0, 1 << 62, 40_000, np.uint64) for _ in range(3)]))
        full, _ = tracemalloc.get_traced_memory()
        tracemalloc.reset_peak()
        found, batch = [], None
        for run in trie.rest():
            for batch in co.chunks(run, 8):
                found.append(sum(batch.column(2).to_pylist()))
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert sum(found) == 240_000 and len(trie.root) == 0
    assert peak < 1.6 * full, peak / full       # 4.5 with all entries in one run, sorted as a whole


@pytest.mark.parametrize("held", [200, 10**9])
def test_small_chunks(spark, monkeypatch, held):
    """Runs of many spills, cut into small chunks and merged in a stream."""
    import pyarrow as pa

    monkeypatch.setattr(co, "CHUNK", 5)
    monkeypatch.setattr(co, "MERGED", 40)
    monkeypatch.setattr(co.HatTrie.__init__, "__defaults__", (held,))
    rows = made(4, 400)
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] or "und" for r in rows]), pa.array([r[0] for r in rows])], names=["lang", "text"])

    class Held:
        def __init__(self, value):
            self.value = value

    full = np.full(1024, 255, np.uint8)
    for depth in (2, 3):
        chunks = [c for k in range(0, len(rows), 100) for c in co._count_phrases(depth, Held(full), Held(full), 4)(iter([batch.slice(k, 100)]))]
        table = pa.Table.from_batches(chunks).sort_by("low")
        merged = pa.Table.from_batches(list(co.merge(depth, 1)(iter(table.to_batches(7)))))
        keys = list(zip(*[merged.column(f"w{k + 1}").to_pylist() for k in range(3)]))
        assert len(set(keys)) == len(keys)
        want: Counter = Counter()
        for text, _ in rows:
            for piece in re.split("[.,;:!?\n-\r]", text):
                n = len(re.findall("[^ \t]+", piece))
                want["all"] += max(0, n - depth + 1)
        assert sum(merged.column("n").to_pylist()) == want["all"]


def test_equal_hashes_of_keys():
    """Keys whose sort hash clashes are still told apart."""
    columns = [np.array([1, 2, 1, 2, 1], np.uint64)]
    (ids,), counts = co.summed(columns, np.ones(5, np.int64))
    assert dict(zip(ids.tolist(), counts.tolist())) == {1: 3, 2: 2}
    original = co.mix
    try:
        co.mix = lambda h: np.zeros_like(h)
        a, b = np.array([1, 2, 1, 2, 3], np.uint64), np.array([5, 5, 5, 5, 5], np.uint64)
        (x, y), counts = co.summed([a, b], np.ones(5, np.int64))
        assert dict(zip(zip(x.tolist(), y.tolist()), counts.tolist())) == {(1, 5): 2, (2, 5): 2, (3, 5): 1}
    finally:
        co.mix = original


def test_large_counts_are_exact(spark):
    a, left, right = 3_000_000_019, 3_000_000_021, 3_100_000_043
    row = spark.range(1).select(co._score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * right)
