"""Suffix tree scores against a plain tree of dictionaries, sums of probabilities, and held-out texts."""

from __future__ import annotations

import math
import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD

from hourgrid.llm import suffixtree as st
from hourgrid.llm.common import trimmed

MEDIUM = "/root/testdata/sf0.01"
ROWS = [(r[0], r[1]) for r in ODD]
END = "\n"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(brute.UPPER)) + [END]


class Plain:
    """The model with dictionaries: counts of all runs, kept contexts, spelling."""

    def __init__(self, texts, least=st.LEAST, diverge=st.DIVERGE, depth=st.DEPTH):
        self.words, self.runs, self.codes = Counter(), Counter(), Counter()
        for text in texts:
            w = tokens_of(text)
            self.words.update(w)
            for size in range(2, depth + 2):
                self.runs.update(tuple(w[k: k + size]) for k in range(len(w) - size + 1))
            for x in w:
                self.codes.update(self.spelled(x))
        self.n, self.v, self.depth = sum(self.words.values()), len(self.words), depth
        places = lambda c: self.words[c[0]] if len(c) == 1 else self.runs[c]
        nexts = defaultdict(dict)
        for run, n in self.runs.items():
            if n >= st.REPEAT and places(run[:-1]) >= least:
                nexts[run[:-1]][run[-1]] = n
        self.kept = {}
        for c, own in nexts.items():
            many, said, kinds = places(c), sum(own.values()), len(own)
            rest, total = many - said + kinds, many + kinds
            gain = (many - said) * math.log(rest / (total - 1))
            for w, n in own.items():
                q = self.words[w] / self.n if len(c) == 1 else self.runs[c[1:] + (w,)] / places(c[1:])
                gain += n * math.log((n - 1 + rest * q) / (total - 1) / q)
            if gain >= diverge + st.WEIGHT * kinds:
                self.kept[c] = own, rest, total
        self.fronts = defaultdict(dict)
        for code, n in self.codes.items():
            for k in range(len(code)):
                if k or code[-2] != END:
                    at = self.fronts[code[-k - 1: -1] if k else ()]
                    at[code[-1]] = at.get(code[-1], 0) + n

    @staticmethod
    def spelled(word):
        raw = (END,) * st.SPELL + (tuple(word.encode()) + (" ",) if word != END else (END,))
        return [raw[k: k + st.SPELL + 1] for k in range(len(raw) - st.SPELL)]

    def symbol(self, code):
        p = 1 / st.SYMBOLS
        before = sum(x != END for x in code[:-1])
        for k in range(st.SPELL + 1):
            own = self.fronts.get(code[-k - 1: -1] if k else ())
            if own and k <= before + 1 and (k or before):
                p = (own.get(code[-1], 0) + len(own) * p) / (sum(own.values()) + len(own))
        return p

    def spelling(self, word):
        return math.prod(self.symbol(c) for c in self.spelled(word))

    def probability(self, word, past):
        p = (self.words[word] + self.v * self.spelling(word)) / (self.n + self.v) if self.n else self.spelling(word)
        for k in range(1, min(self.depth, len(past)) + 1):
            if past[-k:] in self.kept:
                own, rest, total = self.kept[past[-k:]]
                p = (own.get(word, 0) + rest * p) / total
        return p

    def score(self, text):
        w = tokens_of(text)
        return sum(math.log10(self.probability(x, tuple(w[:k]))) for k, x in enumerate(w))


def made(seed, count):
    rng = random.Random(seed)
    fixed = ["go to market now", "ran to market later", "the quick brown fox jumps over the lazy dog", "New York City hall is closed", "é à la plage ça va"]
    return [
        " ".join(rng.choice(fixed) if rng.random() < 0.3 else f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(rng.randrange(25)))
        for _ in range(count)
    ]


def rows_of(texts):
    return list(enumerate(texts))


def scored(df, training, **how):
    return {r.doc_id: r for r in st.score(df, training, **how).collect()}


@pytest.fixture(scope="module")
def corpus(spark):
    texts = made(1, 400)
    df = spark.createDataFrame(rows_of(texts), "doc_id long, text string").repartition(4).cache()
    return texts, df, df.filter("doc_id % 5 <> 2"), Plain([t for k, t in enumerate(texts) if k % 5 != 2])


@pytest.mark.parametrize("how", [{}, {"tokens": 40, "most": 60}, {"tokens": 0, "most": 0}], ids=["held", "half held", "none held"])
def test_plain_tree(corpus, how):
    """Also with most tokens and contexts looked up in the written tables."""
    texts, df, training, plain = corpus
    assert len(plain.kept) > 20 and {len(c) for c in plain.kept} == {1, 2, 3}
    got = scored(df, training, **how)
    for k, text in enumerate(texts):
        w = tokens_of(text)
        assert math.isclose(got[k].score, plain.score(text), rel_tol=1e-6, abs_tol=1e-6), (k, text)
        assert math.isclose(got[k].base_score, sum(math.log10((plain.words[x] + 1) / (plain.n + plain.v + 1)) for x in w), rel_tol=1e-9)
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(w), sum(x in plain.words for x in w), plain.n)


def test_probabilities_sum_to_one(corpus):
    """Known tokens, and all unknown ones by the mass of their spelling."""
    plain = corpus[3]
    known = sum(plain.spelling(w) for w in plain.words)
    for past in [(), *list(plain.kept)[:40]]:
        all_known = sum(plain.probability(w, past) for w in plain.words)
        unknown = plain.v * (1 - known) / (plain.n + plain.v)
        for k in range(1, len(past) + 1):
            if past[-k:] in plain.kept:
                unknown *= plain.kept[past[-k:]][1] / plain.kept[past[-k:]][2]
        assert math.isclose(all_known + unknown, 1, rel_tol=1e-9), past


def test_spelling_is_a_distribution(spark, documents):
    """After any bytes the symbols that may follow share all of it, with all codes held or few."""
    counts = st.count(documents)
    inner = [b for b in range(256) if b not in (9, 10, 11, 12, 13, 32)]
    for most in (1 << 20, 500):
        original, st.CODES = st.CODES, most
        try:
            h = st.held(counts, *st.tree(documents, counts), st.DEPTH)
        finally:
            st.CODES = original
        assert len(h.codes) <= most
        speller = st.Speller(h.codes, h.code_counts, h.code_totals)
        for past in (b"", b"t", b"th", b"the", b"ation", "\xe9l".encode(), b"\x00\xff\x01"):
            front = (bytes([st.LAST]) * st.SPELL + past)[-st.SPELL:]
            follow = [*inner, st.BLANK if past else st.LAST]
            assert len(follow) == st.SYMBOLS
            codes = np.array([int.from_bytes(front + bytes([b]), "big") for b in follow], np.uint64)
            assert math.isclose(speller.probability(codes).sum(), 1, rel_tol=1e-9)
            assert np.allclose(speller(codes), np.log10(speller.probability(codes)))


def test_speller_table_with_clashes(spark, documents):
    h = st.held(st.count(documents), *st.tree(documents, st.count(documents)), st.DEPTH)
    speller = st.Speller(h.codes, h.code_counts, h.code_totals)
    speller.code, speller.value, speller.BITS = speller.code[:16], speller.value[:16], 4
    codes = np.random.default_rng(0).choice(h.codes, 500)
    for _ in range(3):
        assert np.allclose(speller(codes), np.log10(speller.probability(codes)))


def test_odd_rows(odd, empty):
    training = odd.filter("doc_id <> 5 OR doc_id IS NULL")
    plain = Plain([t for i, t in ROWS if i != 5])
    want = Counter()
    for i, t in ROWS:
        w = tokens_of(t)
        want[(i, len(w), sum(x in plain.words for x in w), plain.n, round(plain.score(t), 3))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.score, 3)) for r in st.score(odd, training).collect()) == want
    assert st.score(empty, odd).count() == 0
    bare = st.score(odd, empty).collect()
    assert {r.base_score for r in bare} == {0.0}
    assert all(math.isclose(r.score, math.log10(1 / st.SYMBOLS), rel_tol=1e-9) for r in bare if r.doc_id in (2, 3))


def test_tree_grows_with_the_corpus(spark):
    """The least count is a number, not a share: other text does not take contexts away."""
    rare = ["jwkp bbbn rrrt " * 3] * 15
    other = [f"alpha plain words {k % 97} gamma {k % 89}" for k in range(3000)]
    sizes = []
    for texts in (rare, rare + other):
        df = spark.createDataFrame(rows_of(texts), "doc_id long, text string")
        states, entries = st.tree(df, st.count(df))
        key = int(st.context_of([st.span_hash(np.frombuffer(b"jwkp", np.uint8), np.array([0]), np.array([4]))]).view(np.int64)[0])
        assert states.filter(f"context = {key}").count() == 1
        sizes.append(states.count())
    assert sizes[1] > sizes[0]


def test_better_than_without_contexts_on_held_out(spark):
    from hourgrid.llm.common import crc_mod, table

    documents = table(spark, MEDIUM, "documents")
    training = documents.filter(crc_mod(documents.doc_id, 7) != 2)
    held = documents.filter(crc_mod(documents.doc_id, 7) == 2)
    whole, flat = scored(held, training), scored(held, training, diverge=1e18)
    gains = [whole[k].score - flat[k].score for k in whole]
    assert sum(gains) > 0 and np.mean([g >= 0 for g in gains]) > 0.6


def test_contexts_do_not_wait_for_rare_next_tokens(corpus):
    """Contexts are held by their places, next tokens by their own counts: a few wide contexts do not fill what a task holds."""
    texts, df, training, plain = corpus
    learnt = training.select("text")
    counts = st.count(learnt)
    states, entries = st.tree(learnt, counts)
    most = states.count() + 5
    assert most < entries.count() == sum(len(own) for own, _, _ in plain.kept.values())
    h = st.held(counts, states, entries, st.DEPTH, most=most)
    assert h.whole and len(h.contexts) == len(plain.kept)
    assert 0 < len(h.runs) <= most and h.said == min(n for own, _, _ in plain.kept.values() for n in own.values() if n >= h.said)
    got = scored(df, training, most=most)
    assert all(math.isclose(got[k].score, plain.score(text), rel_tol=1e-6, abs_tol=1e-6) for k, text in enumerate(texts))


def test_threshold(spark):
    counts = spark.range(1, 101).withColumnRenamed("id", "n")
    assert st.threshold(counts, "n", 10) == 91 and st.threshold(counts, "n", 100) == 1
    wide = spark.range(8000, 8200).withColumnRenamed("id", "n")
    assert st.threshold(wide, "n", 7) == 1 << 62 and st.threshold(wide, "n", 10) == 8192 and st.threshold(wide, "n", 200) == 4096


def test_codes_that_are_not_held(corpus, spark, monkeypatch):
    """Scores do not depend on how many codes of the spelling a task holds, also of unknown words and of ends."""
    _, _, training, plain = corpus
    texts = ["w1 w2 qqzzx", "", "w7 \xe9 \xe9t\xe9 the", "plague-w9 w299 w299", "xylophone qqzzx to market now"]
    df = spark.createDataFrame(rows_of(texts), "doc_id long, text string")
    counts = st.count(training.select("text"))
    codes = st.spelling(counts)
    value = {r.key & (1 << 40) - 1: r for r in st.code_values(codes).collect()}
    speller = st.Speller(*[np.array(c) for c in zip(*[(np.uint64(k), r.n, r.n) for k, r in value.items()])])
    keys = np.array(list(value), np.uint64)
    assert np.allclose(np.log10(speller.probability(keys)), [r.value for r in value.values()], rtol=1e-12)
    for most in (60, 0):
        monkeypatch.setattr(st, "CODES", most)
        got = scored(df, training)
        for k, text in enumerate(texts):
            assert math.isclose(got[k].score, plain.score(text), rel_tol=1e-9, abs_tol=1e-9), (most, text)


@pytest.mark.parametrize("held", [1, 50, 10**9])
def test_counts_given_on_in_parts(monkeypatch, held):
    """However little a task holds, each part has a token once, with its bytes, and the sums are those of a dictionary."""
    monkeypatch.setattr(st, "HELD", held)
    monkeypatch.setattr(st, "SLAB", 400)
    texts = [*made(9, 200), "", "A a \xc9t\xe9", None]
    given = [pa.RecordBatch.from_arrays([pa.array(texts[k: k + 70], pa.string())], names=["text"]) for k in range(0, len(texts), 70)]
    parts, found = list(st._count(iter(given))), Counter()
    for part in parts:
        keys, words, counts = (c.to_pylist() for c in part.columns)
        assert len(set(keys)) == len(keys) and part.schema.types == [pa.int64(), pa.binary(), pa.int64()]
        found.update({END if w is None else w.decode(): n for w, n in zip(words, counts)})
    assert found == Counter(w for text in texts for w in tokens_of(text)) and (len(parts) > 1) == (held < 10**9)


def test_lent_memory_goes_back(tmp_path):
    """A worker that is done keeps little of what its task took, also of many small arrays."""
    code = """
import re, sys
import numpy as np, pyarrow as pa
from hourgrid.llm.common import trimmed
rss = lambda: int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
def work(rows):
    for batch in rows:
        held = []
        for _ in range(4000):
            held.append(np.ones(1 << 13))
            keep.append(np.ones(200))           # between them, so that the heap does not shrink by itself
        yield batch
keep = []
before = rss()
work = trimmed(work) if sys.argv[1] == "trimmed" else work
assert [b.num_rows for b in work(iter([pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["x"])]))] == [2]
print(rss() - before)
"""
    kept = float(subprocess.run([sys.executable, "-c", code, "trimmed"], capture_output=True, text=True, check=True, cwd=ROOT).stdout)
    assert kept < 100, kept     # of 250 MB


def test_trimmed_passes_errors_on():
    def work(rows):
        yield from rows
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        list(trimmed(work)(iter([1, 2])))
