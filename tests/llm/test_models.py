"""Classifiers, language model, pipeline."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import ODD, SF
from pyspark.sql import functions as F

import corpus_pipeline
from hourgrid.llm import quality, toxicity
from hourgrid.llm.common import crc_mod
from hourgrid.llm.training import platt

MEDIUM = "/root/testdata/sf0.01"
ROWS = [(r[0], r[1]) for r in ODD]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MEDIUM}/labels.parquet")


def held_out(spark, query, label):
    got = {r.doc_id: r for r in query(spark, MEDIUM).collect()}
    pairs = [(r[label], got[r.doc_id]) for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()]
    return [(y, r.predicted) for y, r in pairs if r.held_out], got


def test_quality_held_out(spark):
    pairs, got = held_out(spark, quality.query, "quality")
    assert np.mean([y == p for y, p in pairs]) > 0.9
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_toxicity_held_out(spark):
    pairs, got = held_out(spark, toxicity.query, "toxic")
    assert np.mean([y == p for y, p in pairs]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_odd_rows(spark, odd, empty, labels, module, label):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = module.fit(documents, labels)
    got = module.score(odd, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in ROWS)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 7)}) == 1
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert module.score(empty, model).count() == 0
    # The label, not the order or the partitions of the rows, makes the model.
    again = module.fit(documents.repartition(7), labels.unionByName(labels).repartition(3))
    assert [r.score for r in module.score(odd.orderBy("text", "doc_id"), again).collect()] == [r.score for r in module.score(odd.orderBy("text", "doc_id"), model).collect()]


@pytest.mark.parametrize("module, label, none", [(quality, "quality", 0.5), (toxicity, "toxic", 0.0)])
def test_classifiers_without_labels(spark, odd, module, label, none):
    schema = f"doc_id long, {label} int, text string"
    few = lambda rows: spark.createDataFrame(rows, schema)
    model = module.fit(odd, few([]))
    assert {r.score for r in module.score(odd, model).collect()} == {none}
    one = module.fit(odd, few([(1, 1, "x"), (7, 1, None), (None, 0, "x"), (8, None, "x")]), fold=(1, 5))
    assert {r.score for r in module.score(odd, one).collect()} == {1.0}
    both = module.fit(odd, few([(1, 1, "x"), (5, 0, "x"), (5, 0, "x"), (4, 0, None)]), fold=(1, 5))
    assert all(0 <= r.score <= 1 for r in module.score(odd, both).collect())


def test_quality_features_are_indicators():
    text = "Aa bb Aa bb\nAa bb Aa bb\nzz !!".encode()
    rows, cols = quality.features(np.frombuffer(text + text, np.uint8), np.array([0, len(text), 2 * len(text)]))
    assert len(set(zip(rows.tolist(), cols.tolist()))) == len(rows)
    assert set(cols[rows == 0]) == set(cols[rows == 1])


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    y = (x @ [1, -2, 0.5, 0, 1] > 0).astype(int)
    w = quality.descend(np.arange(0, 1001, 5), np.tile(np.arange(5), 200), x.ravel(), y, 5, np.full(200, 10.0), 50)
    assert np.mean((x @ w[:5] + w[5] > 0) == y) > 0.97


def test_calibration():
    rng = np.random.default_rng(1)
    m = rng.normal(size=5000)
    y = (rng.random(5000) < 1 / (1 + np.exp(-(2 * m - 0.5)))).astype(int)
    a, b = platt(m, y)
    assert abs(a - 2) < 0.3 and abs(b + 0.5) < 0.2


def test_language_thresholds(spark):
    model = toxicity.Model(None, {}, {}, None, thresholds={"en": 0.9})
    df = spark.createDataFrame([(1, "en", 0.8), (2, "fr", 0.8), (3, None, 0.8)], "doc_id long, lang string, score double")
    assert [r.flagged for r in toxicity.flag(df, "lang", model).orderBy("doc_id").collect()] == [False, True, True]


# --- pipeline -------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        seen[name] = (before, after)
        docs = spark.createDataFrame(list(after.values()), docs.schema)
    before, after = seen["quality"]
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.score(spark.read.parquet(f"{SF}/documents.parquet"), model).collect()}
    assert set(after) == {i for i, _ in before if scores[i] >= 0.3}
    before, after = seen["line_dedup"]
    for (i, text), keep in zip(before, brute.keep_lines(before)):
        assert after[i].text == "\n".join(x for x, k in zip(text.split("\n"), keep) if k)
        assert after[i].n_chars == len(after[i].text)
    before, after = seen["near_duplicates"]
    before.sort()
    roots, _ = brute.groups([t for _, t in before])
    assert set(after) == {before[r][0] for r in roots}
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(after) == {i for i, t in before if not brute.contaminated(t, items)[3]}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == len(after)
    total = lambda df: Counter({r.doc_id: r.n for r in df.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()})
    assert total(corpus_pipeline.run(spark, SF)) == total(packed)


def test_fold_of_null_id(odd):
    assert odd.filter("doc_id IS NULL").select((crc_mod(F.col("doc_id"), 5) == 0).alias("h")).first().h is True
