"""The whole pipeline on odd tables: nulls, empty and long texts, repeated rows, clashing columns, no rows."""

from __future__ import annotations

import pytest
from conftest import CLASH, LONG, ODD
from pyspark.sql import functions as F

import corpus_pipeline

ITEM = "this is a passage of the benchmark that nobody should ever train on at all"


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
        full = [(i, t, lang, "s", None if t is None else len(t), *["x"] * len(CLASH)) for i, t, lang in rows]
        spark.createDataFrame(full, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([(i, 1, 0) for i, _, _ in rows if i is not None] or [(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame([(1, ITEM), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def stage_results(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        out[name] = docs
        if name != "packing":
            assert docs.columns == columns
    return out


def test_odd_rows(spark, folder):
    """Labels of one kind accept all, so each later stage can be followed row by row."""
    rows = [*ODD, (50, f"own words before {ITEM} and after", "en"), (51, LONG, "en")]
    got = stage_results(spark, folder(rows))
    ids = lambda name: sorted((r.doc_id for r in got[name].select("doc_id").collect()), key=lambda i: (i is None, i or 0))
    assert got["quality"].count() == got["line_dedup"].count() == len(rows)
    kept = ids("near_duplicates")
    assert kept.count(1) == kept.count(5) == 1 and None in kept and 2 in kept
    assert 50 in kept and 50 not in ids("decontamination")
    pieces = got["packing"]
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert {r.doc_id for r in whole.collect()} == set(ids("decontamination"))


def test_no_documents(spark, folder):
    got = stage_results(spark, folder([]))
    assert all(df.count() == 0 for df in got.values())


def test_run_equals_stages(spark, folder):
    sf_dir = folder(ODD)
    assert corpus_pipeline.run(spark, sf_dir).count() == stage_results(spark, sf_dir)["packing"].count()
