"""Exact dedup by refinement: odd rows and brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from conftest import ODD
from pyspark.sql import functions as F

from hourgrid.llm import exactdedup

ROWS = [(r[0], r[1]) for r in ODD]
SPACED = [
    (20, "a  b\tc"), (21, "a b c"), (22, "a b c "), (23, " a b c"), (24, "a\x0bb\x0c\r\nc"), (25, "A b c"), (26, "a\xa0b c"), (27, ""), (None, ""),
    (None, "only null ids"), (None, "only  null ids"), (30, "tie"), (30, "tie"), (31, "tie"), (40, "x" * 300 + "1"), (41, "x" * 300 + "2"), (42, "x" * 300 + "1"),
]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    """(doc_id, keep_id, group_size, digest) of each row."""
    groups: dict[str, list] = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, first[normal(t)], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows)


def found(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in exactdedup.classes(df, all_digests=True).collect())


def test_odd_rows(odd, empty):
    assert found(odd) == plain(ROWS)
    assert exactdedup.classes(empty).count() == 0
    assert exactdedup.drop_copies(empty).count() == 0


def test_white_space_ties_and_beginnings(spark):
    df = spark.createDataFrame(SPACED, "doc_id long, text string").repartition(4)
    assert found(df) == plain(SPACED)
    kept = Counter(r.digest for r in exactdedup.classes(df, all_digests=True).filter("kept").collect())
    assert set(kept.values()) == {1}, "one row of each group stays"


def test_settled_rows_have_no_digest(spark):
    """Only rows that share length and beginning with another are hashed whole."""
    rows = [(1, "alone in its length"), (2, "y" * 200 + "a"), (3, "y" * 200 + "b"), (4, "same"), (5, "same")]
    got = {r.doc_id: r.digest is not None for r in exactdedup.hashed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True, 5: True}


def test_full_map_changes_nothing(spark, monkeypatch):
    """With a bit map of one bucket nearly every row is marked; the groups stay the same."""
    monkeypatch.setattr(exactdedup, "BITS", 7)
    df = spark.createDataFrame(SPACED, "doc_id long, text string")
    assert found(df) == plain(SPACED)


def test_hot_group(spark):
    """A third of all rows are copies of one text."""
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot  text")).otherwise(F.concat(F.lit("row "), F.col("id").cast("string"))).alias("text")
    ).repartition(20)
    got = exactdedup.classes(df)
    assert got.filter("kept").count() == 2001
    assert got.filter("group_size = 1000").select("keep_id").distinct().collect() == [(0,)]


def test_table_of_first_copies(odd):
    out = exactdedup.drop_copies(odd)
    assert out.columns == odd.columns
    want = [(i, t) for i, t in ROWS if i == min((j for j, u in ROWS if normal(u) == normal(t) and j is not None), default=None)]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(want)
