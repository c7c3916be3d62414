from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{k % 977} item{k % 31}" for k in range(30_000))
ODD = [
    (1, "One two three four five six seven.\nA line of some length here\nshort", "en"),
    (2, None, None),
    (3, "", "fr"),
    (None, "a row without an id, and of some length\nA line of some length here", "en"),
    (4, "  a LINE of some length here \t\nÉté à la plage, ça va bien\r\n\n", "fr"),
    (5, LONG, "en"),
    (6, LONG + " end", "de"),
    (7, "One two three four five six seven.\nA line of some length here\nshort", "en"),
    (7, "One two three four five six seven.\nA line of some length here\nshort", "en"),
    (8, "日本語 テスト 😀 <|endoftext|> it's WE'LL\x00\x85ok", "es"),
    (9, "\n\n\n", "en"),
    (10, "!!! ### ,,,", "en"),
]
#: Columns with names that the operators use inside.
CLASH = "doc row key n text_ part positions score bucket h1 h2 rep class_id k next bands words c word label __doc id y".split()


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and further columns with clashing names."""
    rows = [(*r, *[None if k % 2 else "x" for k in range(len(CLASH))]) for r in ODD]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
