"""Labelled rows for the classifiers: a bounded sample, and the calibration of scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import crc_mod, texts


def labelled(
    documents: DataFrame, labels: DataFrame, label_col: str, fold: tuple[int, int], most: int, with_lang: bool = False,
) -> DataFrame:
    """(y, lang, text) of at most about ``most`` labelled documents of each class, outside the held-out fold.

    The fold is (modulus, remainder) of the id's crc32. A class of more rows is thinned by a
    hash of the id, so the sample does not depend on partitions. At most ``4 * most`` ids are
    broadcast, whatever the tables hold; documents are not shuffled.
    """
    mod, held = fold
    known = labels.select(labels.doc_id.cast("long").alias("id"), labels[label_col].cast("int").alias("y")).filter(
        "id IS NOT NULL AND y IN (0, 1)"
    )
    known = known.filter(crc_mod(F.col("id"), mod) != held).groupBy("id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    few = known.filter(F.when(F.col("y") == 1, share < most / max(sizes.get(1, 1), 1)).otherwise(share < most / max(sizes.get(0, 1), 1)))
    few = few.limit(4 * most)       # the share keeps it near 2 * most; this only states the bound
    lang = documents["lang"].cast("string") if with_lang and "lang" in documents.columns else F.lit(None).cast("string")
    given = texts(documents)
    if with_lang:
        given = documents.select(
            documents.doc_id.cast("long").alias("doc_id"), F.coalesce(documents.text, F.lit("")).alias("text"), lang.alias("lang")
        )
    else:
        given = given.withColumn("lang", lang)
    return given.join(F.broadcast(few), given.doc_id == few.id).select(F.col("y").cast("long").alias("y"), "lang", "text")


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and intercept of the logistic curve of labels over margins, with smoothed targets."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    positive, negative = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * margin + b)
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-6:
            break
    return a, b


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
