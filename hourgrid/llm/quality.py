"""Quality classifier: naive Bayes support vectors.

Features are hashed indicators of n-grams: words and word pairs (lower case), and runs of
one to three word shapes. A shape holds which kinds of characters a word has, how it
begins and ends, whether it repeats the word before, and whether its line stood in the text
before. A shape run also gives an indicator of the share of the text it makes up, by powers of two.

Each indicator is scaled by its log-count ratio between the classes, rows are brought to
unit length, and a linear model of hinge loss is fitted by dual coordinate descent. Its
margins become probabilities by a logistic curve fitted on a tenth of the sample that the
model does not see.

The fit takes a sample of at most about ``SAMPLE`` labelled rows a class (feature numbers only,
gathered on the driver: about 4 bytes a feature). The score reads the text alone.

Defined results: a null text is an empty text and gets the score of a row without features;
without labels of both classes every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import LOWER, NOT_SPACE, batches, crc_mod, mix, ngram_hash, runs, slabs, span_hash, texts, use_workers
from hourgrid.llm.training import labelled, platt, sigmoid

SAMPLE = 4000
FOLD = (5, 0)
ACCEPT = 0.3
BITS = 18
ALPHA, COST, EPOCHS = 1.0, 1.0, 12

KIND = np.zeros(256, np.uint16)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 1, 2, 4, 8
KIND[[ord(c) for c in ".,;:?'\"()-"]] = 16
KIND[ord("!")] = 32
KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 64


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of the indicators of a slab of texts, each once, in order of rows."""
    starts, ends, place = runs(data, offsets, NOT_SPACE)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(place))
    lower = LOWER[data]
    words = span_hash(lower, starts, ends)
    shape = np.bitwise_or.reduceat(KIND[data], starts).astype(np.uint64)
    shape |= KIND[data[starts]].astype(np.uint64) << np.uint64(7)
    shape |= KIND[data[ends - 1]].astype(np.uint64) << np.uint64(14)
    same = np.zeros(n, bool)
    same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    shape |= same.astype(np.uint64) << np.uint64(21)
    # Lines: a word is marked where its whole line stood in the text before.
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    head = np.ones(n, bool)
    head[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    with np.errstate(over="ignore"):
        whole = mix(np.add.reduceat(mix(words) * (2 * np.arange(n, dtype=np.uint64) - 2 * first.astype(np.uint64)[np.cumsum(head) - 1] + np.uint64(1)), first)
                    + doc[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(whole, kind="stable")
    again = np.zeros(len(first), bool)
    again[order[1:]] = whole[order[1:]] == whole[order[:-1]]
    shape |= again[np.cumsum(head) - 1].astype(np.uint64) << np.uint64(22)

    mask = np.uint64((1 << bits) - 1)
    length = np.maximum(np.diff(place), 1)
    found: list[np.ndarray] = []

    def put(rows: np.ndarray, hashes: np.ndarray) -> None:
        found.append((rows.astype(np.uint64) << np.uint64(bits)) | (hashes & mask))

    put(doc, mix(words + np.uint64(11)))
    pairs = ngram_hash(words, 2)
    within = doc[1:] == doc[:-1]
    put(doc[:-1][within], mix(pairs[within] + np.uint64(13)))
    for k in (1, 2, 3):
        grams = ngram_hash(mix(shape + np.uint64(k)), k)
        within = doc[k - 1:] == doc[: n - k + 1]
        keys = (doc[: n - k + 1][within].astype(np.uint64) << np.uint64(44)) | (mix(grams[within]) >> np.uint64(20))
        distinct, counts = np.unique(keys, return_counts=True)
        rows = (distinct >> np.uint64(44)).astype(np.int64)
        level = np.minimum(np.floor(-np.log2(counts / length[rows])), 9).astype(np.uint64)
        put(rows, mix(distinct & np.uint64((1 << 44) - 1)))
        put(rows, mix((distinct & np.uint64((1 << 44) - 1)) + (level + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))
    keys = np.unique(np.concatenate(found))
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & mask).astype(np.int64)


@dataclass
class Model:
    """Weights that already hold the ratios; ``ratio`` serves the length of a row."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    intercept: float
    constant: float | None = None

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for first, last, data, offsets in slabs(column):
            rows, cols = features(data, offsets)
            n = last - first
            dot = np.bincount(rows, self.weights[cols], n)
            size = np.sqrt(np.bincount(rows, self.squares[cols], n)) + 1e-12
            out[first:last] = sigmoid(self.slope * (dot / size + self.bias) + self.intercept)
        return out if self.constant is None else np.full(len(column), self.constant)


def descend(indptr: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, width: int, cost: np.ndarray, epochs: int) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; the last weight is the bias (a feature of value one)."""
    w, alpha = np.zeros(width + 1), np.zeros(len(y))
    sign = np.where(y == 1, 1.0, -1.0)
    square = np.add.reduceat(np.append(values * values, 0), indptr[:-1]) * (np.diff(indptr) > 0) + 1
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(y)):
            c, v = cols[indptr[i]: indptr[i + 1]], values[indptr[i]: indptr[i + 1]]
            gradient = sign[i] * (w[c] @ v + w[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[c] += step * v
                w[-1] += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def fit_rows(y: np.ndarray, lists: list[np.ndarray], bits: int = BITS) -> Model:
    width = 1 << bits
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(width), np.ones(width), 0, 1, 0, float(y.mean()) if len(y) else 0.5)
    order = np.random.default_rng(3).permutation(len(y))
    y, lists = y[order], [lists[k] for k in order]
    indptr = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    cols = np.concatenate(lists) if indptr[-1] else np.zeros(0, np.int32)
    del lists
    row_y = np.repeat(y, np.diff(indptr))
    p = np.bincount(cols[row_y == 1], minlength=width) + ALPHA
    q = np.bincount(cols[row_y == 0], minlength=width) + ALPHA
    ratio = np.log((p / ((y == 1).sum() + 2 * ALPHA)) / (q / ((y == 0).sum() + 2 * ALPHA)))
    ratio[(p == ALPHA) & (q == ALPHA)] = 0
    size = np.sqrt(np.bincount(np.repeat(np.arange(len(y)), np.diff(indptr)), (ratio * ratio)[cols], len(y))) + 1e-12
    values = (ratio[cols] / np.repeat(size, np.diff(indptr))).astype(np.float32)
    cost = COST * np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    seen = max(1, len(y) * 9 // 10)
    aside = slice(seen, None) if len(set(y[:seen])) == 2 and len(set(y[seen:])) == 2 and len(y) >= 100 else slice(None)
    if aside.start:
        w = descend(indptr[: seen + 1], cols, values, y[:seen], width, cost[:seen], EPOCHS)
    else:
        w = descend(indptr, cols, values, y, width, cost, EPOCHS)
    dots = np.bincount(np.repeat(np.arange(len(y)), np.diff(indptr)), w[cols] * values, len(y)) + w[-1]
    a, b = platt(dots[aside], y[aside])
    return Model(w[:-1] * ratio, ratio * ratio, float(w[-1]), a, b)


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, fold: tuple[int, int] = FOLD) -> Model:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            lists: list[np.ndarray] = []
            for first, last, data, offsets in slabs(batch.column(1)):
                r, c = features(data, offsets)
                lists += np.split(c.astype(np.int32), np.searchsorted(r, np.arange(1, last - first)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["y", "features"])

    rows = labelled(documents, labels, label_col, fold, sample).select("y", "text")
    got = rows.mapInArrow(run, "y long, features array<int>").toArrow()
    lists = [x for chunk in got.column(1).chunks for x in _lists(chunk)]
    y = got.column(0).to_numpy()
    del got
    order = sorted(range(len(y)), key=lambda k: (y[k], len(lists[k]), lists[k][:64].tobytes(), lists[k].sum()))      # not the order of tasks
    lists = [lists[k] for k in order]
    return fit_rows(y[order], lists)


def _lists(chunk: pa.ListArray) -> list[np.ndarray]:
    flat, offsets = chunk.flatten().to_numpy(), chunk.offsets.to_numpy()
    return np.split(flat, (offsets - offsets[0])[1:-1])


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document; the model (two arrays of ``2 ** BITS``) is broadcast."""
    given = texts(documents, id_col, text_col)
    shared = given.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1)))], names=["doc_id", "score"])

    return given.mapInArrow(run, "doc_id long, score double")


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score as a column, so that a filter needs no join."""
    use_workers(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(shared.value.scores(column.slice(k, 2048)) for k in range(0, len(column), 2048))]))

    return run(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; one fold of the labels is held out."""
    from hourgrid.llm.common import table

    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"))
    return score(documents, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), FOLD[0]) == FOLD[1]).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
