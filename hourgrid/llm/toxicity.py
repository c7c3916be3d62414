"""Toxicity: a convolutional text classifier trained in numpy.

A word (a run of ASCII letters and digits and of other characters, lower case) is the sum of
rows of a hashed embedding table: two for the word, so that two words rarely look alike,
and one for each of its heads of ``HEADS`` bytes. Filters of widths 1 to 3 run over the words.
Of each filter the largest value of every stretch of ``STRETCH`` words is kept, and a logistic
unit reads the largest and the mean of these over the whole text: the first tells that
something occurs, the second how densely. The gradient flows through the places of the
largest values. The first component of a row starts at its log-count ratio between the
classes, the others at random; rows that fewer than ``LEAST`` sampled documents use stay
zero, so unknown words say nothing.

Scores are calibrated by a logistic curve on a tenth of the sample that training does not
see, and moved so that ``REJECT`` is the balanced operating point there. Thresholds by
language are separate (``flag``): the score that best separates the classes of that language
in the sample (``REJECT`` where it has less than ``ENOUGH`` of either). The language is never
an input of the score.

Training takes at most about ``SAMPLE`` labelled documents a class (table rows of their
words, gathered on the driver). Whole texts are scored, never cut.

Defined results: a null text is an empty text, its one window is padding; without labels of both
classes every score is the share of label 1 (0 without labels); a null language has the common threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import ALNUM, LOWER, batches, crc_mod, hasher, mix, runs, slabs, texts
from hourgrid.llm.quality import _lists
from hourgrid.llm.training import labelled, platt, sigmoid

SAMPLE = 2500
FOLD = (3, 1)
REJECT = 0.7
ENOUGH = 30
BITS, DIM, FILTERS, WIDTHS = 18, 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 6, 50, 0.05
LEAST = 4           # documents of the sample that a table row must occur in; others stay zero
HEADS = (3, 4, 5, 6, 7)
ROWS = 2 + len(HEADS)
STRETCH = 32
GAP = max(WIDTHS) - 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word (``ROWS`` columns, 0: none) and each text's place in the words."""
    starts, ends, place = runs(data, offsets, ALNUM)
    mask = np.uint64((1 << BITS) - 1)
    hashes = hasher()
    sums = hashes.sums(LOWER[data])
    words = hashes.of(sums, starts, ends)
    rows = np.zeros((len(words), ROWS), np.int32)
    rows[:, 0] = (words & mask) + np.uint64(1)
    rows[:, 1] = (mix(words) >> np.uint64(64 - BITS)) + np.uint64(1)
    for k, n in enumerate(HEADS, 2):
        long = np.flatnonzero(ends - starts > n)
        rows[long, k] = (hashes.of(sums, starts[long], starts[long] + n) >> np.uint64(64 - BITS)) + np.uint64(1)
    return rows, place


def layout(words: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of each position, first positions of the stretches, and the texts' first stretches.

    Texts are parted by padding (row 0); every text has a stretch, an empty one of padding.
    """
    n = len(place) - 1
    size = np.diff(place)
    rows = np.zeros((len(words) + GAP * (n + 1), ROWS), np.int32)
    rows[np.arange(len(words)) + np.repeat(GAP * (np.arange(n) + 1), size)] = words
    first = place[:-1] + GAP * np.arange(n)
    count = np.maximum(1, -(-(size + GAP) // STRETCH))
    text = np.concatenate([[0], np.cumsum(count)])
    stretch = np.repeat(first, count) + STRETCH * (np.arange(text[-1]) - np.repeat(text[:-1], count))
    return rows, stretch, text


@dataclass
class Model:
    table: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    output: np.ndarray
    offset: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, rows: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray]:
        """Largest values by stretch and filter, all values by width, and the embedded words."""
        x = self.table[rows[:, 0]]
        for k in range(1, ROWS):
            x += self.table[rows[:, k]]
        values, windows = [], {}
        for k in WIDTHS:
            n = len(x) - k + 1
            z = self.biases[k] + sum(x[j: j + n] @ self.filters[k][j] for j in range(k))
            windows[k] = z
            values.append(np.maximum.reduceat(z, stretch, axis=0))
        return np.concatenate(values, axis=1), windows, x

    def read(self, values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the logistic unit reads (largest and mean over stretches), and the active values."""
        active = np.maximum(values, 0)
        mean = np.add.reduceat(active, text[:-1], axis=0) / np.diff(text)[:, None]
        return np.concatenate([np.maximum.reduceat(active, text[:-1], axis=0), mean.astype(np.float32)], axis=1), active

    def margins(self, words: np.ndarray, place: np.ndarray) -> np.ndarray:
        rows, stretch, text = layout(words, place)
        return self.read(self.pooled(rows, stretch)[0], text)[0] @ self.output + self.offset

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(column), self.constant)
        out = np.zeros(len(column))
        for first, last, data, offsets in slabs(column, 1 << 20):
            out[first:last] = sigmoid(self.slope * self.margins(*words_of(data, offsets)) + self.intercept)
        return out


def fit_rows(y: np.ndarray, lang: list, lists: list[np.ndarray], reject: float = REJECT) -> Model:
    rng = np.random.default_rng(5)
    table = rng.normal(0, 0.1, ((1 << BITS) + 1, DIM)).astype(np.float32)
    filters = {k: rng.normal(0, 0.3, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS}
    biases = {k: np.zeros(FILTERS, np.float32) for k in WIDTHS}
    model = Model(table, filters, biases, rng.normal(0.3, 0.1, 2 * FILTERS * len(WIDTHS)).astype(np.float32))
    if not len(y) or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 0.0
        return model
    order = rng.permutation(len(y))
    y, lang, lists = y[order], [lang[k] for k in order], [lists[k] for k in order]
    seen = len(y) * 9 // 10 if len(y) >= 100 else len(y)

    def gather(rows) -> tuple[np.ndarray, np.ndarray]:
        parts = [lists[k] for k in rows]
        return np.concatenate([np.zeros((0, ROWS), np.int32), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    # Words by the number of documents of each class that hold them.
    counts = np.zeros((2, len(table)))
    for k in range(seen):
        counts[y[k]][np.unique(lists[k])] += 1
    sizes = np.array([(y[:seen] == c).sum() for c in (0, 1)]) + 2.0
    ratio = np.log((counts[1] + 1) / sizes[1]) - np.log((counts[0] + 1) / sizes[0])
    table[:, 0] += (0.2 * np.clip(ratio, -4, 4)).astype(np.float32)
    rare = counts.sum(axis=0) < LEAST
    rare[0] = True
    table[rare] = 0
    for k in WIDTHS:
        filters[k][0, 0, :] = np.abs(filters[k][0, 0, :]) + 0.5

    weight = np.where(y == 1, 0.5 / (y[:seen] == 1).mean(), 0.5 / (y[:seen] == 0).mean())
    parameters = [model.output, *filters.values(), *biases.values()]
    memory = [np.full_like(p, 1e-3) for p in parameters]
    table_memory = np.full(len(table), 1e-3, np.float32)
    offset_memory = 1e-3
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(seen), max(1, seen // BATCH)):
            words, place = gather(rows)
            table_rows, stretch, text = layout(words, place)
            values, windows, x = model.pooled(table_rows, stretch)
            reading, active = model.read(values, text)
            p = sigmoid(reading @ model.output + model.offset)
            error = ((p - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            g_output = reading.T @ error
            half = active.shape[1]
            count = np.diff(text)
            g_values = np.repeat(error[:, None] * model.output[half:] / count[:, None], count, axis=0).astype(np.float32)
            best = np.stack([_argmax(active[:, c], text[:-1]) for c in range(half)], axis=1)
            np.add.at(g_values, (best, np.arange(half)[None]), error[:, None] * model.output[:half])
            g_values *= values > 0
            g_filters, g_biases, touched, g_touched = [], [], [], []
            for f, k in enumerate(WIDTHS):
                z, part = windows[k], g_values[:, f * FILTERS: (f + 1) * FILTERS]
                best = np.stack([_argmax(z[:, c], stretch) for c in range(FILTERS)], axis=1)
                g = np.zeros_like(filters[k])
                for j in range(k):
                    at = best + j
                    g[j] = np.einsum("dc,dce->ec", part, x[at])
                    touched.append(at.ravel())
                    g_touched.append((part[:, :, None] * filters[k][j].T[None]).reshape(-1, DIM))
                g_filters.append(g)
                g_biases.append(part.sum(axis=0))
            for value, held, g in zip(parameters, memory, [g_output, *g_filters, *g_biases]):
                held += g * g
                value -= rate * g / np.sqrt(held)
            offset_memory += float(error.sum()) ** 2
            model.offset -= rate * float(error.sum()) / offset_memory ** 0.5
            at, grad = np.concatenate(touched), np.concatenate(g_touched)
            live = np.abs(grad).sum(axis=1) > 0
            at, grad = at[live], grad[live]
            distinct, inverse = np.unique(table_rows[at].T.ravel(), return_inverse=True)
            g = np.zeros((len(distinct), DIM), np.float32)
            np.add.at(g, inverse, np.tile(grad, (ROWS, 1)))
            g[rare[distinct]] = 0
            table_memory[distinct] += (g * g).mean(axis=1)
            table[distinct] -= rate * g / np.sqrt(table_memory[distinct])[:, None]
    margin = np.concatenate([model.margins(*gather(range(k, min(k + 200, len(y))))) for k in range(0, len(y), 200)])
    aside = slice(seen, None) if seen < len(y) and len(set(y[seen:])) == 2 else slice(None)
    model.slope, model.intercept = platt(margin[aside], y[aside])
    model.slope = max(model.slope, 0.1)
    best = best_cut(margin[aside], y[aside])
    model.intercept = float(np.log(reject / (1 - reject)) - model.slope * best)
    final = sigmoid(model.slope * margin + model.intercept)
    for name in sorted({x for x in lang if x is not None}):
        own = np.array([x == name for x in lang])
        if min((y[own] == 1).sum(), (y[own] == 0).sum()) >= ENOUGH:
            model.thresholds[name] = best_cut(final[own], y[own])
    return model


def best_cut(score: np.ndarray, y: np.ndarray) -> float:
    """The cut of the best balanced accuracy, in the middle of the widest such gap."""
    order = np.argsort(score, kind="stable")
    s, t = score[order], y[order]
    below = np.concatenate([[0], np.cumsum(t == 0)]) / max(1, (t == 0).sum())
    above = 1 - np.concatenate([[0], np.cumsum(t == 1)]) / max(1, (t == 1).sum())
    edge = np.concatenate([[s[0] - 1e-6], (s[1:] + s[:-1]) / 2, [s[-1] + 1e-6]])
    width = np.concatenate([[0], np.diff(s), [0]])
    gain = below + above
    top = gain >= gain.max() - 1e-9
    return float(edge[np.where(top, width, -1).argmax()])


def _argmax(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Place of the first largest value of each segment."""
    top = np.maximum.reduceat(values, first)
    segment = np.zeros(len(values), np.int64)
    segment[first[1:]] = 1
    segment = np.cumsum(segment)
    hit = np.flatnonzero(values == top[segment])
    own = segment[hit]
    keep = np.ones(len(hit), bool)
    keep[1:] = own[1:] != own[:-1]
    return hit[keep]


def fit(documents: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE, fold: tuple[int, int] = FOLD, reject: float = REJECT) -> Model:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            lists: list[np.ndarray] = []
            for _, _, data, offsets in slabs(batch.column(2)):
                words, place = words_of(data, offsets)
                lists += np.split(words.ravel(), ROWS * place[1:-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["y", "lang", "words"])

    rows = labelled(documents, labels, label_col, fold, sample, with_lang=True)
    got = rows.mapInArrow(run, "y long, lang string, words array<int>").toArrow()
    lists = [x.reshape(-1, ROWS) for chunk in got.column(2).chunks for x in _lists(chunk)]
    y, lang = got.column(0).to_numpy(), got.column(1).to_pylist()
    order = sorted(range(len(y)), key=lambda k: (y[k], len(lists[k]), lists[k].tobytes()))
    return fit_rows(y[order], [lang[k] for k in order], [lists[k] for k in order], reject)


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document; the model (``2 ** BITS`` embeddings) is broadcast."""
    given = texts(documents, id_col, text_col)
    shared = given.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1)))], names=["doc_id", "score"])

    return given.mapInArrow(run, "doc_id long, score double")


def flag(scored: DataFrame, lang: str, model: Model, reject: float = REJECT) -> DataFrame:
    """Adds ``threshold`` (by the language column) and ``flagged``."""
    cut = F.lit(reject)
    for name, value in model.thresholds.items():
        cut = F.when(F.col(lang) == name, F.lit(value)).otherwise(cut)
    return scored.withColumn("threshold", cut).withColumn("flagged", F.col("score") >= F.col("threshold"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; one fold of the labels is held out."""
    from hourgrid.llm.common import table

    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"))
    return score(documents, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), FOLD[0]) == FOLD[1]).alias("held_out"), "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )
