"""Vector bin packing: examples placed under limits on tokens, segments and loss-bearing tokens.

One sequence (bin) is filled at a time. Of the waiting examples that fit what is left of
every limit, the one goes in whose demand vector has the greatest dot product with the
remaining capacities, both as shares of the limits; ties go to the earlier example.

``pack_examples`` places whole examples (instruction data: a segment a turn, the
answer's tokens bear loss). ``pack_texts`` tokenizes documents and may cut them: full
sequences are cut off first, the rests are packed by the heuristic, and a sequence
that nothing fits any more is filled up with the head of the example that fits best.
The last rests of a task are cut at powers of two, which need no padding.

Work is per input partition, in windows of ``POOL`` waiting examples, so memory is
bounded and nothing is shuffled. Sequence ids are the partition's number and a counter,
so a task that runs again gives the same rows.

Defined results: a null text or id is an empty text or a null id, the example is packed
like any other; repeated rows are packed each; an empty table gives no row; an example
that exceeds a limit alone has a null sequence (``pack_examples``) and is never cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hourgrid.llm import tokens
from hourgrid.llm.common import batches, texts, use_workers

TOKENS, SEGMENTS, LOSS = 2048, 256, 2048
POOL = 4096
END = 1
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long"
)


class Pool:
    """Waiting examples: their demands and labels, and which are still there."""

    def __init__(self, limits: np.ndarray):
        self.limits = limits.astype(np.float64)
        self.demand = np.zeros((0, len(limits)), np.int64)
        self.alive = np.zeros(0, bool)
        self.label: list = []

    def add(self, demands: list, labels: list) -> None:
        if labels:
            keep = np.flatnonzero(self.alive)
            self.demand = np.concatenate([self.demand[keep], np.array(demands, np.int64).reshape(len(labels), -1)])
            self.label = [self.label[k] for k in keep] + labels
            self.alive = np.ones(len(self.label), bool)

    def __len__(self) -> int:
        return int(self.alive.sum())

    def take(self, left: np.ndarray) -> int | None:
        """Index of the example of the greatest dot product that fits; it leaves the pool."""
        fits = self.alive & (self.demand <= left).all(axis=1)
        if not fits.any():
            return None
        score = self.demand @ (left / self.limits / self.limits)
        score[~fits] = -1
        k = int(score.argmax())
        self.alive[k] = False
        return k

    def to_cut(self, left: np.ndarray) -> int | None:
        """The longest example, if a head of it can fill what is left."""
        able = self.alive & (left[1:] >= np.minimum(self.demand[:, 1:], 1)).all(axis=1)
        if not able.any() or left[0] < 1:
            return None
        return int(np.where(able, self.demand[:, 0], -1).argmax())


def _number() -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 32


# --- whole examples ---------------------------------------------------------------

def pack_examples(
    df: DataFrame, id_col: str = "example_id", tokens_col: str = "n_tokens", segments_col: str = "n_segments",
    loss_col: str = "n_loss", limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS),
) -> DataFrame:
    """(example_id, sequence_id, position, n_tokens, n_segments, n_loss); null sizes count as zero."""
    use_workers(df.sparkSession)
    from pyspark.sql import functions as F

    size = lambda c: F.coalesce(df[c].cast("long"), F.lit(0).cast("long"))
    given = df.select(
        df[id_col].cast("string").alias("example_id"), size(tokens_col).alias("n_tokens"),
        size(segments_col).alias("n_segments"), size(loss_col).alias("n_loss"),
    )
    schema = "example_id string, sequence_id long, position long, n_tokens long, n_segments long, n_loss long"
    return given.mapInArrow(_examples_task(np.array(limits, np.int64)), schema)


def _examples_task(limits: np.ndarray):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, sequence = Pool(limits), _number()

        def close(until: int) -> Iterator[list]:
            nonlocal sequence
            while len(pool) > until:
                left, position = limits.copy(), 0
                while (k := pool.take(left)) is not None:
                    left = left - pool.demand[k]
                    yield [pool.label[k], sequence, position, *pool.demand[k].tolist()]
                    position += 1
                sequence += 1

        for batch in batches(rows, POOL):
            names = batch.column(0).to_pylist()
            demand = np.stack([np.maximum(batch.column(k).to_numpy(), 0) for k in (1, 2, 3)], axis=1).astype(np.int64)
            fits = (demand <= limits).all(axis=1)
            out = [[names[k], None, None, *demand[k].tolist()] for k in np.flatnonzero(~fits)]
            keep = np.flatnonzero(fits)
            pool.add(demand[keep].tolist(), [names[k] for k in keep])
            out += close(POOL)
            if out:
                yield _batch(out, EXAMPLE_TYPES)
        if out := list(close(0)):
            yield _batch(out, EXAMPLE_TYPES)

    return run


EXAMPLE_TYPES = {"example_id": pa.string(), **{k: pa.int64() for k in ("sequence_id", "position", "n_tokens", "n_segments", "n_loss")}}
PIECE_TYPES = {k.split()[0]: pa.int64() for k in PIECES.split(", ")}


def _batch(rows: list[list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


# --- documents --------------------------------------------------------------------

def pack_texts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS), end_id: int = END, with_ids: bool = False,
) -> DataFrame:
    """One row per piece (see ``PIECES``); with ``with_ids`` also its ids as little-endian 32-bit integers.

    Every token of a document bears loss, and a piece is a segment.
    """
    schema = PIECES + (", ids binary" if with_ids else "")
    task = _texts_task(tokenizer or tokens.default_path(), np.array(limits, np.int64), end_id, with_ids)
    return texts(df, id_col, text_col).mapInArrow(task, schema)


def _texts_task(path: str, limits: np.ndarray, end_id: int, with_ids: bool):
    most = int(min(limits[0], limits[2]))        # a full sequence

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pool, sequence = tokens.encoder(path), Pool(limits), _number()
        out: list[list] = []

        def piece(label, length: int, offset: int) -> tuple:
            """Row of the head of an example; what remains of it."""
            doc_id, ids, start, whole = label
            head, n = ids[: 4 * length], length
            row = [doc_id, start, n, zlib.crc32(head), whole, sequence, offset, n]
            out.append([*row, head] if with_ids else row)
            return doc_id, ids[4 * length:], start + n, whole

        def close(until: int) -> None:
            nonlocal sequence
            while len(pool) > until:
                left, offset = limits.copy(), 0
                while left[0] > 0 and (k := pool.take(left)) is not None:
                    piece(pool.label[k], int(pool.demand[k, 0]), offset)
                    offset += int(pool.demand[k, 0])
                    left = left - pool.demand[k]
                room = int(min(left[0], left[2]))
                if room and left[1] and (k := pool.to_cut(left)) is not None:
                    pool.label[k] = piece(pool.label[k], room, offset)
                    pool.demand[k, [0, 2]] -= room
                sequence += 1

        def tail() -> None:
            """The last examples, less than a full sequence: powers of two, which are not padded."""
            nonlocal sequence
            total = int(pool.demand[pool.alive, 0].sum())
            waiting = [pool.label[k] for k in np.flatnonzero(pool.alive)]
            while total:
                size, offset, segments = 1 << (min(total, most).bit_length() - 1), 0, 0
                while offset < size and segments < limits[1]:
                    label = waiting[0]
                    n = min(len(label[1]) // 4, size - offset)
                    rest = piece(label, n, offset)
                    waiting[0:1] = [rest] if rest[1] else []
                    offset, segments = offset + n, segments + 1
                total -= offset
                sequence += 1

        for batch in batches(rows, 1024):
            names = batch.column(0).to_pylist()
            labels, demands = [], []
            for doc_id, ids in zip(names, encoder.encode(batch.column(1))):
                ids = tokens.with_end(ids, end_id)
                n = len(ids) // 4
                label = (doc_id, ids, 0, n)
                while len(label[1]) // 4 >= most:
                    label = piece(label, most, 0)
                    sequence += 1
                if label[1]:
                    labels.append(label)
                    demands.append([len(label[1]) // 4, 1, len(label[1]) // 4])
            pool.add(demands, labels)
            close(POOL)
            if out:
                yield _batch(out, PIECE_TYPES | ({"ids": pa.binary()} if with_ids else {}))
                out.clear()
        while len(pool) and int(pool.demand[pool.alive, 0].sum()) >= most:
            close(len(pool) - 1)
        tail()
        if out:
            yield _batch(out, PIECE_TYPES | ({"ids": pa.binary()} if with_ids else {}))

    return run


def query(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    from hourgrid.llm.common import table

    return pack_texts(table(spark, sf_dir, "documents"))
