"""N-gram Jaccard join by MinHash banding.

A document is the set of its runs of five words (runs of ASCII letters and digits and of
other characters, A-Z lower-cased; a shorter text is one run of its words). Two documents
are linked when their sets have a Jaccard similarity of at least 0.8.

1. Documents with equal sets are one class; only a representative (the smallest id) goes on,
   with its number of copies.
2. MinHash signatures are cut into bands; ``plan_bands`` takes as many bands as the target
   recall at the threshold needs. Band hashes are shuffled, and of each bucket with two or
   more classes the smallest representative leads. A class takes part in the group of each of
   its leaders, so two classes with a band in common meet in a group; a pair that has several
   leaders in common is compared under the smallest alone.
3. A group is cut into blocks of about ``BLOCK`` shingles, and each pair of blocks is a task of its
   own, whatever the group's size. There, candidate pairs are verified on the full sets. What
   comes out is not pairs but, for each class, the number of linked documents and one link
   to the smallest class of its connected part, so the output grows with the classes.
4. Components of these links give the classes' group ids.

Only candidates' texts are shuffled to the groups. Nothing is capped, and no link found is lost.

Defined results: a document without words (null or empty too) has no link, its group is its own id;
a row without an id stands after all ids (a group of such rows alone has a null class_id);
rows that share an id count their links together, equal ones are copies; an empty table
gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import ALNUM, LOWER, batches, free_names, mix, ngram_hash, runs, signed, slabs, span_hash, texts
from hourgrid.llm.components import components
from hourgrid.session import materialize

WORDS, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.999, 6
BLOCK = 120_000         # shingles of a block
UNNAMED = 1 << 62       # ids are smaller; rows without one take a number from here on


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` values so that a pair at the threshold shares one with the target probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a slab, each once a text and sorted, and each text's place in them."""
    starts, ends, place = runs(data, offsets, ALNUM)
    words = span_hash(LOWER[data], starts, ends)
    count = np.diff(place)
    text = np.repeat(np.arange(len(count)), count)
    grams = ngram_hash(words, n)
    within = text[: len(grams)] == text[n - 1:] if len(grams) else np.zeros(0, bool)
    rows, values = [text[: len(grams)][within]], [grams[within]]
    for k in np.flatnonzero((count > 0) & (count < n)):
        rows.append(np.array([k]))
        values.append(ngram_hash(words[place[k]: place[k + 1]], int(count[k])) ^ np.uint64(count[k]))
    rows, values = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    rows, values = rows[keep], values[keep]
    return values, np.searchsorted(rows, np.arange(len(count) + 1))


def band_hashes(values: np.ndarray, place: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts with shingles, bands) hashes of the signature's bands."""
    some = np.flatnonzero(np.diff(place))
    factors = np.random.default_rng(11).integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(some), bands), np.uint64)
    if not len(some):
        return out
    with np.errstate(over="ignore"):
        for b in range(bands):
            for r in range(rows):
                least = np.minimum.reduceat(values * factors[b * rows + r], place[some])
                out[:, b] = out[:, b] * np.uint64(0x9E3779B97F4A7C15) + mix(least)
            out[:, b] = mix(out[:, b] + np.uint64(b))
    return out


SIGNED = "doc long, h1 long, h2 long, n long, bands array<long>"


def _sign(n: int, bands: int, rows: int):
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(given):
            h1, h2, size, lists = [], [], [], []
            for _, _, data, offsets in slabs(batch.column(1)):
                values, place = shingles(data, offsets, n)
                digest = _digest(values, place)
                h1.append(digest[0])
                h2.append(digest[1])
                count = np.diff(place)
                size.append(count)
                hashes = band_hashes(values, place, bands, rows)
                filled = np.zeros((len(count), bands), np.uint64)
                filled[count > 0] = hashes
                lists.append(filled)
            flat = signed(np.concatenate(lists).ravel())
            offsets32 = np.arange(batch.num_rows + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed(np.concatenate(h1))), pa.array(signed(np.concatenate(h2))),
                 pa.array(np.concatenate(size)), pa.ListArray.from_arrays(pa.array(offsets32), pa.array(flat))],
                names=["doc", "h1", "h2", "n", "bands"],
            )

    return run


def _digest(values: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set (sums over its members)."""
    out = []
    with np.errstate(over="ignore"):
        for k in (21, 22):
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(mix(values ^ mix(np.array([k], np.uint64))), out=sums[1:])
            out.append(mix(sums[place[1:]] - sums[place[:-1]] + np.uint64(k)))
    return out[0], out[1]


GROUPED = "rep long, root long, links long"


def _verify(n: int, bands: int, rows: int, over: int, under: int):
    """Of one pair of blocks: links of each class with the others, over / under is the threshold."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        reps, h1, h2 = (table.column(c).to_numpy() for c in ("rep", "h1", "h2"))
        copies, block = table.column("copies").to_numpy(), table.column("block").to_numpy()
        parts, sizes, hashes, digests = [], [], [], []
        for _, _, data, offsets in slabs(table.column("text")):
            values, place = shingles(data, offsets, n)
            digests.append(signed(np.stack(_digest(values, place), axis=1).ravel()).reshape(-1, 2))
            parts.append(values)
            sizes.append(np.diff(place))
            filled = np.zeros((len(sizes[-1]), bands), np.uint64)
            filled[sizes[-1] > 0] = band_hashes(values, place, bands, rows)
            hashes.append(filled)
        values, size, digest, hashes = (np.concatenate(x) for x in (parts, sizes, digests, hashes))
        # The id may stand on several rows: one row with the class's set stays.
        own = (digest[:, 0] == h1) & (digest[:, 1] == h2)
        _, once = np.unique(np.where(own, reps, -1), return_index=True)
        keep = once[own[once]]
        keep = keep[np.argsort(size[keep], kind="stable")]
        start = np.concatenate([[0], np.cumsum(size)])
        leaders = [tuple(x) for x in table.column("lower").take(pa.array(keep)).to_pylist()]
        patterns = list(dict.fromkeys(leaders))
        pattern = np.array([patterns.index(x) for x in leaders]) if len(patterns) < 50 else np.array([{p: k for k, p in enumerate(patterns)}[x] for x in leaders])
        sets = [set(p) for p in patterns]
        reps, copies, block, size, start, hashes = reps[keep], copies[keep], block[keep], size[keep], start[keep], hashes[keep]
        count = len(reps)
        numbers = np.unique(values, return_inverse=True)[1] if len(values) else np.zeros(0, np.int64)
        seen = np.zeros(int(numbers.max()) + 1 if len(numbers) else 1, bool)
        links, parent = np.zeros(count, np.int64), np.arange(count)
        clashes: dict[int, np.ndarray] = {}

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = int(parent[k])
            return k

        for x in range(count):
            # Sorted by size: partners come later, up to size / threshold.
            last = int(np.searchsorted(size, size[x] * under // over, "right"))
            y = np.arange(x + 1, last)
            if first != second:
                y = y[block[y] != block[x]]
            if not len(y):
                continue
            y = y[(hashes[y] == hashes[x]).any(axis=1)]
            if pattern[x] not in clashes:
                clashes[pattern[x]] = np.array([bool(sets[pattern[x]] & s) for s in sets])
            y = y[~clashes[pattern[x]][pattern[y]]]
            if not len(y):
                continue
            mine = numbers[start[x]: start[x] + size[x]]
            seen[mine] = True
            lengths = size[y]
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(start[y], lengths)
            common = np.add.reduceat(seen[numbers[at]].astype(np.int64), ends - lengths)
            seen[mine] = False
            y = y[under * common >= over * (lengths + size[x] - common)]
            links[x] += copies[y].sum()
            links[y] += copies[x]
            for k in y.tolist():
                a, b = root(x), root(k)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        roots = np.array([root(k) for k in range(count)], np.int64)
        smallest = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(smallest, roots, reps)
        some = links > 0
        return pa.table({"rep": reps[some], "root": smallest[roots][some] if count else reps[some], "links": links[some]})

    return run


def join(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
    recall: float = RECALL, rows: int = ROWS, block: int = BLOCK,
) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies): class_id is the smallest id of the connected group,
    n_links the number of other documents at or above the threshold, n_copies those with equal sets."""
    bands, under = plan_bands(threshold, recall, rows), 1000
    over = round(threshold * under)
    given = texts(documents, id_col, text_col)
    unnamed = F.xxhash64("text").bitwiseAND(F.lit(UNNAMED - 1)) + F.lit(UNNAMED)
    keyed = given.select(F.coalesce("doc_id", unnamed).alias("doc"), "text")
    signs = materialize(keyed.mapInArrow(_sign(words, bands, rows), SIGNED), "signatures")
    classes = materialize(
        signs.filter("n > 0").groupBy("h1", "h2").agg(
            F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    banded = classes.select("rep", "h1", "h2", F.posexplode("bands").alias("band", "value"))
    buckets = materialize(
        banded.groupBy("band", "value").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("band", "value", "leader"),
        "buckets",
    )
    led = banded.join(buckets, ["band", "value"]).groupBy("rep", "h1", "h2").agg(F.sort_array(F.collect_set("leader")).alias("leaders"))
    members = materialize(
        led.join(classes.select("rep", "h1", "h2", "copies", "n"), ["rep", "h1", "h2"]).select(
            "rep", "h1", "h2", "copies", "n", "leaders", F.explode("leaders").alias("leader")
        ),
        "members",
    )
    blocks = members.groupBy("leader").agg(F.ceil(F.sum("n") / F.lit(float(block))).cast("int").alias("blocks"))
    placed = members.join(materialize(blocks, "blocks"), "leader").select(
        "rep", "h1", "h2", "copies", "leader", "blocks",
        F.filter("leaders", lambda v: v < F.col("leader")).alias("lower"),
        F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int").alias("block"),
    )
    dealt = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "rep", "h1", "h2", "copies", "leader", "lower", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    with_text = dealt.join(keyed, dealt.rep == keyed.doc).drop("doc")
    found = materialize(with_text.groupBy("leader", "i", "j").applyInArrow(_verify(words, bands, rows, over, under), GROUPED), "links")
    labels = components(found.filter("root < rep").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = classes.join(linked, "rep", "left").join(labels, F.col("rep") == labels.node, "left").select(
        "h1", "h2", F.coalesce("label", "rep").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        (F.col("copies") - 1).alias("same"),
    )
    known = materialize(joined.filter("links > 0"), "known")
    doc = signs.select("doc", "h1", "h2", "n")
    named = lambda c: F.when(c < UNNAMED, c)
    return doc.join(known, ["h1", "h2"], "left").select(
        named(F.col("doc")).alias("doc_id"), named(F.coalesce("class", "doc")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("same", F.lit(0)).alias("n_copies"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The table without all but the smallest id of each group; of equal rows one stays, a row without an id stays."""
    found = join(df, id_col, text_col, **options)
    gone = materialize(found.filter("doc_id <> class_id").select("doc_id").distinct(), "removed")
    again = materialize(found.filter("n_copies > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    (name,) = free_names(df, "other_id")
    either = gone.unionByName(again).select(F.col("doc_id").alias(name))
    single = df.join(either, df[id_col] == F.col(name), "left_anti")
    repeated = df.join(again.join(gone, "doc_id", "left_anti").select(F.col("doc_id").alias(name)), df[id_col] == F.col(name), "left_semi")
    return single.unionByName(repeated.dropDuplicates([id_col, text_col]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all documents."""
    from hourgrid.llm.common import table

    return join(table(spark, sf_dir, "documents"))
