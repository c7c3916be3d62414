"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Paragraphs are the lines of a text, cut further after words chosen by their hash: one in ``EVERY`` at the beginning of a
text and ever fewer further on, so that a short text has several and a long one not too many. The choices are nested, and a
cut depends on the word alone, so cuts stay where they are if text elsewhere changes. A word of more than
``WORD`` characters (also of a script without blanks) is cut after characters chosen so.

Distinct paragraphs are hashed to 64 bits. A sketch of m cells in three parts puts each digest into one cell of every part; a
cell holds the number of its digests, their exclusive or, and the exclusive or of a check hash of each. Two versions are
compared by subtracting their sketches cell by cell (what they share cancels) and peeling: a cell that holds a
single digest gives it away, and it is taken from its cells in the other parts. The digests recovered on each
side give the likeness, shared paragraphs over all paragraphs; two texts without a difference have 1. Pairs with cells
left over are sketched ``GROW`` times larger and peeled again, only they, until none is left.

Everything is DataFrame functions: sketches are rows (pair, cell) made by ``explode`` and added up by ``groupBy``. Pairs are dealt
once; all sums of a pass go by pair and cell within that partitioning, so a pass has a single shuffle, of digests.
A peeling step serves one part, in which each digest has one cell, so none is given away twice. Documents are shuffled once,
where each is to meet the next one in order.

Defined results: a null text is an empty text (one empty paragraph); a null id comes after all
others in descending order; rows that tie on the id are ordered by a hash of their text; a single document is its own next
one; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import table
from hourgrid.session import materialize

CELLS = 96                      # of the fingerprint, and of the first try
GROW = 3
STEPS = 12                      # peeling steps of a try, four for each part
EVERY, NEAR = 4, 32             # one word in EVERY of the first NEAR, in 2 EVERY of the next 2 NEAR, and so on
LEVELS = 12
WORD = 40
LOWEST = -(1 << 63)
TAKEN = {1: -1, -1: -2}         # places of the numbers of digests recovered on either side


# --- paragraphs -----------------------------------------------------------------------

def _cut_after(units: Column, seed: int) -> Column:
    """The units joined, with a line end after each chosen one; the further on, the fewer are chosen."""

    def every(at: Column) -> Column:
        out = F.lit(EVERY << LEVELS)
        for level in range(LEVELS - 1, -1, -1):
            out = F.when(at < NEAR * ((2 << level) - 1), EVERY << level).otherwise(out)
        return out

    mark = lambda u, at: F.when(F.pmod(F.xxhash64(F.lit(seed), u), every(at)) == 0, F.concat(u, F.lit("\n"))).otherwise(u)
    return F.array_join(F.transform(units, mark), "")


def paragraphs(text: Column) -> Column:
    """Digests of the distinct paragraphs, in order."""
    words = F.split(text, "(?<=[ \n])")
    short = F.transform(words, lambda w: F.when(F.length(w) > WORD, _cut_after(F.split(w, ""), 6)).otherwise(w))
    cut = _cut_after(F.when(F.exists(words, lambda w: F.length(w) > WORD), short).otherwise(words), 5)
    return F.array_sort(F.array_distinct(F.transform(F.split(cut, "\n"), lambda p: F.xxhash64(p))))


# --- sketches as rows -----------------------------------------------------------------

def _check(x: Column) -> Column:
    return F.xxhash64(F.lit(77), x)


def _place(x: Column, part: int, cells: int) -> Column:
    third = cells // 3
    return (F.pmod(F.xxhash64(F.lit(part), x), F.lit(third)) + part * third).cast("int")


def _cell(p: Column, d: Column, c: Column, x: Column, h: Column) -> Column:
    return F.struct(p.cast("int").alias("p"), d.cast("long").alias("d"), c.cast("int").alias("c"), x.cast("long").alias("x"), h.cast("long").alias("h"))


def _added(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Cells added up by key, place and recovered digest; empty ones go."""
    return rows.groupBy(*keys, "p", "d").agg(F.sum("c").cast("int").alias("c"), F.bit_xor("x").alias("x"), F.bit_xor("h").alias("h")).filter(
        (F.col("p") < 0) | (F.col("c") != 0) | (F.col("x") != 0) | (F.col("h") != 0)
    )


def sketch(signed: DataFrame, keys: list[str], cells: int) -> DataFrame:
    """(keys, p, d, c, x, h) of rows (keys, x, sign): the cells in use."""
    zero = F.lit(0)
    shares = F.array(*[_cell(_place(F.col("x"), k, cells), zero, F.col("sign"), F.col("x"), _check(F.col("x"))) for k in range(3)])
    return _added(signed.select(*keys, F.explode(shares).alias("s")).select(*keys, "s.*"), keys)


def peel(difference: DataFrame, keys: list[str], cells: int, digests: bool = False, steps: int = STEPS) -> DataFrame:
    """Cells left (p >= 0) of subtracted sketches, and what was recovered: rows with p in ``TAKEN``, c their number, d the digest if asked for."""
    left = difference
    for step in range(steps):
        part = step % 3
        third = cells // 3
        x, c = F.col("x"), F.col("c")
        pure = (F.col("p") >= part * third) & (F.col("p") < (part + 1) * third) & (F.abs(c) == 1) & (F.col("h") == _check(x))
        others = [_cell(_place(x, k, cells), F.lit(0), -c, x, F.col("h")) for k in range(3) if k != part]
        got = _cell(F.when(c == 1, TAKEN[1]).otherwise(TAKEN[-1]), x if digests else F.lit(0), F.lit(1), F.lit(0), F.lit(0))
        own = _cell(F.col("p"), F.col("d"), c, x, F.col("h"))
        left = _added(left.select(*keys, F.explode(F.when(pure, F.array(*others, got)).otherwise(F.array(own))).alias("s")).select(*keys, "s.*"), keys)
    return left


def _signed(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x, sign) of the digests of both sides of each pair."""
    side = lambda digests, sign: F.transform(digests, lambda x: F.struct(x.alias("x"), F.lit(sign).alias("sign")))
    return pairs.select(*keys, F.explode(F.concat(side(F.col("a"), 1), side(F.col("b"), -1))).alias("s")).select(*keys, "s.x", "s.sign")


def outcome(pairs: DataFrame, keys: list[str], cells: int) -> DataFrame:
    """(keys, only_a, only_b, left) of rows (keys, a, b) of two digest arrays: numbers recovered, and cells left over."""
    rest = peel(sketch(_signed(pairs, keys), keys, cells), keys, cells)
    number = lambda p: F.coalesce(F.sum(F.when(F.col("p") == p, F.col("c"))), F.lit(0))
    return rest.groupBy(*keys).agg(number(-1).alias("only_a"), number(-2).alias("only_b"), F.count(F.when(F.col("p") >= 0, 1)).alias("left"))


def compare(pairs: DataFrame, keys: list[str], cells: int = CELLS) -> DataFrame:
    """(keys, only_a, only_b, cells) of rows (keys, a, b): how many digests either side has alone, and the size that peeled.

    A pair without a difference leaves no cell and no row; ``coalesce`` it to zero.
    """
    todo = pairs.select(*keys, "a", "b")
    done = None
    while True:
        dealt = todo.repartition(keys[0])
        # As many digests more on one side than cells cannot be peeled: straight to the next size.
        near = F.abs(F.size("a") - F.size("b")) <= cells
        result = materialize(outcome(dealt.filter(near), keys, cells), "peeled")
        good = result.filter("left = 0").select(*keys, "only_a", "only_b", F.lit(cells).alias("cells"))
        done = good if done is None else done.unionByName(good)
        bad = result.filter("left > 0").select(*keys)
        todo = materialize(todo.filter(near).join(bad, keys, "left_semi").unionByName(todo.filter(~near)), "unpeeled")
        cells *= GROW
        if not todo.limit(1).count():
            return done


def recovered(pairs: DataFrame, keys: list[str], cells: int) -> DataFrame:
    """(keys, side, digest): the differing digests that a sketch of so many cells gives back; side 1 has those of ``a`` alone."""
    rest = peel(sketch(_signed(pairs, keys), keys, cells), keys, cells, digests=True)
    return rest.filter("p < 0").select(*keys, F.when(F.col("p") == -1, 1).otherwise(-1).alias("side"), F.col("d").alias("digest"))


def fingerprints(documents: DataFrame, keys: list[str], digests: str, cells: int = CELLS) -> DataFrame:
    """(keys, fingerprint) of rows with a digest array: the cells in use as text."""
    signed = documents.select(*keys, F.explode(digests).alias("x")).withColumn("sign", F.lit(1))
    held = sketch(signed, keys, cells).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("p", "c", "x", "h"))).alias("cells"))
    text = F.array_join(F.transform("cells", lambda s: F.concat_ws(".", F.hex(s.p), F.hex(s.c), F.hex(s.x), F.hex(s.h))), "-")
    return held.select(*keys, text.alias("fingerprint"))


def likeness(size_a: Column, size_b: Column, only_a: Column, only_b: Column) -> Column:
    apart = only_a + only_b
    shared = (size_a + size_b - apart) / 2
    return shared / (shared + apart)


# --- documents in order ---------------------------------------------------------------

def _buckets(cuts: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Distinct cuts, the bucket below each (one more for the rest), and in how many the rows at a repeated cut are split."""
    bounds = sorted(set(cuts))
    below, split, number = [], [], 0
    for v in bounds:
        below.append(number)
        times = cuts.count(v)
        split.append(times if times > 1 else 0)
        number += 1 + split[-1]
    return bounds, [*below, number], split


def with_next(documents: DataFrame, carried: list[str], buckets: int | None = None) -> DataFrame:
    """The rows of (doc_id, text, ...) with ``next_`` columns of the carried ones: of the next row in descending id order, round the end.

    Rows are dealt into buckets between approximate quantiles of the id; the rows of an id that fills several are split
    between them by the hash of the text. Within a bucket a window finds the next row; the first row of a bucket also goes, as a
    mere neighbour, to the bucket before (that of the first to the last). Only the key of one row a bucket comes to the driver.
    """
    spark = documents.sparkSession
    count = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = documents.withColumn("nk", F.bitwise_not(F.coalesce("doc_id", F.lit(LOWEST)))).withColumn("tk", F.xxhash64("text"))
    shares = [k / count for k in range(1, count)] or [0.5]
    found = keyed.agg(F.percentile_approx("nk", shares, 20 * count).alias("cuts")).first()["cuts"]
    bounds, below, split = _buckets(list(found or ()))
    size = len(bounds)
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values]) if values else F.array().cast("array<bigint>")
    edges, starts, parts = longs(bounds), longs(below), longs(split)
    place = F.lit(0)
    if size:        # binary search: the number of cuts below the key
        place = F.aggregate(
            F.array(*[F.lit(1 << j) for j in range(size.bit_length() - 1, -1, -1)]), F.lit(0),
            lambda at, p: F.when((at + p <= size) & (F.get(edges, F.least(at + p, F.lit(size)) - 1) < F.col("nk")), at + p).otherwise(at),
        )
    dealt = keyed.withColumn("at", place)
    pieces = F.when(F.get(edges, F.col("at")) == F.col("nk"), F.get(parts, F.col("at"))).otherwise(0)
    sub = F.least(F.floor((F.col("tk") / F.lit(2.0**64) + 0.5) * F.col("pieces")), F.col("pieces") - 1)
    dealt = dealt.withColumn("pieces", pieces).withColumn(
        "bucket", F.get(starts, F.col("at")) + F.when(F.col("pieces") > 0, 1 + sub).otherwise(0)
    ).drop("at", "pieces")
    heads = sorted((r["bucket"], r["head"]["nk"], r["head"]["tk"]) for r in dealt.groupBy("bucket").agg(F.min(F.struct("nk", "tk")).alias("head")).collect())
    rows = dealt.withColumn("extra", F.lit(False))
    if heads:
        copies = [(nk, tk, heads[k - 1][0]) for k, (_, nk, tk) in enumerate(heads)]
        listed = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(c, ("hn", "ht", "to"))]) for c in copies])
        known = spark.range(1).select(F.explode(listed).alias("c")).select("c.*")
        own = F.array(F.struct(F.col("bucket"), F.lit(False).alias("extra")))
        both = F.array(F.struct(F.col("bucket"), F.lit(False).alias("extra")), F.struct(F.col("to").alias("bucket"), F.lit(True).alias("extra")))
        met = dealt.join(F.broadcast(known), (F.col("nk") == F.col("hn")) & (F.col("tk") == F.col("ht")), "left")
        rows = met.withColumn("goes", F.explode(F.when(F.col("to").isNull(), own).otherwise(both))).select(
            *documents.columns, "nk", "tk", "goes.bucket", "goes.extra"
        )
    order = Window.partitionBy("bucket").orderBy("extra", "nk", "tk")
    nexts = [F.lead(c).over(order).alias(f"next_{c}") for c in carried]
    return rows.select(*documents.columns, "extra", *nexts).filter(~F.col("extra")).drop("extra")


def versions(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_chars, edited_sha256, a, e, n): digests of each text, its edited text and the next document; a written table."""
    given = documents.select(documents[id_col].cast("long").alias("doc_id"), F.coalesce(documents[text_col], F.lit("")).alias("text"))
    ordered = with_next(given.withColumn("a", paragraphs(F.col("text"))), ["text", "a"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = ordered.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substr("next_text", F.lit(1), half))
    )
    return materialize(
        edited.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
            "a", paragraphs(F.col("edited")).alias("e"), F.col("next_a").alias("n"),
        ),
        "versions",
    )


def compare_versions(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness; see ``query``."""
    rows = versions(documents, id_col, text_col)
    pair = lambda kind, b: F.struct(F.lit(kind).alias("kind"), F.col("a"), F.col(b).alias("b"))
    pairs = rows.select("row", F.explode(F.array(pair("edited", "e"), pair("next", "n"))).alias("s")).select("row", "s.*")
    found = compare(pairs, ["row", "kind"])
    value = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c))).alias(f"{c}_{kind}")
    apart = found.groupBy("row").agg(*[value(k, c) for k in ("edited", "next") for c in ("only_a", "only_b", "cells")])
    texts = rows.select("row", F.explode(F.array(F.struct(F.lit("a").alias("version"), F.col("a").alias("x")), F.struct(F.lit("e").alias("version"), F.col("e").alias("x")))).alias("s"))
    prints = fingerprints(texts.select("row", "s.version", F.col("s.x").alias("digests")).repartition("row"), ["row", "version"], "digests").groupBy("row").agg(
        *[F.max(F.when(F.col("version") == v, F.col("fingerprint"))).alias(name) for v, name in (("a", "fingerprint"), ("e", "edited_fingerprint"))]
    )
    number = lambda c: F.coalesce(c, F.lit(0))
    near = lambda kind, b: likeness(F.size("a"), F.size(b), number(F.col(f"only_a_{kind}")), number(F.col(f"only_b_{kind}")))
    return rows.join(prints, "row", "left").join(apart, "row", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("edited", "e").alias("near_edited"), near("next", "n").alias("near_next"),
        F.coalesce("cells_edited", F.lit(CELLS)).alias("cells_edited"), F.coalesce("cells_next", F.lit(CELLS)).alias("cells_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against its edited text and the next document."""
    return compare_versions(table(spark, sf_dir, "documents"))
