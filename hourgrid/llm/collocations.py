"""Phrase collocations by HAT-trie counting: burstable hash containers under a shallow trie of word ids.

Texts are split at signs and line ends into pieces, pieces at blanks into words. A word's id is a 64-bit hash of
the word with A-Z lower-cased and its language. Phrases of one to ``WORDS`` words are counted by language,
longer ones only where all their shorter phrases reach ``LEAST``: a phrase is no more frequent than its parts, so
nothing is lost.

1. Each task counts in a ``HatTrie``. A leaf is a hash container that holds the suffixes below a range of word ids; one
   that grows past ``BURST`` entries is split between two ids, or, once it holds a single id, bursts into a node
   whose containers go by the next word. When all containers hold over ``HELD`` entries, the largest whole
   subtrees are spilled as runs, sorted by the hash of their first two words, cut by prefix partition into chunks.
2. Chunks are dealt by prefix partition and sorted by their lowest key; a task streams them and gives a count on as soon as no
   later chunk can hold its key. A very common first word is spread over partitions by the second; a common
   pair is one entry a run.
3. Which words and pairs reach ``LEAST`` goes to the next pass as a bit map of at most ``FILTER_BITS`` bits (16 MiB at any
   size of the corpus, so it may be broadcast). A wrongly set bit costs some counting, never a result.
4. Counts of parts are joined to the candidates on ids; products are decimals of 38 digits, exact for counts up to
   10**15. The best of each language are ranked in two steps, first within ``SALTS`` shares of its phrases.

Defined results: a null text is empty, a null language ``und``; languages are taken as they are written; repeated rows count again;
an empty table or one without candidates gives no row. Two words with one hash would count as one (one chance in 10**7 with
a million words).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm.common import LOWER, batches, mix, runs, signed, slabs, span_hash, table, use_workers
from hourgrid.session import materialize

LEAST, WORDS, TOP, COVER = 10, 3, 2000, 50
BURST = 1 << 16             # entries of a container
HELD = 2_500_000            # entries of a task's trie
PIECES = 4                  # runs that a full trie is given in at the end, at least
CHUNK = 8192                # entries of a stored piece of a run
MERGED = 1_000_000          # entries that a merging task gathers before it sums
FILTER_BITS = 1 << 27
SALTS = 64
PIECE = np.zeros(256, bool)
PIECE[[*b".,;:!?", *range(10, 14)]] = True
IN_WORD = ~PIECE
IN_WORD[[9, 32]] = False
CODEC = "zstd"


# --- the trie -----------------------------------------------------------------------

def summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal keys once, in the order of a hash of the key."""
    n = len(counts)
    if not n:
        return columns, counts
    key = columns[0]
    for c in columns[1:]:
        key = mix(key + np.uint64(0x9E3779B97F4A7C15)) ^ c
    order = np.argsort(key)
    key, sorted_ = key[order], [c[order] for c in columns]
    new = np.ones(n, bool)
    new[1:] = sorted_[0][1:] != sorted_[0][:-1]
    for c in sorted_[1:]:
        new[1:] |= c[1:] != c[:-1]
    if int(new.sum()) != 1 + int((key[1:] != key[:-1]).sum()):      # two keys share the hash: sort by the keys themselves
        order = np.lexsort(columns[::-1])
        sorted_ = [c[order] for c in columns]
        new[1:] = sorted_[0][1:] != sorted_[0][:-1]
        for c in sorted_[1:]:
            new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in sorted_], np.add.reduceat(counts[order], first)


class Container:
    """Counts of all keys below a range of ids; new ones wait until they are as many as those summed."""

    def __init__(self, depth: int):
        self.columns = [np.zeros(0, np.uint64)] * depth
        self.counts = np.zeros(0, np.int64)
        self.waiting: list[tuple[list[np.ndarray], np.ndarray]] = []
        self.more = 0

    def __len__(self) -> int:
        return len(self.counts) + self.more

    def add(self, columns: list[np.ndarray], counts: np.ndarray) -> None:
        self.waiting.append((columns, counts))
        self.more += len(counts)
        if self.more > max(BURST, len(self.counts)):
            self.sum()

    def sum(self) -> None:
        if self.waiting:
            parts = [(self.columns, self.counts), *self.waiting]
            self.columns, self.counts = summed(
                [np.concatenate([p[0][k] for p in parts]) for k in range(len(self.columns))], np.concatenate([p[1] for p in parts])
            )
            self.waiting, self.more = [], 0

    def split(self, level: int, depth: int) -> tuple[Container, int, Container] | None:
        """Two containers and the first id of the second; None if there is one id."""
        self.sum()
        ids = self.columns[level]
        low = ids.min()
        if low == ids.max():
            return None
        middle = np.partition(ids, len(ids) // 2)[len(ids) // 2]
        if middle == low:
            middle = ids[ids > low].min()
        out = []
        for chosen in (ids < middle, ids >= middle):
            part = Container(depth)
            part.columns, part.counts = [c[chosen] for c in self.columns], self.counts[chosen]
            out.append(part)
        return out[0], middle, out[1]

    def leaves(self) -> Iterator[Container]:
        yield self


class Node:
    """Children by ranges of the word id at one level; ``starts`` has the first id of each."""

    def __init__(self, level: int, depth: int, first: Container):
        self.level, self.depth = level, depth
        self.starts = np.zeros(1, np.uint64)
        self.children: list[Container | Node] = [first]

    def __len__(self) -> int:
        return sum(map(len, self.children))

    def add(self, columns: list[np.ndarray], counts: np.ndarray) -> None:
        if len(self.children) == 1:
            self.children[0].add(columns, counts)
        else:
            at = (np.searchsorted(self.starts, columns[self.level], "right") - 1).astype(np.uint16)
            order = np.argsort(at, kind="stable")
            bounds = np.searchsorted(at[order], np.arange(len(self.children) + 1))
            columns, counts = [c[order] for c in columns], counts[order]
            for k, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                if a < b:
                    self.children[k].add([c[a:b] for c in columns], counts[a:b])
        k = 0
        while k < len(self.children):
            child = self.children[k]
            if isinstance(child, Container) and len(child.counts) > BURST:
                self._burst(k)
            else:
                k += 1

    def _burst(self, k: int) -> None:
        child = self.children[k]
        parts = child.split(self.level, self.depth)
        if parts is not None:
            left, middle, right = parts
            self.children[k: k + 1] = [left, right]
            self.starts = np.insert(self.starts, k + 1, middle)
        else:
            self.children[k] = Node(self.level + 1, self.depth, child)      # one id: its own subtree by the next word
            self.children[k]._burst(0)

    def leaves(self) -> Iterator[Container]:
        for child in self.children:
            yield from child.leaves()


class HatTrie:
    """Counts of keys of ``depth`` word ids."""

    def __init__(self, depth: int, held: int = HELD):
        self.depth, self.held = depth, held
        self.root = Node(0, depth, Container(depth))

    def add(self, columns: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """Count keys; gives spilled subtrees if there is too much to hold."""
        if len(columns[0]):
            self.root.add(*summed(columns, np.ones(len(columns[0]), np.int64)))
        if len(self.root) > self.held:
            for leaf in self.root.leaves():
                leaf.sum()
            while len(self.root) > self.held // 2:
                k = max(range(len(self.root.children)), key=lambda j: len(self.root.children[j]))
                subtree, self.root.children[k] = self.root.children[k], Container(self.depth)
                yield self._run(subtree)

    def rest(self) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """All that is held, as runs of whole subtrees of about ``held // PIECES`` entries: little is there twice."""
        left, self.root = self.root.children, Node(0, self.depth, Container(self.depth))
        while left:
            some = [left.pop()]
            size = len(some[0])
            while left and size + len(left[-1]) <= self.held // PIECES:
                some.append(left.pop())
                size += len(some[-1])
            if size:
                yield self._run(*some)

    def _run(self, *subtrees) -> tuple[list[np.ndarray], np.ndarray]:
        """The entries of subtrees, which are emptied column by column."""
        leaves = [leaf for subtree in subtrees for leaf in subtree.leaves()]
        for leaf in leaves:
            leaf.sum()
        columns = []
        for k in range(self.depth):
            columns.append(np.concatenate([x.columns[k] for x in leaves]))
            for x in leaves:
                x.columns[k] = columns[k][:0].copy()
        counts = np.concatenate([x.counts for x in leaves])
        for x in leaves:
            x.counts = counts[:0].copy()
        return columns, counts


# --- texts --------------------------------------------------------------------------

def language_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def words_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(bytes, starts, ends, ids, document, joined) for runs of the rows of (lang, text); joined: the next word is of the same piece."""
    names = batch.column(0).to_pylist()
    keys = {lang: language_key(lang) for lang in set(names)}
    salt = np.array([keys[x] for x in names], np.uint64)
    for i, _, data, offsets in slabs(batch.column(1), 1 << 20):
        starts, ends, place = runs(data, offsets, IN_WORD)
        lower = LOWER[data]
        document = np.repeat(np.arange(len(place) - 1), np.diff(place)) + i
        ids = mix(span_hash(lower, starts, ends) ^ salt[document])
        piece = np.cumsum(PIECE[data])[starts] if len(starts) else starts
        joined = (piece[1:] == piece[:-1]) & (document[1:] == document[:-1])
        yield lower, starts, ends, ids, document, joined


def _has(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = (ids & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def prefix_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Of the first two words: where a phrase is dealt and sorted."""
    return mix(mix(columns[0]) + columns[1] * np.uint64(0x9E3779B97F4A7C15))


# --- words --------------------------------------------------------------------------

def _count_words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie, known = HatTrie(1), {}

    def out(run) -> Iterator[pa.RecordBatch]:
        (ids,), counts = run
        for k in range(0, len(ids), 1 << 16):
            part = ids[k: k + (1 << 16)]
            names = [known[i] for i in part.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in names]), pa.array([n[1].decode("utf-8", "replace") for n in names]), pa.array(signed(part)), pa.array(counts[k: k + (1 << 16)])],
                names=["lang", "word", "id", "n"],
            )

    for batch in batches(rows):
        langs = batch.column(0).to_pylist()
        for lower, starts, ends, ids, document, _ in words_of(batch):
            distinct, first = np.unique(ids, return_index=True)
            raw = lower.tobytes()
            for i, s, e, d in zip(distinct.tolist(), starts[first].tolist(), ends[first].tolist(), document[first].tolist()):
                if i not in known:
                    known[i] = langs[d], raw[s:e]
            spilled = False
            for run in trie.add([ids]):
                yield from out(run)
                spilled = True
            if spilled:
                left = np.concatenate([x.columns[0] for x in trie.root.leaves()]).tolist()
                known = {i: known[i] for i in left}
    for run in trie.rest():
        yield from out(run)


def word_counts(given: DataFrame) -> DataFrame:
    """(lang, word, id, n) of all words; a written table."""
    found = given.mapInArrow(_count_words, "lang string, word string, id long, n long")
    return materialize(found.groupBy("lang", "word").agg(F.first("id").alias("id"), F.sum("n").alias("n")), "words")


def bit_map(frequent: DataFrame, key: Column, most: int = FILTER_BITS) -> np.ndarray:
    """The keys as a bit map of eight bits a key or more, and of ``most`` bits at most, whatever their number."""
    bits = min(most, 1 << max(15, (8 * frequent.count() - 1).bit_length()))
    place = key.bitwiseAND(F.lit(bits - 1)) + 1
    rows = frequent.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.toArrow().to_pylist():
        at = (r["bucket"] - 1) * 4096
        out[at: at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


# --- phrases ------------------------------------------------------------------------

RUNS = "part int, low long, size int, chunk binary"
COUNTS = "key long, " + ", ".join(f"w{k + 1} long" for k in range(WORDS)) + ", n long"


def _order(key: np.ndarray) -> np.ndarray:
    """Signed integers in the order of the unsigned ones."""
    return signed(key ^ np.uint64(1 << 63))


def chunks(run: tuple[list[np.ndarray], np.ndarray], part_bits: int) -> Iterator[pa.RecordBatch]:
    """A sorted run cut by prefix partition, packed: rows of ``RUNS``."""
    codec = pa.Codec(CODEC)
    columns, counts = run
    key = prefix_hash(columns)
    order = np.argsort(key)
    key = key[order]
    part = (key >> np.uint64(64 - part_bits)).astype(np.int64)
    cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
    edges = np.concatenate([[0], cuts, [len(key)]])
    bounds = [(k, min(k + CHUNK, b)) for a, b in zip(edges.tolist(), edges[1:].tolist()) for k in range(a, b, CHUNK)]
    for at in range(0, len(bounds), 512):
        some = bounds[at: at + 512]
        packed = [codec.compress(b"".join([c[order[a:b]].tobytes() for c in (*columns, counts)]), asbytes=True) for a, b in some]
        first = [a for a, _ in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[first].astype(np.int32)), pa.array(_order(key[first])), pa.array([b - a for a, b in some], pa.int32()), pa.array(packed, pa.binary())],
            names=["part", "low", "size", "chunk"],
        )


def _count_phrases(depth: int, words_b, pairs_b, part_bits: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(depth)
        words, pairs = words_b.value, pairs_b.value if pairs_b is not None else None
        for batch in batches(rows):
            for _, _, _, ids, _, joined in words_of(batch):
                known = _has(words, ids)
                good = joined & known[1:] & known[:-1]
                for k in range(2, depth):
                    # Two overlapping phrases of k words, both frequent, make a candidate of k + 1.
                    good &= _has(pairs, prefix_hash([ids[:-1], ids[1:]]))
                    good = good[1:] & good[:-1]
                at = np.flatnonzero(good)
                for spilled in trie.add([ids[at + k] for k in range(depth)]):
                    yield from chunks(spilled, part_bits)
        for rest in trie.rest():
            yield from chunks(rest, part_bits)

    return run


def merge(depth: int, least: int, words: int = WORDS):
    """Sums of sorted chunks: (key, w1, ..., n) with ``words`` columns of words."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(CODEC)
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        size, limit = 0, MERGED

        def total() -> tuple[list[np.ndarray], np.ndarray]:
            return summed([np.concatenate([h[0][k] for h in held]) for k in range(depth)], np.concatenate([h[1] for h in held]))

        def out(columns, counts) -> pa.RecordBatch:
            chosen = counts >= least
            columns = [c[chosen] for c in columns]
            blank = np.zeros(int(chosen.sum()), np.int64)
            filled = [signed(c) for c in columns] + [blank] * (words - depth)
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (signed(prefix_hash(columns)), *filled, counts[chosen])], names=["key", *[f"w{k + 1}" for k in range(words)], "n"]
            )

        for batch in rows:
            for low, n, chunk in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if size > limit:
                    columns, counts = total()
                    over = _order(prefix_hash(columns)) < low      # no later chunk holds these
                    yield out([c[over] for c in columns], counts[over])
                    held = [([c[~over] for c in columns], counts[~over])]
                    size = int((~over).sum())
                    limit = max(MERGED, 2 * size)
                raw = codec.decompress(chunk, (depth + 1) * 8 * n, asbytes=True)
                values = np.frombuffer(raw, np.uint64).reshape(depth + 1, n)
                held.append((list(values[:depth]), values[depth].view(np.int64)))
                size += n
        if held:
            yield out(*total())

    return run


def parts(spark: SparkSession) -> int:
    """Bits of the prefix partition: four to eight partitions for each of a shuffle."""
    return max(4, (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length())


def phrase_counts(given: DataFrame, depth: int, words: np.ndarray, pairs: np.ndarray | None, least: int) -> DataFrame:
    """(key, w1, w2, w3, n) of the phrases of ``depth`` words that reach ``least``; a written table."""
    spark = given.sparkSession
    share = spark.sparkContext.broadcast
    part_bits = parts(spark)
    sent = [share(words), share(pairs) if pairs is not None else None]
    stored = given.mapInArrow(_count_phrases(depth, *sent, part_bits), RUNS)
    merged = stored.repartition("part").sortWithinPartitions("low").mapInArrow(merge(depth, least), COUNTS)
    written = materialize(merged, f"phrases{depth}")
    for b in sent:
        if b is not None:
            b.destroy()
    return written


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly; at most a million, as a is at most l and r."""
    wide = lambda c: c.cast("decimal(15,0)")
    above, below = wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right)
    return F.call_function("div", above, below)


def collocations(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, cover: int = COVER, top: int | None = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best ``top`` phrases of each language; all for None."""
    use_workers(df.sparkSession)
    given = df.select(F.coalesce(df[lang_col], F.lit("und")).alias("lang"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    words = word_counts(given)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.filter(F.col("n") >= least)
    word_bits = bit_map(frequent, F.col("id"))
    pairs = phrase_counts(given, 2, word_bits, None, least)
    triples = phrase_counts(given, 3, word_bits, bit_map(pairs, F.col("key")), least)

    one, two = (frequent.select(F.col("id").alias(f"i{k}"), F.col("lang").alias(f"lang{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}")) for k in (1, 2))
    named = pairs.join(one, F.col("w1") == F.col("i1")).join(two, F.col("w2") == F.col("i2")).select(
        F.col("lang1").alias("lang"), "w1", "w2", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("word2").alias("last"),
        F.col("n").alias("a"), F.col("n1").alias("l"), F.col("n2").alias("r"),
    )
    named = materialize(named, "pairs")
    front = named.select(F.col("w1").alias("f1"), F.col("w2").alias("f2"), "lang", F.col("phrase").alias("head"), F.col("a").alias("fa"), F.col("l").alias("fl"))
    back = named.select(F.col("w1").alias("b2"), F.col("w2").alias("b3"), "last", F.col("a").alias("ba"), F.col("r").alias("br"))
    longer = triples.join(front, (F.col("w1") == F.col("f1")) & (F.col("w2") == F.col("f2"))).join(back, (F.col("w2") == F.col("b2")) & (F.col("w3") == F.col("b3")))
    cut = lambda left, right: F.struct(_score(F.col("n"), F.col(left), F.col(right)).alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))
    first, second = cut("fl", "ba"), cut("fa", "br")
    long_rows = longer.select(
        "lang", F.concat_ws(" ", "head", "last").alias("phrase"), F.col("n").alias("a"), F.when(second.score < first.score, second).otherwise(first).alias("cut")
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    inside = triples.select("w1", "w2", "n").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    covered = inside.groupBy(F.col("w1").alias("c1"), F.col("w2").alias("c2")).agg(F.max("n").alias("most"))
    short_rows = named.join(covered, (F.col("w1") == F.col("c1")) & (F.col("w2") == F.col("c2")), "left").filter(
        F.col("most").isNull() | (100 * F.col("most") < cover * F.col("a"))
    ).select("lang", "phrase", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    rows = long_rows.unionByName(short_rows)

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        rows = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).filter(F.col("place") <= top).drop("salt", "place")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    of = totals.select(F.col("lang").alias("of"), "n")
    return ranked.join(of, F.col("lang") == F.col("of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language of the documents."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH p AS (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[.,;:!?\x0A-\x0D]')) AS piece
           FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents) d),
w AS MATERIALIZED (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
x AS MATERIALIZED (SELECT lang, piece, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS w1, unnest(list_append(w[2:], NULL)) AS w2,
                          unnest(list_append(list_append(w[3:], NULL), NULL)[1: len(w)]) AS w3 FROM w WHERE len(w) > 0),
f AS MATERIALIZED (
    SELECT lang, 1 AS size, w1 AS phrase, NULL AS w1, NULL AS w2, NULL AS w3, count(*)::HUGEINT AS a FROM x GROUP BY x.lang, x.w1
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, w1, w2, NULL, count(*) FROM x WHERE w2 IS NOT NULL GROUP BY x.lang, x.w1, x.w2
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, w1, w2, w3, count(*) FROM x WHERE w3 IS NOT NULL GROUP BY x.lang, x.w1, x.w2, x.w3),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE size > 1 AND a >= {LEAST}),
e AS (SELECT *, 1 AS k, w1 AS head, concat_ws(' ', w2, w3) AS tail FROM c UNION ALL SELECT *, 2, w1 || ' ' || w2, w3 FROM c WHERE size = 3),
s AS (SELECT e.lang, e.phrase, e.a, e.k, l.a AS l, r.a AS r, 1000000 * e.a * e.a // (l.a * r.a) AS score
      FROM e JOIN f l ON l.lang = e.lang AND l.phrase = e.head JOIN f r ON r.lang = e.lang AND r.phrase = e.tail),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, part, max(a) AS most FROM (
        SELECT lang, w1 || ' ' || w2 AS part, a FROM c WHERE size = 3 UNION ALL SELECT lang, w2 || ' ' || w3, a FROM c WHERE size = 3) y GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.part = b.phrase WHERE o.most IS NULL OR 100 * o.most < {COVER} * b.a),
q AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM k)
SELECT q.lang, q.rank, q.phrase, q.a::BIGINT AS a, q.l::BIGINT AS l, q.r::BIGINT AS r, n.n, q.score::BIGINT AS score
FROM q JOIN n ON n.lang = q.lang WHERE q.rank <= {TOP}
"""
