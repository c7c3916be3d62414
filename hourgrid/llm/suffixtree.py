"""Language-model scores by a probabilistic suffix tree over words.

Tokens are the words between white space, with A-Z lower-cased, then one end. Contexts are the last 0 to ``DEPTH`` tokens of
a text. The model is a true distribution: over all texts its probabilities sum to one.

1. Passes over the training documents count tokens, then runs of 2 to ``DEPTH + 1`` tokens, in the burst tries of
   ``collocations``: runs are spilled sorted, dealt by prefix and merged in a stream. A run is counted only if all but its last
   token occurs ``LEAST`` times and all but its first ``REPEAT`` times, which bit maps of a fixed size say (a wrong bit only
   costs counting). What a context is followed by fewer than ``REPEAT`` times is known by its number alone.
2. A context of at least ``LEAST`` places (an absolute number, so the tree grows with the corpus) stays if its next
   tokens diverge from those of its suffix: count times divergence, each occurrence predicted from the others, must gain
   ``DIVERGE`` nats and ``WEIGHT`` more for each next token kept. Each level is a written table, joined to the one before
   and never exploded to all lengths.
3. A context gives its tokens their counts, and the rest (the occurrences below ``REPEAT``, and one for each kept token) to
   the distribution of its suffix. Without context a token has its count, and as many places as there are distinct tokens
   go to its spelling: bytes after the last ``SPELL`` or fewer of the word, smoothed down to an even
   share. So an unknown word has the probability of its spelling among the unknown, not a fixed one.
4. A token's probability comes from the longest suffix of its past that the tree holds, smoothed along its shorter ones.

A task holds the most frequent tokens, contexts and next tokens: by thresholds as many as fit ``TOKENS`` tokens, ``STATES`` contexts and ``STATES``
next tokens, counted before the broadcast. Which others there are it knows from bit maps; tokens that need them go out as rows, are joined to the written
tables, and are summed by document. In held contexts a probability is linear in the counts that are not held, so such a row has a factor for each of them
and most rows meet one table once. If there are more than ``CODES`` codes of spelling, a task holds the values of the most frequent ones; distinct words
with others are spelled from the written codes, all of them. Both ways give the same values.

Defined results: a null text is empty (the end alone); a null id counts as the empty text for
the fold and stays null; repeated rows give repeated rows; without training documents N and V
are 0, the base score is the number of tokens times log10(1), and tokens have the probability of an even spelling;
an empty table gives no row. ``V`` counts distinct hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm import collocations
from hourgrid.llm.common import LOWER, NOT_SPACE, Lookup, batches, bound_batches, crc_mod, mix, runs, signed, slabs, span_hash, texts, trimmed
from hourgrid.session import materialize

DEPTH, LEAST, REPEAT = 3, 32, 4
DIVERGE, WEIGHT = 12.0, 10.0
FOLD = (7, 2)
SPELL = 4                               # bytes of the longest context of a spelling
TOKENS, STATES, CODES = 1 << 19, 1 << 20, 1 << 18       # broadcast at most
END_HASH = np.uint64(0x1F0A)
FINE = 1 << 12                          # thresholds below it are any number
HELD = 1 << 19                          # distinct keys a task holds before it gives them on
#: Fixed values of the spelling: the byte that ends a word, the one before a token, which also ends a text; no word holds them.
BLANK, LAST = 0x20, 0x0A
SYMBOLS = 256 - 6 + 1                   # bytes of words, and the end of a word (inside) or of a text (at the start)
WORD_BITS = 19
SLAB = 1 << 18                          # bytes of text at a time
STEP = np.uint64(0x9E3779B97F4A7C15)


# --- tokens and contexts --------------------------------------------------------------

def tokens_of(column: pa.Array) -> Iterator[tuple]:
    """(first row, bytes, starts, ends, ids, place) for runs of rows; each text's ids end with ``END_HASH``."""
    for i, _, data, offsets in slabs(column, SLAB):
        starts, ends, place = runs(data, offsets, NOT_SPACE)
        lower = LOWER[data]
        ids = np.insert(span_hash(lower, starts, ends), place[1:], END_HASH)
        yield i, lower, starts, ends, ids, place + np.arange(len(place))


def longer(context: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The hash of contexts with one token more at the front."""
    return mix(context * STEP + before)


def context_of(words: list[np.ndarray]) -> np.ndarray:
    """Hash of contexts, their tokens in order."""
    h = words[-1]
    for w in words[-2::-1]:
        h = longer(h, w)
    return h


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _maps(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bit maps of the low and the high bits of ``key``: half the bits each, and few others are in both."""
    most = collocations.FILTER_BITS // 2
    return collocations.bit_map(keys, F.col("key"), most), collocations.bit_map(keys, F.shiftrightunsigned("key", 32), most)


def _in(maps: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    found = _has(maps[0], keys)
    found[found] = _has(maps[1], keys[found] >> np.uint64(32))
    return found


# --- spelling ---------------------------------------------------------------------------

def spelled(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each byte of the words and their ends with the ``SPELL`` bytes before, the last one lowest, and each word's place in them."""
    sizes = ends - starts + 1
    begin = np.concatenate([[0], np.cumsum(sizes)])
    word = np.repeat(np.arange(len(starts)), sizes)
    inner = np.arange(begin[-1]) - begin[word]
    byte = np.full(len(word), BLANK, np.uint64)
    solid = inner < sizes[word] - 1
    byte[solid] = lower[(starts[word] + inner)[solid]]
    code = byte.copy()
    for k in range(1, SPELL + 1):
        back = np.full(len(word), LAST, np.uint64)
        back[k:] = np.where(inner[k:] >= k, byte[:-k], np.uint64(LAST))
        code |= back << np.uint64(8 * k)
    return code, begin


END_CODE = np.array([sum(LAST << (8 * k) for k in range(SPELL + 1))], np.uint64)


def code_values(codes: DataFrame) -> DataFrame:
    """(key, n, value): log10 probabilities of (key, n), distinct codes, as ``Speller`` has them from all codes; a code with n = 0 is only asked for.

    A level for each length, from the shortest: a code meets its own without the first byte, of at most 256 that share it.
    """
    byte = lambda k: F.shiftrightunsigned("key", 8 * k).bitwiseAND(F.lit(255))
    below = None
    for length in range(SPELL + 1):
        some = codes if length else codes.filter(byte(1) != LAST)
        level = some.groupBy(F.col("key").bitwiseAND(F.lit((1 << (8 * length + 8)) - 1)).alias("key")).agg(F.sum("n").alias("n"))
        own = Window.partitionBy(F.shiftrightunsigned("key", 8))
        level = level.withColumn("kinds", F.count(F.when(F.col("n") > 0, 1)).over(own)).withColumn("said", F.sum("n").over(own))
        even = F.lit(1.0 / SYMBOLS)
        if below is None:
            level = level.withColumn("lower", even)
        else:
            shorter = below.select(F.col("key").alias("k"), F.col("p").alias("lower"))
            level = level.join(shorter, F.col("key").bitwiseAND(F.lit((1 << (8 * length)) - 1)) == F.col("k"), "left")
            if length == 1:
                level = level.withColumn("lower", F.when(byte(1) == LAST, even).otherwise(F.col("lower")))
        here = F.col("kinds") > 0
        if length > 1:
            here &= byte(length - 1) != LAST
        p = F.when(here, (F.col("n") + F.col("kinds") * F.col("lower")) / (F.col("said") + F.col("kinds"))).otherwise(F.col("lower"))
        below = level.select("key", "n", p.alias("p"))
    return below.select("key", "n", F.log10("p").alias("value"))


class Listed:
    """log10 probabilities of the codes held, NaN for others."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.place, self.value = Lookup(mix(codes)), np.append(values, np.nan)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.place(mix(codes))]


class Speller:
    """log10 probabilities of codes, with a table of those met before.

    Each context gives its bytes their counts, and what is left (of codes that are not held, and one a byte) to the next shorter
    one. At the start of a word the shortest is that of the start, inside it is none; then all ``SYMBOLS`` have an even share.
    """

    BITS = 20

    def __init__(self, codes: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        """``totals`` has the counts of all codes after each code's longest context, held or not."""
        self.code = np.full(1 << self.BITS, np.iinfo(np.uint64).max, np.uint64)
        self.value = np.zeros(1 << self.BITS)
        self.levels = []
        inside = (codes >> np.uint64(8) & np.uint64(255)) != LAST
        for length in range(SPELL + 1):
            chosen = np.ones(len(codes), bool) if length else inside
            keys = codes[chosen] & np.uint64((1 << (8 * length + 8)) - 1)
            entry, at = np.unique(keys, return_inverse=True)
            n = np.bincount(at, counts[chosen], len(entry))
            context, place = np.unique(entry >> np.uint64(8), return_inverse=True)
            kinds = np.bincount(place, minlength=len(context)).astype(float)
            said = np.bincount(place, n, len(context))
            if length == SPELL and len(codes):
                whole = np.zeros(len(context))
                np.maximum.at(whole, np.searchsorted(context, codes >> np.uint64(8)), totals)
                said = np.maximum(said, whole)
            self.levels.append((entry, n, context, said + kinds, said + kinds - np.bincount(place, n, len(context))))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        p = np.full(len(codes), 1.0 / SYMBOLS)
        before = np.zeros(len(codes), np.int64)         # bytes of the word before this one
        for k in range(1, SPELL + 1):
            before += (codes >> np.uint64(8 * k) & np.uint64(255)) != LAST
        for length, (entry, n, context, total, rest) in enumerate(self.levels):
            if not len(context):
                continue
            keys = codes & np.uint64((1 << (8 * length + 8)) - 1)
            own = keys >> np.uint64(8)
            at = np.minimum(np.searchsorted(context, own), len(context) - 1)
            here = (context[at] == own) & (length <= before + 1) & ((length > 0) | (before > 0))
            place = np.minimum(np.searchsorted(entry, keys), len(entry) - 1)
            p = np.where(here, (np.where(entry[place] == keys, n[place], 0.0) + rest[at] * p) / total[at], p)
        return p

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        place = mix(codes) >> np.uint64(64 - self.BITS)
        out = self.value[place]
        new = np.flatnonzero(self.code[place] != codes)
        if len(new):
            distinct, inverse = np.unique(codes[new], return_inverse=True)
            values = np.log10(self.probability(distinct))
            out[new] = values[inverse]
            at = mix(distinct) >> np.uint64(64 - self.BITS)
            self.code[at] = distinct            # of two codes for a place the last stays, with its value
            alone = self.code[at] == distinct
            self.value[at[alone]] = values[alone]
        return out


# --- counting -----------------------------------------------------------------------

def _bytes_of(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words, as binary."""
    begin = np.concatenate([[0], np.cumsum(ends - starts)])
    at = np.arange(begin[-1]) + np.repeat(starts - begin[:-1], ends - starts)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(begin), pa.py_buffer(lower[at])])


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct tokens of the task with their bytes (null: the end) and counts."""
    parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
    more = 0                    # entries since the last sum

    def sum_up() -> None:
        distinct, first, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(distinct)).astype(np.int64)
        parts[:] = [(distinct, counts, pa.concat_arrays([p[2] for p in parts]).take(pa.array(first)))]

    def give() -> Iterator[pa.RecordBatch]:
        (keys, counts, words), = parts
        parts.clear()
        for k in range(0, len(keys), 1 << 16):
            some = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys[some])), words[some].cast(pa.binary()), pa.array(counts[some])], names=["key", "word", "n"])

    for batch in batches(rows):
        for _, lower, starts, ends, ids, place in tokens_of(batch.column(0)):
            words = np.delete(ids, place[1:] - 1)
            distinct, first, counts = np.unique(words, return_index=True, return_counts=True)
            spelt = pa.concat_arrays([_bytes_of(lower, starts[first], ends[first]), pa.nulls(1, pa.large_binary())])
            parts.append((np.append(distinct, END_HASH), np.append(counts, len(place) - 1), spelt))
            more += len(distinct)
            if more > HELD:
                sum_up()
                more = 0
                if len(parts[0][0]) > HELD:
                    yield from give()
    if parts:
        sum_up()
        yield from give()


def _codes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of words (binary; null: the end), each word's place in them (those that are not null), and which are null."""
    words = words.cast(pa.large_binary())
    end = words.is_null().to_numpy(zero_copy_only=False)
    solid = words.drop_null()
    _, offsets, data = solid.buffers()
    offsets = np.frombuffer(offsets, np.int64)[solid.offset: solid.offset + len(solid) + 1]
    lower = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return *spelled(lower, offsets[:-1], offsets[1:]), end


def _spell(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spelling codes of distinct words, each as often as its word."""
    for batch in rows:
        n = batch.column(1).to_numpy()
        codes, begin, end = _codes_of(batch.column(0))
        distinct, inverse = np.unique(np.append(codes, END_CODE), return_inverse=True)
        weight = np.append(np.repeat(n[~end], np.diff(begin)), n[end].sum())
        yield pa.RecordBatch.from_arrays([pa.array(signed(distinct)), pa.array(np.bincount(inverse, weight, len(distinct)).astype(np.int64))], names=["key", "n"])


def _spell_apart(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, key): the codes of each word."""
    for batch in rows:
        codes, begin, end = _codes_of(batch.column(1))
        ids = batch.column(0).to_numpy()
        words = np.append(np.repeat(ids[~end], np.diff(begin)), ids[end])
        codes = np.append(codes, np.repeat(END_CODE, end.sum()))
        for k in range(0, len(codes), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(words[k: k + (1 << 16)]), pa.array(signed(codes[k: k + (1 << 16)]))], names=["word", "key"])


def spellings(words: DataFrame, codes: DataFrame) -> DataFrame:
    """(word, spelt): log10 spellings of words (word: an id, text) from the counts of all codes."""
    apart = words.mapInArrow(trimmed(_spell_apart), "word long, key long")
    asked = codes.select("key", "n").unionByName(apart.select("key", F.lit(0).cast("long").alias("n"))).groupBy("key").agg(F.sum("n").alias("n"))
    value = code_values(asked).select(F.col("key").alias("k"), "value")
    return apart.join(value, F.col("key") == F.col("k")).groupBy("word").agg(F.sum("value").alias("spelt"))


def count(documents: DataFrame) -> DataFrame:
    """(key, word, n) of the distinct tokens; a written table. The end has no word."""
    found = documents.select("text").mapInArrow(trimmed(_count), "key long, word binary, n long")
    # Few keys of a task are there twice, so they are dealt before they are sorted for their sums.
    return materialize(found.repartition("key").groupBy("key").agg(F.min("word").alias("word"), F.sum("n").alias("n")), "tokens")


def spelling(tokens: DataFrame) -> DataFrame:
    """(key, n): how often each code of ``SPELL + 1`` bytes is spelled; a written table."""
    return materialize(tokens.select("word", "n").mapInArrow(trimmed(_spell), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 0"), "codes")


def _count_runs(size: int, front_b, back_b, part_bits: int):
    """Runs of ``size`` tokens whose front is in one bit map and whose back is in the other."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = collocations.HatTrie(size)
        front, back = front_b.value, back_b.value
        for batch in batches(rows):
            for _, _, _, _, ids, place in tokens_of(batch.column(0)):
                n = len(ids) - size + 1
                if n <= 0:
                    continue
                context = ids.copy()            # contexts of size - 1 tokens, by their last
                for k in range(1, size - 1):
                    context[k:] = longer(context[k:], ids[:-k])
                document = np.repeat(np.arange(len(place) - 1), np.diff(place))
                at = np.flatnonzero((document[:n] == document[size - 1:]) & _has(front, context[size - 2: size - 2 + n]) & _has(back, context[size - 1:]))
                for spilled in trie.add([ids[at + k] for k in range(size)]):
                    yield from collocations.chunks(spilled, part_bits)
        for rest in trie.rest():
            yield from collocations.chunks(rest, part_bits)

    return run


RUNS = "word long, n long, context long, tail long, whole long"


def _merged(size: int):
    """Sums of runs with the hashes that join them: their context, the run without its first token, and the run itself."""
    merge = collocations.merge(size, REPEAT, size)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merge(rows):
            words = [batch.column(k + 1).to_numpy().view(np.uint64) for k in range(size)]
            hashes = [context_of(words[:-1]), context_of(words[1:]), context_of(words)]
            yield pa.RecordBatch.from_arrays([batch.column(size), batch.column(size + 1), *[pa.array(signed(h)) for h in hashes]], names=["word", "n", "context", "tail", "whole"])

    return run


# --- the tree -----------------------------------------------------------------------

def _gain(n: Column, q: Column, rest: Column, total: Column) -> Column:
    """Nats that the context gains for a next token, each occurrence predicted from the others."""
    return n * F.log((n - 1 + rest * q) / (total - 1) / q)


def tree(documents: DataFrame, counts: DataFrame, depth: int = DEPTH, least: int = LEAST, diverge: float = DIVERGE, weight: float = WEIGHT) -> tuple[DataFrame, DataFrame]:
    """The kept contexts (context, places, rest, total) and their next tokens (context, word, n, places, total, whole: the hash of both); written tables.

    Of each level one table of runs is written. Its rows are joined to their run without the first token, then to their context, and
    stay partitioned by context for the sums over it; a context has a row for each of its next tokens at most.
    """
    spark = documents.sparkSession
    share = spark.sparkContext.broadcast
    tokens = counts.select(F.col("key").alias("whole"), "n")
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Of the level below: its runs by hash, with their count and their probability after their own context.
    lower = tokens.withColumn("share", F.col("n") / F.lit(float(max(total, 1))))
    kept = None
    for size in range(2, depth + 2):
        front = collocations.bit_map(lower.filter(F.col("n") >= least), F.col("whole"))
        back = collocations.bit_map(lower.filter(F.col("n") >= REPEAT), F.col("whole"))
        sent = share(front), share(back)
        stored = documents.select("text").mapInArrow(trimmed(_count_runs(size, *sent, collocations.parts(spark))), collocations.RUNS)
        merged = stored.repartition("part").sortWithinPartitions("low").mapInArrow(trimmed(_merged(size)), RUNS)
        up = lower.filter(F.col("n") >= least).select(F.col("whole").alias("w1"), F.col("n").alias("places"))
        side = lower.filter(F.col("n") >= REPEAT).select(F.col("whole").alias("w2"), F.col("share").alias("q"))
        joined = merged.join(side, F.col("tail") == F.col("w2")).drop("tail", "w2").join(up, F.col("context") == F.col("w1")).drop("w1")
        own = Window.partitionBy("context")
        summed = joined.withColumn("said", F.sum("n").over(own)).withColumn("kinds", F.count(F.lit(1)).over(own))
        rest, whole = (F.col("places") - F.col("said") + F.col("kinds")).cast("double"), (F.col("places") + F.col("kinds")).cast("double")
        tested = summed.withColumn("rest", rest).withColumn("total", whole).withColumn(
            "gain", F.sum(_gain(F.col("n"), F.col("q"), F.col("rest"), F.col("total"))).over(own)
        )
        lost = (F.col("places") - F.col("said")) * F.log(F.col("rest") / (F.col("total") - 1))
        level = materialize(
            tested.select(
                "context", "word", "n", "places", "rest", "total", "whole", (F.col("n") / F.col("places")).alias("share"),
                (F.col("gain") + lost >= diverge + weight * F.col("kinds")).alias("kept"),
            ),
            f"runs{size}",
        )
        for b in sent:
            b.destroy()
        good = level.filter("kept").select("context", "word", "n", "places", "rest", "total", "whole")
        kept = good if kept is None else kept.unionByName(good)
        lower = level.select("whole", "n", "share")
    entries = materialize(kept, "entries")
    states = materialize(entries.groupBy("context").agg(*[F.first(c).alias(c) for c in ("places", "rest", "total")]), "states")
    return states, entries.select("context", "word", "n", "places", "total", "whole")


# --- what a task holds --------------------------------------------------------------

def threshold(counts: DataFrame, value: str, most: int) -> int:
    """The least number below ``FINE``, or power of two from there on, so that at most ``most`` rows have as large a value."""
    step = F.when(F.col(value) < FINE, F.col(value)).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(value))).cast("long"))
    rows = counts.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("rows")).collect()
    size, least = 0, 1 << 62
    for b, n in sorted(((r["b"], r["rows"]) for r in rows), reverse=True):
        size += n
        if size > most:
            break
        least = b
    return least


@dataclass
class Held:
    """Frequent tokens, contexts and next tokens, and bit maps of what is not here."""

    tokens: np.ndarray
    counts: np.ndarray
    rare: tuple[np.ndarray, np.ndarray] | None      # bit maps of the tokens and runs that are not here; none if all are
    contexts: np.ndarray
    rest: np.ndarray                # share of the suffix's distribution
    totals: np.ndarray
    runs: np.ndarray                # hashes of contexts with a next token
    shares: np.ndarray
    known: tuple[np.ndarray, np.ndarray]            # bit maps of all contexts
    whole: bool                     # all contexts are here
    codes: np.ndarray
    code_counts: np.ndarray
    code_totals: np.ndarray         # of all codes with the same front
    code_values: np.ndarray | None  # log10 probabilities, if not all codes are here
    total: int
    distinct: int
    depth: int
    least: int                      # count of the tokens here
    places: int                     # places of the contexts here
    said: int                       # count of the next tokens here


def _rare(counts: DataFrame, entries: DataFrame, least: int, said: int) -> DataFrame:
    """(key, value): counts of the tokens and of the runs that no task holds."""
    value = F.col("n").cast("double").alias("value")
    words = counts.filter(F.col("n") < least).select("key", value)
    return words.unionByName(entries.filter(F.col("n") < said).select(F.col("whole").alias("key"), value))


def held(counts: DataFrame, states: DataFrame, entries: DataFrame, depth: int, tokens: int = TOKENS, most: int = STATES, codes: DataFrame | None = None) -> Held:
    words = counts.select("key", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least, places, said = threshold(words, "n", tokens), threshold(states, "places", most), threshold(entries, "n", most)
    top = words.filter(F.col("n") >= least).toArrow()
    rare = _rare(counts, entries, least, said)
    codes = (spelling(counts) if codes is None else codes).withColumn("front", F.shiftrightunsigned("key", 8))
    frequent = threshold(codes, "n", CODES)
    part = codes.filter(F.col("n") < frequent).limit(1).count() > 0
    fronts = codes.groupBy(F.col("front").alias("f")).agg(F.sum("n").alias("whole"))
    spelt = codes.filter(F.col("n") >= frequent).join(fronts, F.col("front") == F.col("f")).select("key", "n", "whole")
    if part:
        spelt = spelt.join(code_values(codes.select("key", "n")).select(F.col("key").alias("k"), "value"), F.col("key") == F.col("k")).drop("k")
    spelt = spelt.toArrow()
    own = states.filter(F.col("places") >= places).select("context", (F.col("rest") / F.col("total")).alias("rest"), "total").toArrow()
    kept = entries.filter(F.col("n") >= said).select("whole", (F.col("n") / F.col("total")).alias("share")).toArrow()
    as_ids = lambda t, c: t.column(c).to_numpy().view(np.uint64)
    return Held(
        as_ids(top, "key"), top.column("n").to_numpy(), _maps(rare) if rare.limit(1).count() else None,
        as_ids(own, "context"), own.column("rest").to_numpy(), own.column("total").to_numpy(), as_ids(kept, "whole"), kept.column("share").to_numpy(),
        _maps(states.select(F.col("context").alias("key"))), states.filter(F.col("places") < places).limit(1).count() == 0,
        as_ids(spelt, "key"), spelt.column("n").to_numpy(), spelt.column("whole").to_numpy(),
        spelt.column("value").to_numpy() if part else None, int(total), int(distinct), depth, least, places, said,
    )


class Model:
    """The held part, set up for look-ups."""

    def __init__(self, h: Held):
        self.held = h
        self.token, self.context, self.run = Lookup(h.tokens), Lookup(h.contexts), Lookup(h.runs)
        self.counts, self.shares = np.append(h.counts, 0), np.append(h.shares, 0.0)
        self.speller = Speller(h.codes, h.code_counts, h.code_totals) if h.code_values is None else Listed(h.codes, h.code_values)
        self.word, self.spelt = np.zeros(1 << WORD_BITS, np.uint64), np.zeros(1 << WORD_BITS)

    def spellings(self, ids: np.ndarray, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 spellings of distinct words, NaN if a code is not held; those met before come from a table."""
        place = ids >> np.uint64(64 - WORD_BITS)
        out = self.spelt[place]
        new = np.flatnonzero(self.word[place] != ids)
        if len(new):
            codes, begin = spelled(lower, starts[new], ends[new])
            out[new] = np.add.reduceat(self.speller(codes), begin[:-1])
            self.word[place[new]] = ids[new]
            alone = new[self.word[place[new]] == ids[new]]
            self.spelt[place[alone]] = out[alone]
        return out

    def first(self, count: np.ndarray, spelt: np.ndarray) -> np.ndarray:
        """Probability of tokens without context, from their counts and log10 spellings."""
        return first_share(count, spelt, self.held.total, self.held.distinct)

    def unspelt(self, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, place: np.ndarray, spelt: np.ndarray, asked: set[int]) -> list[dict]:
        """Words with codes that are not held, unless the task has given them on lately."""
        if len(asked) > HELD:
            asked.clear()
        end = place[1:] - 1
        inner = np.setdiff1d(np.flatnonzero(np.isnan(spelt)), end)
        words, first = np.unique(ids[inner], return_index=True)
        at = inner[first] - np.searchsorted(end, inner[first])      # without the ends before
        texts_ = [bytes(lower[a:b]) for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        found = list(zip(signed(spell_key(words)).tolist(), texts_))
        if len(end) and np.isnan(spelt[end[0]]):
            found.append((int(signed(spell_key(np.array([END_HASH])))[0]), None))
        found = [x for x in found if x[0] not in asked]
        asked.update(x[0] for x in found)
        return [{"key": k, "text": text} for k, text in found]

    def slope(self) -> float:
        """What one occurrence adds to the probability without context."""
        return 1.0 / (self.held.total + self.held.distinct) if self.held.total else 0.0

    def slab(self, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, place: np.ndarray) -> dict:
        """Of each token: count (-1 if it has to be looked up), log10 spelling, its terms of the base score and of its probability that are known, and what its
        contexts leave to the one without (times); also the runs to look up (token, run, factor of its count) and the contexts to look up (token, context, run),
        by level. What depends on the token alone is computed once for each distinct one."""
        h = self.held
        end = np.zeros(len(ids), bool)
        end[place[1:] - 1] = True
        distinct, at, inverse = np.unique(ids[~end], return_index=True, return_inverse=True)
        kind = np.full(len(ids), len(distinct))
        kind[~end] = inverse
        spelt = np.append(self.spellings(distinct, lower, starts[at], ends[at]), self.speller(END_CODE)[0])
        kinds = np.append(distinct, END_HASH)
        number = self.token(kinds)
        count = self.counts[number]
        if h.rare is not None:
            count = np.where((number < 0) & _in(h.rare, kinds), -1, count)
        counted = np.maximum(count, 0)
        first = np.where(np.isnan(spelt), self.slope() * counted, self.first(counted, spelt))
        base = np.where(count < 0, 0.0, np.log10((counted + 1.0) / (h.total + h.distinct + 1.0)))
        plus, times = np.zeros(len(ids)), np.ones(len(ids))
        position = np.arange(len(ids)) - np.repeat(place[:-1], np.diff(place))
        run = ids
        doubt, unheld = [], []
        for level in range(1, h.depth + 1):
            context, run = run, run.copy()
            run[level:] = longer(context[level:], ids[: len(ids) - level])
            here = np.flatnonzero(position >= level)
            here = here[_in(h.known, context[here - 1])]
            own = context[here - 1]
            number = self.context(own)
            met = number >= 0
            if not h.whole:
                unheld.append((here[~met], own[~met], run[here[~met]]))
            here, number = here[met], number[met]
            next_ = self.run(run[here])
            plus[here] = self.shares[next_] + h.rest[number] * plus[here]
            times[here] *= h.rest[number]
            if h.rare is not None:
                new = np.flatnonzero(next_ < 0)
                new = new[_in(h.rare, run[here[new]])]
                doubt.append((here[new], run[here[new]], 1.0 / h.totals[number[new]] / times[here[new]]))
        doubt = [(at, key, factor * times[at]) for at, key, factor in doubt]
        return {
            "count": count[kind], "spelt": spelt[kind], "base": base[kind], "value": plus + times * first[kind], "times": times, "doubt": doubt, "unheld": unheld
        }


def spell_key(ids: np.ndarray) -> np.ndarray:
    """Key of the spelling of words, beside that of their counts."""
    return mix(ids + STEP)


def first_share(count, spelt, total: int, distinct: int):
    if not total:
        return 10.0**spelt
    return (count + distinct * 10.0**spelt) / (total + distinct)


#: A token whose probability in its held contexts is plus and the terms' factors times what ``_rare`` (or ``spellings``) has for their keys; then come the
#: contexts that are not held, short ones first. Of a rare token the first term is its own count. Tokens with one term and no such contexts, nearly all, lie
#: apart (``alone``), so that the others are read without them.
TERM = pa.struct([("key", pa.int64()), ("factor", pa.float64())])
STEPS = pa.struct([("context", pa.int64()), ("run", pa.int64())])
OPEN = pa.struct([("rare", pa.bool_()), ("plus", pa.float64()), ("terms", pa.list_(TERM)), ("contexts", pa.list_(STEPS))])
ALONE = pa.struct([("rare", pa.bool_()), ("plus", pa.float64()), ("key", pa.int64()), ("factor", pa.float64())])
SCORED = (
    "row long, doc_id long, n_tokens long, known long, base double, score double, alone array<struct<rare:boolean,plus:double,key:long,factor:double>>, "
    "open array<struct<rare:boolean,plus:double,terms:array<struct<key:long,factor:double>>,contexts:array<struct<context:long,run:long>>>>, "
    "unspelt array<struct<key:long,text:binary>>"
)
UNSPELT = pa.list_(pa.struct([("key", pa.int64()), ("text", pa.binary())]))


def _score(held_b):
    """Scores of the tokens that need nothing else, by document, and the other tokens."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = held_b.value
        model = Model(h)        # not kept: idle workers would hold it beside the joins that follow
        number = TaskContext.get().partitionId() << 36
        asked: set[int] = set()
        for batch in batches(rows):
            for i, lower, starts, ends, ids, place in tokens_of(batch.column(1)):
                n = len(place) - 1
                document = np.repeat(np.arange(n), np.diff(place))
                v = model.slab(lower, starts, ends, ids, place)
                rare = v["count"] < 0
                unspelt = np.isnan(v["spelt"])
                waits = rare | unspelt
                for at, *_ in (*v["doubt"], *v["unheld"]):
                    waits[at] = True
                value = v["value"]
                words = model.unspelt(lower, starts, ends, ids, place, v["spelt"], asked) if unspelt.any() else []
                sums = [np.bincount(document, weight, n).astype(np.float64) for weight in (v["count"] > 0, v["base"])]
                sums.append(np.bincount(document[~waits], np.log10(value[~waits]), n).astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number + np.arange(n)), batch.column(0).slice(i, n), pa.array(np.diff(place)), pa.array(sums[0].astype(np.int64)),
                     pa.array(sums[1]), pa.array(sums[2]), *_open(model, ids, v, document, n),
                     pa.array([words] + [None] * (n - 1), UNSPELT)],
                    names=["row", "doc_id", "n_tokens", "known", "base", "score", "alone", "open", "unspelt"],
                )
                number += n

    return run


def _lists(at: np.ndarray, found: list[tuple], kind: pa.StructType) -> pa.Array:
    """For each of the tokens ``at`` the list of what is found for it, in the order found."""
    found = [x for x in found if len(x[0])] or [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, kind.field(1).type.to_pandas_dtype()))]
    token, *columns = [np.concatenate(c) for c in zip(*found)]
    order = np.argsort(token, kind="stable")
    bounds = np.append(np.searchsorted(token[order], at), len(token)).astype(np.int32)
    values = [pa.array(c[order] if c.dtype == np.float64 else signed(c[order])) for c in columns]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(values, fields=list(kind)))


def _open(model: Model, ids: np.ndarray, v: dict, document: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """The tokens of each document that wait for one count alone, and the others that wait."""
    rare, unspelt = np.flatnonzero(v["count"] < 0), np.flatnonzero(np.isnan(v["spelt"]))
    factor = v["times"] * model.slope()
    terms = [(rare, ids[rare], factor[rare]), (unspelt, spell_key(ids[unspelt]), factor[unspelt]), *v["doubt"]]
    needs = np.zeros(len(ids), np.int8)
    key, times = np.zeros(len(ids), np.uint64), np.zeros(len(ids))
    for at, *own in terms:
        needs[at] += 1
        key[at], times[at] = own
    for at, *_ in v["unheld"]:
        needs[at] = 2
    alone, others = np.flatnonzero(needs == 1), np.flatnonzero(needs > 1)
    some = lambda found: [tuple(c[needs[x[0]] > 1] for c in x) for x in found]

    def by_document(at: np.ndarray, columns: list, kind: pa.StructType) -> pa.Array:
        rows = pa.StructArray.from_arrays([pa.array(v["count"][at] < 0), pa.array(v["value"][at]), *columns], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(document[at], np.arange(n + 1)).astype(np.int32)), rows)

    return (
        by_document(alone, [pa.array(signed(key[alone])), pa.array(times[alone])], ALONE),
        by_document(others, [_lists(others, some(terms), TERM), _lists(others, some(v["unheld"]), STEPS)], OPEN),
    )


def _resolved(first: DataFrame, rare: DataFrame, states: DataFrame, entries: DataFrame, h: Held) -> DataFrame:
    """(row, more_known, more_base, more_score) of the tokens that wait for tables.

    Those that wait for one count are summed at once. The terms and contexts of the others go to their tables alone and meet again by token.
    """
    values = rare.select(F.col("key").alias("k"), "value")

    def looked_up(some: DataFrame) -> DataFrame:
        return some.join(values, F.col("key") == F.col("k"), "left").withColumn("value", F.coalesce("value", F.lit(0.0)))

    def summed(some: DataFrame) -> DataFrame:
        return some.groupBy("row").agg(
            F.count(F.when(F.col("count") > 0, 1)).alias("more_known"), F.sum(F.log10((F.col("count") + 1.0) / F.lit(h.total + h.distinct + 1.0))).alias("more_base"),
            F.sum(F.log10("p")).alias("more_score"),
        )

    own = F.col("plus") + F.col("factor") * F.col("value")
    one = looked_up(first.select("row", F.explode("alone").alias("t")).select("row", "t.*"))
    ones = summed(one.select("row", F.when(F.col("rare"), F.col("value")).alias("count"), own.alias("p")))
    more = first.select("row", F.posexplode("open").alias("at", "t")).select("row", "at", "t.*")
    terms = looked_up(more.select("row", "at", "rare", F.posexplode("terms").alias("k0", "t")).select("row", "at", "rare", "k0", "t.*"))
    steps = more.select("row", "at", F.posexplode("contexts").alias("level", "c")).select("row", "at", "level", "c.*")
    state = states.filter(F.col("places") < h.places).select(F.col("context").alias("s"), "rest", "total")
    next_ = entries.filter(F.col("places") < h.places).select(F.col("whole").alias("w"), "n")
    met = steps.join(state, F.col("context") == F.col("s")).join(next_, F.col("run") == F.col("w"), "left")
    step = F.struct("level", (F.coalesce("n", F.lit(0)) / F.col("total")).alias("share"), (F.col("rest") / F.col("total")).alias("rest"))
    none = F.lit(None)
    parts = more.select("row", "at", "plus", none.cast("double").alias("count"), none.cast("struct<level:int,share:double,rest:double>").alias("step")).unionByName(
        terms.select("row", "at", (F.col("factor") * F.col("value")).alias("plus"), F.when(F.col("rare") & (F.col("k0") == 0), F.col("value")).alias("count"), none.alias("step"))
    ).unionByName(met.select("row", "at", F.lit(0.0).alias("plus"), none.alias("count"), step.alias("step")))
    folded = F.aggregate("steps", F.col("plus"), lambda p, x: x.share + x.rest * p)
    by_token = parts.repartition("row").groupBy("row", "at").agg(
        F.sum("plus").alias("plus"), F.max("count").alias("count"), F.sort_array(F.collect_list("step")).alias("steps")
    )
    both = ones.unionByName(summed(by_token.select("row", "count", folded.alias("p"))))
    return both.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("more_known", "more_base", "more_score")])


def score(
    documents: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, tokens: int = TOKENS, most: int = STATES,
    least: int = LEAST, diverge: float = DIVERGE,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document, learnt from ``training``."""
    given = texts(documents, id_col, text_col)
    bound_batches(given.sparkSession)
    learnt = texts(training, id_col, text_col)
    counts = count(learnt)
    states, entries = tree(learnt, counts, depth, least, diverge)
    codes = spelling(counts)
    h = held(counts, states, entries, depth, tokens, most, codes)
    sent = given.sparkSession.sparkContext.broadcast(h)
    first = materialize(given.mapInArrow(trimmed(_score(sent)), SCORED), "scored")
    sent.destroy()
    values = _rare(counts, entries, h.least, h.said)
    if h.code_values is not None:
        words = first.select(F.explode("unspelt").alias("u")).groupBy(F.col("u.key").alias("word")).agg(F.min("u.text").alias("text"))
        spelt = materialize(spellings(materialize(words, "words"), codes), "spellings")
        values = values.unionByName(spelt.select(F.col("word").alias("key"), (h.distinct * F.pow(F.lit(10.0), F.col("spelt"))).alias("value")))
    more = _resolved(first, values, states, entries, h)
    return first.drop("alone", "open", "unspelt").join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(h.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learning from those outside the held-out fold."""
    from hourgrid.llm.common import table

    documents = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), FOLD[0]) == FOLD[1]
    scored = score(documents, documents.filter(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
