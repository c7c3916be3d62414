"""Exact dedup by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Texts are equal when they are the same after each run of white space (``[\\x20\\x09-\\x0D]+``) has become
one blank. Of equal texts the row with the smallest id stays.

1. Rows are counted by the length of the normalised text, and within a length by a hash of its first
   ``HEAD`` characters; counts are combined before the shuffle. A row that is alone there is settled.
2. The pairs (length, beginning) that more than one row has are marked in a bit map of ``BITS`` bits, made by
   ``bitmap_construct_agg``. It has at most ``BITS / 8`` bytes at any size of the table (8 MiB), so it can be
   broadcast; a wrongly marked row costs a hash and nothing else.
3. Only marked rows get the hash of their whole text (SHA-256). What is written is (row, id, hash), not texts:
   no text is ever shuffled. Groups are counted and joined on the hash; a group that holds a third of
   all rows is one row of the group table, and adaptive execution splits its side of the join.

Defined results: a null text is empty, and empty texts are equal; a null id comes after all others, and a group
with null ids alone has a null ``keep_id``; of rows that tie on the smallest id one stays, whichever was written
first; rows keep their number, repeated ones too; an empty table gives no row. Further columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.llm.common import free_names, table
from hourgrid.session import materialize

HEAD = 128                  # characters of the beginning
BUCKETS = 2048              # of 32,768 bits each, which is what a bit map of Spark holds
BITS = BUCKETS * 32768


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _mark(length: Column, head: Column) -> Column:
    """Place in the bit map, from 1 as ``bitmap_bit_position`` counts."""
    return F.pmod(F.xxhash64(length, head), F.lit(BITS)) + 1


def survivors(facts: DataFrame) -> DataFrame:
    """(bucket, bits): the bit map of the (n, head) that more than one row has; at most ``BUCKETS`` rows of 4 KiB."""
    by_head = facts.groupBy("n", "head").agg(F.count(F.lit(1)).alias("rows"))
    lengths = by_head.groupBy("n").agg(F.sum("rows").alias("of_length"))
    repeated = by_head.join(lengths.filter("of_length > 1").select("n"), "n", "left_semi").filter("rows > 1")
    mark = _mark(F.col("n"), F.col("head"))
    return repeated.groupBy(F.bitmap_bucket_number(mark).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(mark)).alias("bits"))


def _marked(bits: Column, mark: Column) -> Column:
    """Whether the bit is set; false where there is no bit map of the bucket."""
    place = F.bitmap_bit_position(mark)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False))


def hashed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", all_digests: bool = False) -> DataFrame:
    """(row, doc_id, open, digest): whether the row has survived to the last step, and its SHA-256; a written table.

    Rows settled before have no digest, unless ``all_digests`` asks for it.
    """
    given = df.select(df[id_col].alias("doc_id"), normalised(df[text_col]).alias("norm"))
    length, head = F.octet_length("norm"), F.xxhash64(F.substring("norm", 1, HEAD))
    marks = materialize(survivors(given.select(length.alias("n"), head.alias("head"))), "marks")
    rows = given.withColumn("mark", _mark(length, head)).withColumn("bucket", F.bitmap_bucket_number("mark"))
    flagged = rows.join(F.broadcast(marks), "bucket", "left").select("doc_id", "norm", _marked(F.col("bits"), F.col("mark")).alias("open"))
    digest = F.unhex(F.sha2("norm", 256))
    return materialize(
        flagged.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "open",
            (digest if all_digests else F.when(F.col("open"), digest)).alias("digest"),
        ),
        "digests",
    )


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", all_digests: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row."""
    rows = hashed(df, id_col, text_col, all_digests)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    groups = rows.filter("open").groupBy(F.col("digest").alias("of")).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    joined = rows.join(groups, F.col("open") & (F.col("digest") == F.col("of")), "left")
    alone = F.col("first").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("first.row") == F.col("row"))).alias("kept"), "digest",
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table without the rows that have an equal text under a smaller id.

    Rows that tie on the smallest id of a group all stay here, as they cannot be told apart by their id.
    """
    gone, digest = free_names(df, "copy_id", "copy_digest")
    found = classes(df, id_col, text_col).filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    key = found.select(F.col("doc_id").alias(gone), F.col("digest").alias(digest)).distinct()
    return df.join(key, df[id_col].eqNullSafe(F.col(gone)) & (F.unhex(F.sha2(normalised(df[text_col]), 256)) == F.col(digest)), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays in its place."""
    found = classes(table(spark, sf_dir, "documents"), all_digests=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
