"""Exact deduplication in two passes over a Bloom filter, in DataFrame operations only.

Pass one sets a bit for every position that at least two rows hash to.  Pass two
tests each row: only if all its bits are set may the row be repeated, and only
then is it shuffled and grouped by the SHA-256 of its text.  All other rows pass
straight through.

The filter is cut into blocks of 32,768 bits (both bits of a row lie in one
block) and is broadcast.  It has sixteen bits a row, up to ``max_bits`` (2^30:
128 MB), which bounds the broadcast.  Beyond some 10^8 rows it fills up and more
rows take the shuffle; results stay the same.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
Defined cases: of equal texts the row with the largest id stays (a null id is the
smallest); of fully repeated rows exactly one stays; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ascii_lower, salted_join

BLOCK_BITS = 15
BITS_PER_ROW = 16
MAX_BITS = 1 << 30


def text_hash(text: str | Column = "text") -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.sha2(ascii_lower(F.coalesce(column, F.lit(""))), 256)


def _block(digest: Column, blocks: int) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit(blocks - 1)).cast("int")


def _bits(digest: Column) -> Column:
    """Two positions within the block, from bits that the block number does not use."""
    mixed = F.xxhash64(F.lit("bits"), digest)
    low = (1 << BLOCK_BITS) - 1
    return F.array(mixed.bitwiseAND(F.lit(low)).cast("int"), F.shiftright(mixed, 20).bitwiseAND(F.lit(low)).cast("int"))


def repeated_filter(hashes: DataFrame, rows: int, max_bits: int = MAX_BITS) -> tuple[DataFrame, int]:
    """(block, bitmap) with the bits that two or more rows set, and the number of blocks.

    The number of blocks is a power of two.  Counts are combined before they
    shuffle, and a row is a number by then.
    """
    bits = min(max_bits, max(1 << BLOCK_BITS, 1 << (rows * BITS_PER_ROW - 1).bit_length()))
    blocks = bits >> BLOCK_BITS
    where = hashes.select(_block(F.col("hash"), blocks).alias("block"), F.explode(F.array_distinct(_bits(F.col("hash")))).alias("bit"))
    twice = where.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("bigint")).alias("bitmap")), blocks


def marked(rows: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """``rows`` (with ``hash``) plus ``maybe``: true if the filter says the row may be repeated."""
    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1

    bit = _bits(F.col("hash"))
    tested = rows.withColumn("block", _block(F.col("hash"), blocks)).join(F.broadcast(bits), "block", "left")
    both = is_set(bit[0]) & is_set(bit[1])
    return tested.withColumn("maybe", F.coalesce(F.col("bitmap").isNotNull() & both, F.lit(False))).drop("block", "bitmap")


def groups(documents: DataFrame, key: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) for every row of ``documents``."""
    hashed = cut_lineage(documents.select(F.col(key).alias("id"), text_hash().alias("hash")))
    bits, blocks = repeated_filter(hashed, max(1, hashed.count()), max_bits)
    rows = marked(hashed, bits, blocks)
    straight = rows.where("NOT maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "hash")
    counted = rows.where("maybe").groupBy("hash", "id").agg(F.count(F.lit(1)).alias("copies"))
    whole = counted.groupBy("hash").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    each = salted_join(counted, whole, ["hash"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    shuffled = each.select("id", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "hash")
    return straight.unionByName(shuffled).select(F.col("id").alias(key), "keep_id", "group_size", "kept", F.col("hash").alias("text_sha256"))


def survivors(documents: DataFrame, key: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``documents`` that stay, whole; texts of rows that can't be repeated never shuffle."""
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(key).alias("id"),
                            F.col("text").alias("raw"), text_hash().alias("hash"))
    hashed = cut_lineage(rows.select("hash"))
    bits, blocks = repeated_filter(hashed, max(1, hashed.count()), max_bits)
    tested = marked(rows, bits, blocks)
    # Rows of one id and text may still differ elsewhere; their printed form settles which one stays.
    best = F.max_by("row", F.struct("id", "raw", F.to_json("row")))
    chosen = tested.where("maybe").groupBy("hash").agg(best.alias("row"))
    return tested.where("NOT maybe").select("row.*").unionByName(chosen.select("row.*"))
