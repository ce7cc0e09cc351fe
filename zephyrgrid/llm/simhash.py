"""SimHash near-duplicates found by decoding fingerprint segments with the binary Golay code.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 hashes of
all word shingles.  Two fingerprints link at two or fewer differing bits.

The 64 bits are cut into three segments of 22, 21 and 21 bits.  Of at most two
errors, at least one segment is free (pigeonhole); it goes into the key as it
stands.  The next segment may hold both errors.  It is read as a word of the
perfect (23, 12) Golay code and replaced by the indices of all codewords within
distance four: one to six of them, and two words at distance two or less always
share one.  So every fingerprint has three to eighteen keys of about 33 bits,
and every link meets in one of them.  Pairs that meet are verified on all bits.

A bucket with more than ``BUCKET`` fingerprints is not compared pair by pair.
Its members are linked through one-bit neighbours instead: two fingerprints
differ in at most two bits exactly if some value lies within one bit of both,
and at most 65 distinct fingerprints lie within one bit of a value.  That is as
exact, and its work grows with the members, not with their pairs.

Fingerprints are distinct before any of this; documents that share one are only
counted.  Defined cases: a null or empty text has fingerprint zero and links like
any other; a text shorter than a shingle hashes as a whole; null ids are never
the smallest id of a component unless it has no other; repeated rows each give a
row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import components, salted_join

SEED = 42
WORDS = 3
BUCKET = 64
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and width
# The generator polynomial of the binary Golay code.
GENERATOR, CHECK_BITS, WORD_BITS = 0b101011100011, 11, 23
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HASHES_AT_ONCE = 1 << 15


def shingle_hashes(text: str | None, words: int = WORDS) -> bytes:
    """The big-endian hashes of all shingles of ``text``, end to end."""
    tokens = (text or "").encode().translate(LOWER).split()
    if not tokens:
        return b""
    if len(tokens) < words:
        return xxhash.xxh64_digest(b" ".join(tokens), SEED)
    joined = b" ".join(tokens)
    after = list(accumulate(map(len, tokens), lambda at, size: at + 1 + size))
    starts = [0, *(end + 1 for end in after)]
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[s:e], SEED) for s, e in zip(starts, after[words - 1:])])


def fingerprint(text: str | None, words: int = WORDS) -> int:
    hashes = shingle_hashes(text, words)
    count = len(hashes) // 8
    if not count:
        return 0
    rows = np.frombuffer(hashes, np.uint8).reshape(count, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, HASHES_AT_ONCE):
        ones += np.unpackbits(rows[at:at + HASHES_AT_ONCE], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def _fingerprint_batches(words: int, mark=fingerprint):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([mark(t.as_py(), words) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values)], names=["id", "fp"])

    return run


def fingerprints(documents: DataFrame, key: str = "doc_id", words: int = WORDS, mark=fingerprint) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint, or what ``mark`` gives, as a signed 64-bit number."""
    rows = documents.select(F.col(key).alias("id"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_fingerprint_batches(words, mark), f"id {kind}, fp bigint")


def _remainders(words: np.ndarray) -> np.ndarray:
    """The syndrome of each 23-bit word: its remainder by the generator."""
    rest = words.astype(np.uint32)
    for bit in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ np.uint32(GENERATOR << (bit - CHECK_BITS)), rest)
    return rest


def nearby_patterns() -> np.ndarray:
    """For each syndrome the error patterns of weight four or less, six columns, unused ones filled with -1."""
    table = np.full((1 << CHECK_BITS, 6), -1, np.int64)
    used = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(WORD_BITS), weight)], np.uint32)
        for pattern, syndrome in zip(patterns.tolist(), _remainders(patterns).tolist()):
            table[syndrome, used[syndrome]] = pattern
            used[syndrome] += 1
    return table


def keys_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``values``, key) for every key of every fingerprint."""
    patterns = nearby_patterns()
    values = values.view(np.uint64)
    cuts = [(values >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64) for shift, width in SEGMENTS]
    rows, keys = [], []
    for clean in range(len(SEGMENTS)):
        word = cuts[(clean + 1) % len(SEGMENTS)]
        errors = patterns[_remainders(word)]
        index = (word[:, None] ^ errors) >> CHECK_BITS
        key = (np.int64(clean) << 40 | cuts[clean] << 12)[:, None] | index
        found = errors >= 0
        rows.append(np.nonzero(found)[0])
        keys.append(key[found])
    return np.concatenate(rows), np.concatenate(keys)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("fp").to_numpy(zero_copy_only=False)
        rows, keys = keys_of(values)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[rows])], names=["key", "fp"])


def _verified_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the few members of each bucket; each points at the smallest it is linked with, directly or not."""
    for batch in batches:
        left, right = [], []
        for members in batch.column("members"):
            values = np.sort(np.array(members.as_py(), np.int64))
            near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
            label = np.arange(len(values))
            while True:
                lower = np.where(near, label[None, :], len(values)).min(axis=1)
                if (lower == label).all():
                    break
                label = lower
            hung = label != np.arange(len(values))
            left.append(values[hung])
            right.append(values[label[hung]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.array([], np.int64)) for x in (left, right)], names=["a", "b"])


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that connect whatever two or fewer differing bits connect."""
    keys = nodes.select("fp").mapInArrow(_key_batches, "key bigint, fp bigint")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    sizes = cut_lineage(sizes)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    pairs = sizes.where("n = 2").where(near).select("a", "b")
    larger = salted_join(keys, sizes.where("n > 2").select("key", "n"), ["key"])
    small = larger.where(f"n <= {BUCKET}").groupBy("key").agg(F.collect_list("fp").alias("members")).select("members").mapInArrow(
        _verified_stars, "a bigint, b bigint")
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(64)])
    around = larger.where(f"n > {BUCKET}").select("fp").distinct().select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    met = around.groupBy("value").agg(F.collect_set("fp").alias("members")).where("size(members) > 1")
    hubs = met.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b")
    return pairs.unionByName(small).unionByName(hubs)


def near_groups(marked: DataFrame, find=links) -> DataFrame:
    """(id, fp, component_id, root) for rows (id, fp); component_id is the smallest id in reach over the links that ``find`` gives."""
    marked = cut_lineage(marked)
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("smallest")))
    roots = components(find(nodes))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = salted_join(rooted.select("fp", "root"), lowest, ["root"]).select("fp", "component_id", "root")
    return salted_join(marked, named, ["fp"]).select("id", "fp", "component_id", "root")


def hex_digits(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def survivors(documents: DataFrame, key: str = "doc_id", mark=fingerprint, find=links) -> DataFrame:
    """One row of each component, whole: the one with its smallest id.

    Rows with an id of their own are told apart by it, and only the ids to drop
    are looked up.  Rows that share an id, or have none, are told apart by
    fingerprint too; where several of them could stay for a component, the first
    by its printed form does.
    """
    name = F.coalesce(F.concat(F.lit("i"), F.col("id").cast("string")), F.lit(""))
    groups = cut_lineage(near_groups(fingerprints(documents, key, mark=mark), find).withColumn("name", name))
    shared = cut_lineage(groups.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR name = ''").select("name"))
    dropped = groups.where("NOT (id <=> component_id)").select("name", F.lit(False).alias("is_shared"))
    fates = dropped.unionByName(shared.withColumn("is_shared", F.lit(True))).groupBy("name").agg(F.bool_or("is_shared").alias("is_shared"))
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(key).alias("id"), "text").withColumn("name", name)
    # One join tells single rows that stay (no fate) from rows to look at again.
    told = whole.join(fates, "name", "left")
    single = told.where("is_shared IS NULL").select("row.*")
    kept = groups.where("id <=> component_id").select("name", "fp", "root").distinct()
    rows = told.where("is_shared").select("row", "name", "text")
    marked = rows.mapInArrow(_marked_rows(mark), T.StructType([*rows.select("row", "name").schema.fields, T.StructField("fp", T.LongType())]))
    several = salted_join(marked, kept, ["name", "fp"]).groupBy("root").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return single.unionByName(several.select("row.*"))


def _marked_rows(mark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (row, name, text) as (row, name, fp)."""
        for batch in batches:
            values = np.array([mark(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("name"), pa.array(values)], names=["row", "name", "fp"])

    return run
