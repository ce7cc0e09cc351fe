"""Packing token sequences by minimum bin slack, solved on the histogram of lengths.

Documents longer than a window are cut at multiples of the window; what is left
of each is a piece of some length below it.  There are at most ``capacity``
distinct lengths, whatever the number of documents, so the packing itself is
solved on (length, count) pairs: the longest remaining length opens a window, a
subset-sum over the other lengths (a bitset in one integer, counts split into
powers of two) finds the filling closest to the capacity, and walking back
through the bitsets yields how often each length is used.  That filling is
applied as many times as the counts allow before the next one is sought.

Pieces then look up their place by their rank among pieces of equal length.
The plan is a table of rank intervals; it is bounded by the lengths, not by the
pieces, and is broadcast.  Ranks come from `common.ranked`, which cuts a length
that owns a third of all rows into cells.

Defined cases: a null text is empty and still has its end token; repeated rows
are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ranked, stretches
from .wordbpe import Merges

CAPACITY = 4096
END_ID = 2
CACHED_WORDS = 600_000
# Letters that stay one letter when lower-cased and composed; and what closes a word that ends in one.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e"
PLAIN = re.compile(f"[{_LETTERS}]+")
CLOSING = re.compile(f"(?<=[{_LETTERS}])([.,!]+)(?=[ \\n\\t\\r]|\\Z)")
_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of whole texts, as little-endian 32-bit numbers, with a bounded memory of words.

    The vocabulary drops white space and never merges across it, so a text may be
    encoded word by word; a letter and the punctuation that closes its word are
    apart as well.  New words of plain letters go through the same
    merges, many at a time; everything unusual goes to the tokenizer as it stands.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.forget()

    def forget(self) -> None:
        """Give the memory of words back; workers outlive their tasks."""
        self.known: dict[str, bytes] = {"": b""}
        pa.default_memory_pool().release_unused()

    def _learn(self, words: set[str]) -> None:
        plain = list(filter(PLAIN.fullmatch, words))
        self.known.update(zip(plain, self.merges.encode([s.lower().encode() for s in plain])))
        odd = list(words.difference(plain))
        for word, found in zip(odd, self.tokenizer.encode_batch(odd, add_special_tokens=False)):
            self.known[word] = np.array(found.ids, "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        split = [CLOSING.sub(r" \1", t).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.forget()
        fresh = set().union(*split).difference(self.known)
        if fresh:
            self._learn(fresh)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _cut_batches(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        try:
            yield from pieces(words, batches)
        finally:
            words.forget()

    def pieces(words: WordEncoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, lengths, sums, totals, ids = [], [], [], [], [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for row, tokens in enumerate(t + end for a, b in stretches(texts, 4 << 20) for t in words.encode_all(texts[a:b])):
                total = len(tokens) // 4
                for start in range(0, total, capacity):
                    piece = tokens[4 * start:4 * (start + capacity)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
            columns = [batch.column("id").take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def cut(documents: DataFrame, tokenizer: str, key: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID,
        with_ids: bool = True) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]): the documents' tokens in pieces of at most ``capacity``."""
    rows = documents.select(F.col(key).alias("id"), "text")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return rows.mapInArrow(_cut_batches(tokenizer, capacity, end_id, with_ids), schema + (", ids array<int>" if with_ids else ""))


def closest_filling(lengths: list[tuple[int, int]], target: int) -> Counter:
    """How often to use each of the (length, count) pairs so that the sum is as close below ``target`` as any."""
    reach, trail = 1, []
    mask = (1 << (target + 1)) - 1
    for length, count in lengths:
        if length > target:
            continue
        left, times = min(count, target // length), 1
        while left > 0:
            used = min(times, left)
            trail.append((reach, length, used))
            reach |= reach << (length * used) & mask
            left -= used
            times *= 2
        if reach >> target & 1:
            break
    best = reach.bit_length() - 1
    uses: Counter = Counter()
    for before, length, used in reversed(trail):
        if not before >> best & 1:
            best -= length * used
            uses[length] += used
    return uses


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, low, high, uses, first sequence, offset): where the pieces of a length with rank in [low, high) go.

    Sequence ``first + (rank - low) // uses`` holds ``uses`` of them side by side from ``offset`` on.
    """
    left = dict(sorted(histogram.items(), reverse=True))
    taken = dict.fromkeys(left, 0)
    entries, sequence = [], 0
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        uses = closest_filling([(n, c) for n, c in left.items() if c], capacity - longest)
        left[longest] += 1
        uses[longest] += 1
        times = min(left[n] // u for n, u in uses.items())
        offset = 0
        for n, u in sorted(uses.items(), reverse=True):
            entries.append((n, taken[n], taken[n] + u * times, u, sequence, offset))
            taken[n] += u * times
            left[n] -= u * times
            offset += n * u
            if not left[n]:
                del left[n]
        sequence += times
    return entries


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) plus ``sequence_id`` and ``offset``; no other columns are read."""
    pieces = cut_lineage(pieces)
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(not 0 < n <= capacity for n in histogram):
        raise ValueError(f"piece lengths must lie between 1 and {capacity}")
    fields = "plan_length bigint, low bigint, high bigint, uses bigint, first bigint, at bigint"
    entries = pieces.sparkSession.createDataFrame(plan(histogram, capacity), fields)
    numbered = ranked(pieces, "length", sum(histogram.values()))
    fits = (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return numbered.join(F.broadcast(entries), fits).select(
        *pieces.columns, (F.col("first") + F.expr("(rank - low) div uses")).alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("uses")) * F.col("length")).alias("offset"))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed windows themselves, from placed pieces that carry their ids.

    A window holds at most its capacity in tokens, so gathering one is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
