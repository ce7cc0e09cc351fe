"""Alignment of two tokenizations of one text by merging their token ends along merge paths.

Tokens of both sides cover the same bytes, so an alignment is the merge of two
ordered lists of byte offsets.  The merge is cut into pieces of equal work: a
binary search on each diagonal finds how many ends of either side lie before it,
and the pieces then run independently, all of them side by side in array
operations.  Each step of a piece looks at its two positions only (and at the end
just before them), so an end that both sides share is recognised even where a
diagonal divides it; running sums over the pieces stitch them into groups.

Neither vocabulary joins anything across a single blank or line break that stands
between other characters (checked when a vocabulary is loaded), hence such places
are always common ends.  Texts are cut there, new chunks are encoded and merged
many at a time, and their results are kept per worker (``KEPT_CHUNKS``).

Counts of linked id pairs over the corpus come from a first pass, as counts of
chunks times the links of a chunk; only sums per pair shuffle.  The second pass
looks its links up in the table of pairs.  That table is broadcast while it holds
at most ``BROADCAST_PAIRS`` rows; a larger one is joined instead, with the same result.

Defined cases: null and empty texts, and texts that one side cannot spell byte by
byte (the blank sign of the piece vocabulary inside a text), have no tokens: zeros
and empty groups.  A null id is kept as it is; repeated rows each give a row and
each count; extra columns are not read; an empty table gives an empty result.  A
very long text is worked on in stretches of about a million characters; only its
groups column is held whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import salted_join, stretches
from .wordbpe import byte_letters

BLANK = "▁"
PIECE = 64
KEPT_CHUNKS = 450_000
BLOCK_CHARS = 1 << 14
STRETCH = 1 << 20
BROADCAST_PAIRS = 1 << 22
PAIR_SHIFT = 32
# Two kinds of white space in a row, or at the end: such a text is cut with the slower pattern.
ODD = re.compile(r"\s(?:\s|\Z)")
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}


def split_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of ``a`` are among the first d of the merged ends, for each d of ``diagonals``; of equal ends that of ``a`` comes first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        # a[middle] belongs before the diagonal if it is not above the last end taken from b.
        before = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonals - middle - 1, 0, len(b) - 1)])
        low, high = np.where(before, middle + 1, low), np.where(open_ & ~before, middle, high)
    return low


def merge_paths(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, closes): every overlapping pair in order; ``closes`` marks those that end together.

    ``a`` and ``b`` are increasing ends with the same last value.  A pair is emitted
    where the earlier of its two ends lies.
    """
    total = len(a) + len(b)
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    diagonals = np.arange(0, total, piece)
    i = split_path(a, b, diagonals)
    j = diagonals - i
    work = np.minimum(piece, total - diagonals)
    last = np.iinfo(np.int64).max
    wide_a, wide_b = np.append(a, last), np.append(b, last)
    out_a, out_b, closes, emitted = (np.zeros((piece, len(i)), kind) for kind in (np.int64, np.int64, bool, bool))
    for step in range(piece):
        left, right = wide_a[i], wide_b[j]
        going = step < work
        takes_a = going & (left <= right)
        takes_b = going & ~takes_a
        repeated = (i > 0) & (wide_a[i - 1] == right)
        out_a[step], out_b[step] = i, j
        closes[step] = takes_a & (left == right)
        emitted[step] = takes_a | (takes_b & ~repeated)
        i, j = i + takes_a, j + takes_b
    # Pieces stand in columns: read them one after the other.
    keep = emitted.T.ravel()
    return out_a.T.ravel()[keep], out_b.T.ravel()[keep], closes.T.ravel()[keep]


def literal(chunk: str) -> str:
    """The characters a chunk stands for: a leading blank is left out where it is the usual one."""
    return chunk if chunk[:1] in (" ", "\n") else " " + chunk


def chunks_of(text: str) -> list[str]:
    """Chunks of ``text``, which begins with a blank or line break; cut before single blanks and line breaks."""
    if not ODD.search(text):
        return text.replace("\n", " \n")[1:].split(" ")
    return [c[1:] if c[0] == " " and not c[1:2].isspace() and c[1:2] else c for c in CUT.split(text)]


def stretches_of(text: str, size: int = STRETCH) -> Iterator[str]:
    """A blank and the text, in stretches that begin at single blanks or line breaks."""
    text, start = " " + text, 0
    while len(text) - start > size:
        found = CUT.search(text, start + size)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text


@dataclass
class Kept:
    """What is known of each chunk: counts per chunk, links as a flat list with starts."""

    counts: np.ndarray
    links: np.ndarray
    starts: np.ndarray
    fine: np.ndarray


class Aligner:
    """Both tokenizers and a bounded memory of aligned chunks."""

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        # A byte-level vocabulary whose ids are its merge ranks: special tokens left out, their strings are plain text.
        with open(a_path, encoding="utf-8") as file:
            whole = json.load(file)
        special = {t["id"] for t in whole["added_tokens"]}
        values = {letter: byte for byte, letter in enumerate(byte_letters())}
        ranks = {bytes(values[c] for c in token): at for token, at in whole["model"]["vocab"].items() if at not in special}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in whole["model"]["merges"]]
        if [whole["model"]["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("the ids of the vocabulary are not its merge ranks")
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, at in ranks.items():
            self.a_bytes[at] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for at in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(at)
            if "\n" in piece or BLANK in piece.lstrip(BLANK):
                raise ValueError(f"piece {at} crosses the chunks of a text")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(at) else piece.replace(BLANK, " ").encode())
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.forget()

    def forget(self, spelling: bool = True) -> None:
        """Start anew; groups are spelled out only if asked for."""
        self.spelling = spelling
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.held = Kept(np.zeros((0, len(COUNTS)), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, bool))
        self.fresh: list[tuple[np.ndarray, ...]] = []
        pa.default_memory_pool().release_unused()

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """The number of each chunk; unknown ones are learned first."""
        fresh = list(set(chunks).difference(self.number))
        if fresh:
            self._learn(fresh)
        return np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))

    def _learn(self, fresh: list[str]) -> None:
        plain, single = [], []
        for chunk in fresh:
            whole = literal(chunk)
            (single if whole[1:2].isspace() or whole[-1:].isspace() or len(whole) < 2 else plain).append(chunk)
        blocks = [["."] + plain[a:b] for a, b in stretches(plain, BLOCK_CHARS)]
        texts = ["".join(map(literal, block)) for block in blocks]
        for block, text, b in zip(blocks, texts, self.b.encode([t[1:] for t in texts], num_threads=1)):
            a = self.a.encode_ordinary(text)
            if self._spells(text, a, b):
                self._keep(block, a, b)
            else:
                single.extend(block[1:])
        for chunk in single:
            whole = literal(chunk)
            a, b = self.a.encode_ordinary(whole), self.b.encode(whole[1:] if whole[0] == " " else whole)
            if whole[0] != " ":
                b = b[1:]  # the blank the tokenizer adds in front of a text
            if self._spells(whole, a, b):
                self._keep([chunk], a, b)
            else:
                self._add([chunk], [""], np.zeros((1, len(COUNTS)), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), False)

    def _spells(self, text: str, a: list[int], b: list[int]) -> bool:
        whole = text.encode()
        return b"".join([self.a_bytes[x] for x in a]) == whole and b"".join([self.b_bytes[x] for x in b]) == whole

    def _keep(self, chunks: list[str], a_ids: list[int], b_ids: list[int]) -> None:
        """Merge the ends of a run of chunks and keep each chunk's part."""
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum([len(literal(c).encode()) for c in chunks])
        at_a, at_b, closes = merge_paths(a_ends, b_ends)
        last = np.nonzero(closes)[0]  # the last link of each group
        group_ends = a_ends[at_a[last]]
        chunk_groups = np.searchsorted(group_ends, ends)
        if not np.array_equal(group_ends[chunk_groups], ends):
            raise ValueError("a token crosses the chunks of a text")
        group_stops = chunk_groups + 1
        stops = np.column_stack([at_a[last][chunk_groups] + 1, at_b[last][chunk_groups] + 1, group_stops, last[chunk_groups] + 1])
        counts = np.diff(stops, axis=0, prepend=0)
        texts = [""] * len(chunks)
        if self.spelling:
            spelled_a, spelled_b = list(map(str, a_ids)), list(map(str, b_ids))
            groups, i, j, start = [], 0, 0, 0
            for x, y in zip((at_a[last] + 1).tolist(), (at_b[last] + 1).tolist()):
                groups.append(",".join(spelled_a[i:x]) + "|" + ",".join(spelled_b[j:y]))
                i, j = x, y
            for at, stop in enumerate(group_stops.tolist()):
                texts[at] = ";".join(groups[start:stop])
                start = stop
        self._add(chunks, texts, counts, a[at_a] << PAIR_SHIFT | b[at_b], counts[:, 3], True)

    def _add(self, chunks, groups, counts, links, link_counts, fine) -> None:
        self.number.update(zip(chunks, range(len(self.groups), len(self.groups) + len(chunks))))
        self.groups.extend(groups)
        self.fresh.append((counts, links, link_counts, np.full(len(chunks), fine)))

    def known(self) -> Kept:
        """The arrays over all chunks by number."""
        if self.fresh:
            counts, links, link_counts, fine = (np.concatenate(x) for x in zip(*self.fresh))
            self.fresh = []
            held = self.held
            self.held = Kept(np.concatenate([held.counts, counts]), np.concatenate([held.links, links]),
                             np.concatenate([held.starts, held.starts[-1] + np.cumsum(link_counts)]), np.concatenate([held.fine, fine]))
        return self.held


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _numbered(both: Aligner, texts: list[str]) -> list[np.ndarray]:
    """The chunk numbers of each text; only a very long one is taken by itself, in stretches."""
    short = [chunks_of(" " + t) if t and len(t) <= STRETCH else [] for t in texts]
    flat = both.numbers(list(chain.from_iterable(short)))
    rows = np.split(flat, np.cumsum([len(x) for x in short])[:-1]) if texts else []
    for at, text in enumerate(texts):
        if len(text) > STRETCH:
            rows[at] = np.concatenate([both.numbers(chunks_of(part)) for part in stretches_of(text)])
    return rows


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    first = np.nonzero(np.diff(codes, prepend=-1))[0]
    return codes[first], np.add.reduceat(times, first) if len(first) else times


def _pair_batches(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        both.forget(spelling=False)
        uses = np.zeros(0, np.int64)

        def drained() -> pa.RecordBatch:
            held = both.known()
            times = np.zeros(len(held.fine), np.int64)
            times[:len(uses)] = uses
            used = np.repeat(times, np.diff(held.starts))
            codes, sums = _summed(held.links[used > 0], used[used > 0])
            both.forget(spelling=False)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], names=["pair", "times"])

        try:
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for a, b in stretches(texts, STRETCH):
                    rows = _numbered(both, texts[a:b])
                    fine = both.known().fine
                    spelled = np.concatenate([r for r in rows if fine[r].all()] or [np.zeros(0, np.int64)])
                    counts = np.bincount(spelled, minlength=len(fine))
                    counts[:len(uses)] += uses
                    uses = counts
                    if len(both.number) > KEPT_CHUNKS:
                        yield drained()
                        uses = np.zeros(0, np.int64)
            yield drained()
        finally:
            both.forget()

    return run


def pair_counts(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(pair, times, best): how many links of the corpus hold each (A id, B id); best marks the most frequent of a B id.

    ``pair`` is the A id times 2^32 plus the B id.  Both vocabularies bound the table.
    """
    counts = documents.select("text").mapInArrow(_pair_batches(a_path, b_path), "pair bigint, times bigint")
    counts = cut_lineage(counts.groupBy("pair").agg(F.sum("times").alias("times")))
    second = F.col("pair").bitwiseAND(F.lit((1 << PAIR_SHIFT) - 1))
    tops = counts.groupBy(second.alias("b")).agg(F.max("times").alias("top"))
    return salted_join(counts.withColumn("b", second), tops, ["b"]).select("pair", "times", (F.col("times") == F.col("top")).alias("best"))


class _Table:
    """The broadcast pairs, searched many at a time."""

    def __init__(self, pairs, times, best):
        order = np.argsort(pairs)
        self.pairs, self.times, self.best = pairs[order], times[order], best[order]

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and marks; pairs that only texts without tokens hold are not in the table, and their values are not used."""
        if not len(self.pairs):
            return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        return self.times[at], self.best[at]


def _document_batches(a_path: str, b_path: str, table, with_links: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        both.forget()
        values = np.zeros((0, 2), np.int64)  # links that are best, and the sum of their counts, per chunk

        def valued() -> np.ndarray:
            nonlocal values
            held = both.known()
            if len(values) < len(held.fine):
                start = held.starts[len(values)]
                times, best = table.value.find(held.links[start:])
                sums = np.zeros((len(held.links) - start + 1, 2), np.int64)
                np.cumsum(best, out=sums[1:, 0])
                np.cumsum(times, out=sums[1:, 1])
                values = np.concatenate([values, np.diff(sums[held.starts[len(values):] - start], axis=0)])
            return values

        def described(rows: np.ndarray, held: Kept) -> tuple[list[int], str, np.ndarray]:
            if not held.fine[rows].all():
                return [0] * (len(COUNTS) + 2), "", np.zeros(0, np.int64)
            looked_up = valued()[rows].sum(axis=0).tolist() if table is not None else [0, 0]
            links = [held.links[held.starts[r]:held.starts[r + 1]] for r in rows.tolist()] if with_links else []
            groups = ";".join(map(both.groups.__getitem__, rows.tolist()))
            return [*held.counts[rows].sum(axis=0).tolist(), *looked_up], groups, np.concatenate(links or [np.zeros(0, np.int64)])

        try:
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for a, b in stretches(texts, STRETCH):
                    rows = _numbered(both, texts[a:b])
                    held = both.known()
                    rows = [described(r, held) for r in rows]
                    columns = [batch.column("id").slice(a, b - a), *[pa.array(x, pa.int64()) for x in zip(*[r[0] for r in rows])], pa.array([r[1] for r in rows], pa.string())]
                    names = ["id", *COUNTS, "n_best", "count_sum", "groups"]
                    if with_links:
                        summed = [_summed(r[2], np.ones(len(r[2]), np.int64)) for r in rows]
                        pairs = [[{"pair": p, "times": t} for p, t in zip(x.tolist(), y.tolist())] for x, y in summed]
                        columns.append(pa.array(pairs, pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))))
                        names.append("links")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    if len(both.number) > KEPT_CHUNKS:
                        both.forget()
                        values = np.zeros((0, 2), np.int64)
        finally:
            both.forget()

    return run


def align(documents: DataFrame, a_path: str, b_path: str, key: str = "doc_id", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for every row.

    ``groups`` spells the alignment: ``a1,a2|b1;a3|b2`` in ids, one group between two common ends.
    """
    pairs = cut_lineage(pair_counts(documents, a_path, b_path))
    rows = documents.select(F.col(key).alias("id"), "text")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'{c} bigint' for c in (*COUNTS, 'n_best', 'count_sum'))}, groups string"
    if pairs.count() <= broadcast_pairs:
        table = pairs.toArrow()
        shared = documents.sparkSession.sparkContext.broadcast(_Table(*[table.column(c).to_numpy() for c in ("pair", "times", "best")]))
        return rows.mapInArrow(_document_batches(a_path, b_path, shared, False), schema)
    return _joined(rows.mapInArrow(_document_batches(a_path, b_path, None, True), schema + ", links array<struct<pair: bigint, times: bigint>>"), pairs)


def _joined(described: DataFrame, pairs: DataFrame) -> DataFrame:
    """The look-up as a join, for any number of pairs.  Rows of one id and equal groups have equal links, so they share one sum."""
    described = cut_lineage(described.withColumn("name", F.sha2("groups", 256)))
    each = described.dropDuplicates(["id", "name"]).select("id", "name", F.explode("links").alias("link")).select("id", "name", "link.*")
    counted = salted_join(each, pairs.select("pair", F.col("times").alias("uses"), "best"), ["pair"])
    sums = counted.groupBy(F.col("id").alias("other"), F.col("name").alias("other_name")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_sum"), F.sum(F.col("times") * F.col("uses")).alias("uses_sum"))
    whole = described.join(sums, F.col("id").eqNullSafe(F.col("other")) & (F.col("name") == F.col("other_name")), "left")
    return whole.select("id", *COUNTS, F.coalesce("best_sum", F.lit(0)).alias("n_best"), F.coalesce("uses_sum", F.lit(0)).alias("count_sum"), "groups")
