"""Sampled segmentations over the lattice of a piece vocabulary, and lossless decoding.

Every way to spell a text with pieces is a path through a lattice; a path weighs
the product of its pieces' weights.  The forward pass sums the weights of all
paths to each position, the backward pass draws a piece from the end towards the
start in proportion, so whole segmentations are drawn exactly in proportion to
their weight.  The vocabulary's scores are merge ranks, not probabilities, so a
piece of rank r weighs (r + 1) ** -``theta``.

No piece holds a line break, or a blank after another character, and few mix word
characters with punctuation, so the lattice falls apart at line breaks, before
each run of blanks and where words meet punctuation; the parts may be drawn one
by one.  The lattice of each distinct part is built once and kept; all
parts of many documents then walk backwards together, one array operation a step.

A draw depends on the seed, the row's key, the number of the part in its text
and the step alone, and is compared as an integer: batches, partitions and
retries change nothing.  A character no piece holds is spelled by its UTF-8 bytes,
and so is the blank sign of the vocabulary where it stands in a text, hence
decoding gives back every text exactly.

Defined cases: a null text encodes to null; an empty text to no pieces; a null
key is a key of its own; equal rows are segmented alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stretches
from .slots import SlotTable

BLANK = "▁"
THETA = 0.5
SEED = 20240229
KEPT_PARTS = 500_000
SHARE_BITS = 31
LETTERS_AT_ONCE = 1 << 16
_MODELS: dict[tuple[str, float], "Lattices"] = {}


class Vocabulary:
    def __init__(self, path: str, theta: float = THETA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        self.bytes_of: list[bytes] = [b""] * self.size
        self.byte_ids = np.full(256, -1, np.int64)
        self.number: dict[str, int] = {}
        self.weight: list[float] = [0.0] * self.size
        for i, piece in enumerate(pieces):
            self.weight[i] = float(i + 1) ** -theta
            if model.is_byte(i):
                self.weight[i] = float(self.size) ** -theta  # bytes only stand in for what no piece holds
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace(BLANK, " ")
                if "\n" in text or re.search("[^ ] ", text):
                    raise ValueError(f"piece {i} crosses the parts of a text")
                self.number[text] = i
                self.bytes_of[i] = text.encode()
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary must hold all 256 bytes")
        self.longest = max(map(len, self.number))
        # Word characters that stand beside punctuation in some piece: no text is cut next to them.
        beside = {c for t in self.number for a, b in zip(t, t[1:]) for c, d in ((a, b), (b, a))
                  if re.match(r"\w", c) and re.match(r"[^\w ]", d)} | {"_"}
        kept = re.escape("".join(sorted(beside)))
        self.part = re.compile(f"\n| *+[^\\W{kept}]++(?![{kept}])| *+[^\\w \n]++(?![{kept}])| *[^ \n]+| +")
        self.rarest = float(self.size) ** -theta
        self._grow_trie()

    def _grow_trie(self) -> None:
        """Pieces by their letters: ``steps`` finds (node, letter), ``ends`` tells the piece that ends at a step, or -1."""
        nodes: dict[tuple[int, str], int] = {}
        ends = []
        for text, number in self.number.items():
            node = 0
            for char in text:
                if (node, char) not in nodes:
                    nodes[node, char] = len(nodes) + 1
                    ends.append(-1)
                node = nodes[node, char]
            ends[node - 1] = number
        self.steps = SlotTable(np.array([node << 21 | ord(char) for node, char in nodes], np.int64))
        self.ends = np.array(ends, np.int32)

    def find(self, letters: np.ndarray) -> np.ndarray:
        """For rows of letters: the piece of ``size`` letters that ends before position ``end``, at [row, end, size - 1]; -1 if none."""
        rows, length = letters.shape
        found = np.full((rows, length + 1, self.longest), -1, np.int32)
        row, start = np.divmod(np.arange(rows * length), length)
        node = np.zeros(rows * length, np.int64)
        for size in range(1, min(self.longest, length) + 1):
            inside = start + size <= length
            row, start, node = row[inside], start[inside], node[inside]
            step = self.steps.find(node << 21 | letters[row, start + size - 1])
            alive = step >= 0
            row, start, node = row[alive], start[alive], step[alive].astype(np.int64) + 1
            found[row, start + size, size - 1] = self.ends[node - 1]
        return found

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()


class Lattices:
    """Backward choices of every distinct part, as flat arrays over (part, position)."""

    def __init__(self, path: str, theta: float = THETA):
        self.words = Vocabulary(path, theta)
        self.spelled: dict[str, int] = {}  # characters spelled by several bytes, numbered after the pieces
        self.spellings: list[list[int]] = []
        self.weights = list(self.words.weight)
        self._forget()

    def _forget(self) -> None:
        self.base: dict[str, int] = {}
        self.first = array("i")  # first choice of a position
        self.share = array("I")  # cumulated share of a choice among those of its position
        self.piece = array("i")
        self.back = array("b")  # characters a choice covers

    def _character(self, char: str) -> int:
        """The stand-in of a character that no piece holds."""
        data = char.encode()
        if len(data) == 1:
            return int(self.words.byte_ids[data[0]])
        if char not in self.spelled:
            self.spelled[char] = self.words.size + len(self.spelled)
            self.spellings.append([int(self.words.byte_ids[b]) for b in data])
            self.weights.append(self.words.rarest ** len(data))
        return self.spelled[char]

    def add_all(self, parts: list[str]) -> None:
        """Build the lattices of new parts, those of one length side by side."""
        by_length: dict[int, list[str]] = {}
        for part in parts:
            by_length.setdefault(len(part), []).append(part)
        for length, same in by_length.items():
            rows = max(1, LETTERS_AT_ONCE // length)
            for at in range(0, len(same), rows):
                self._add(same[at:at + rows], length)

    def _add(self, parts: list[str], length: int) -> None:
        longest = self.words.longest
        letters = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").reshape(-1, length).astype(np.int64)
        found = self.words.find(letters)
        alone = found[:, 1:, 0]
        for letter in np.unique(letters[alone < 0]):
            alone[(letters == letter) & (alone < 0)] = self._character(chr(letter))
        # Choices stand with the longest piece first, which is mostly the likeliest.
        found = found[:, :, ::-1]
        weight = np.where(found >= 0, np.array(self.weights)[found], 0.0)
        share = np.zeros(found.shape, np.int64)
        total = np.zeros((len(parts), longest + length))  # the sums to positions 0.. stand from column ``longest`` - 1 on
        total[:, longest - 1] = 1.0
        for at in range(1, length + 1):
            window = total[:, at - 1:at - 1 + longest]
            sums = np.cumsum(window * weight[:, at], axis=1)
            whole = sums[:, -1:]
            share[:, at] = sums / whole * (1 << SHARE_BITS)
            total[:, at - 1 + longest] = whole[:, 0]
            low = whole[:, 0] < 1e-200  # only ratios count: lift the sums that are still in reach
            if low.any():
                total[low, at:at + longest] *= 1e200
        there = found >= 0
        count = there.sum(axis=2).ravel()
        base = len(self.first)
        first = len(self.share) + np.cumsum(count) - count
        self.base.update(zip(parts, range(base, base + (length + 1) * len(parts), length + 1)))
        self.first.frombytes(first.astype(np.int32).tobytes())
        self.share.frombytes(share[there].astype(np.uint32).tobytes())
        self.piece.frombytes(found[there].astype(np.int32).tobytes())
        self.back.frombytes(np.broadcast_to(np.arange(longest, 0, -1, dtype=np.int8), found.shape)[there].tobytes())

    def sample(self, texts: list[str], seeds: list[int]) -> list[np.ndarray]:
        """Piece ids of each text; ``seeds`` are 64-bit numbers, one for each text."""
        split = [self.words.part.findall(t) for t in texts]
        if len(self.base) > KEPT_PARTS:
            self._forget()
        fresh = set().union(*split).difference(self.base)
        if fresh:
            self.add_all(list(fresh))
        base = self.base
        starts: list[int] = []
        sizes: list[int] = []
        for parts in split:
            starts += map(base.__getitem__, parts)
            sizes += map(len, parts)
        counts = np.array([len(p) for p in split], np.int64)
        of = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        key = _mixed(np.array(seeds, np.uint64)[of] + _mixed(within.astype(np.uint64)))
        first, share, piece, back = (np.frombuffer(a, a.typecode) for a in (self.first, self.share, self.piece, self.back))
        low = np.array(starts, np.int64)
        state = low + np.array(sizes, np.int64)
        alive = np.arange(len(of))
        steps = np.zeros(len(of), np.int64)
        taken = []
        while len(alive):
            u = (_mixed(key[alive] + steps[alive].astype(np.uint64)) >> np.uint64(64 - SHARE_BITS)).astype(np.int64)
            choice = first[state[alive]].astype(np.int64)
            late = np.nonzero(share[choice] <= u)[0]
            while len(late):
                choice[late] += 1
                late = late[share[choice[late]] <= u[late]]
            taken.append((alive, piece[choice]))
            state[alive] -= back[choice]
            steps[alive] += 1
            alive = alive[state[alive] > low[alive]]
        ends = np.cumsum(steps)
        ids = np.empty(ends[-1] if len(ends) else 0, np.int64)
        for step, (rows, found) in enumerate(taken):
            ids[ends[rows] - 1 - step] = found
        edges = np.r_[0, ends][np.r_[0, np.cumsum(counts)]]
        out = [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]
        size = self.words.size
        if len(ids) and ids.max() >= size:
            out = [np.array([j for i in row.tolist() for j in ((i,) if i < size else self.spellings[i - size])], np.int64)
                   if len(row) and row.max() >= size else row for row in out]
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 step: a fixed mixing of 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lattices(path: str, theta: float = THETA) -> Lattices:
    if (path, theta) not in _MODELS:
        _MODELS[path, theta] = Lattices(path, theta)
    return _MODELS[path, theta]


def row_seed(key, seed: int = SEED) -> int:
    return xxhash.xxh64_intdigest(str(key), seed)


def _sample_batches(path: str, theta: float, seed: int, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattices(path, theta)
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("id").to_pylist()
            for a, b in stretches([t or "" for t in texts]):
                found = model.sample([t or "" for t in texts[a:b]], [row_seed(k, seed) for k in keys[a:b]])
                ids = batch.column("id").slice(a, b - a)
                if not digests:
                    yield pa.RecordBatch.from_arrays([ids, pa.array(
                        [None if t is None else f.astype(np.int32) for t, f in zip(texts[a:b], found)], pa.list_(pa.int32()))], names=["id", "ids"])
                    continue
                decoded = [model.words.decode(f.tolist()) for f in found]
                same = [d == (t or "") for d, t in zip(decoded, texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(f) for f in found], pa.int64()), pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in found], pa.int64()),
                     pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]), pa.array(same)],
                    names=["id", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"])

    return run


def encode(documents: DataFrame, path: str, key: str = "doc_id", theta: float = THETA, seed: int = SEED) -> DataFrame:
    """(id, ids): a sampled segmentation of each text, reproducible from the key."""
    rows = documents.select(F.col(key).alias("id"), "text")
    return rows.mapInArrow(_sample_batches(path, theta, seed, False), f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, text) from (id, ids); null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = lattices(path).words
        for batch in batches:
            texts = [None if i is None else words.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return encoded.select("id", "ids").mapInArrow(run, f"id {encoded.schema['id'].dataType.simpleString()}, text string")


def digests(documents: DataFrame, path: str, key: str = "doc_id", theta: float = THETA, seed: int = SEED) -> DataFrame:
    """(id, n_pieces, ids_crc32, decoded_sha256, lossless): what ``encode`` and ``decode`` give, digested in one pass."""
    rows = documents.select(F.col(key).alias("id"), "text")
    return rows.mapInArrow(_sample_batches(path, theta, seed, True), f"id {rows.schema['id'].dataType.simpleString()}, "
                           "n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, lossless boolean")
