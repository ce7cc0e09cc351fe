"""Frequent phrases and how strongly their words hold together, by Rabin-Karp fingerprints.

Texts of a batch lie end to end in one byte array.  Prefix sums of a polynomial
over the bytes give the hash of every word by one subtraction; prefix sums of a
second polynomial over the words' hashes give that of every run of words.  All of
it is array arithmetic modulo 2^64.

Phrases grow level by level.  A level counts fingerprints of the runs whose two
shorter runs may be frequent, which is told by a bitmap of the fingerprints that
the level below counted often enough.  Different runs that share a fingerprint or
a bit only make it count more, so nothing frequent is lost.  A bitmap has sixteen
bits for each frequent run, up to ``MAX_FILTER_BITS`` (32 MB, which bounds the
broadcast); a fuller one lets more rare runs into the shuffle and changes no result.

Counting shuffles pairs of fingerprint and count.  A last pass over the texts then
verifies: within a task every occurrence is held against the first one of its
fingerprint, words byte by byte and runs word by word, and each phrase comes out
once per task, as text, with its count and a pointer to an occurrence (the id of a row).
Counts of equal texts are added up, hence colliding fingerprints come apart.
Only runs that the bitmaps call frequent are ever made into text.

Scores compare a phrase with its parts, see `collocations`.

Defined cases: null and empty texts have no words; a null language is ``und``; null
ids, repeated rows and extra columns do no harm (repeated rows count each); a very
long text is cut at the next blank or break after ``STRETCH`` bytes, and where that
divides a piece the last words are carried over; one unbroken word is held whole;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import salted_join, scattered

LONGEST = 4
LEAST = 30
KEPT_PER_LANGUAGE = 2000
COVERED_PERCENT = 80
SCALE = 2_000_000
STRETCH = 1 << 20
BITS_PER_RUN = 16
MAX_FILTER_BITS = 1 << 28
BLOCK_BITS = 15
KEPT_RUNS, ROWS_AT_ONCE = 1 << 20, 1 << 16  # runs a task counts before it passes them on
UNKNOWN = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END = re.compile(b"[ \t.,;:!?\n-\r]")
BREAK = re.compile(b"[.,;:!?\n-\r]")
_KIND = np.array([2 if c in BREAKS else 1 if c in BLANKS else 0 for c in range(256)], np.uint8)
_VALUE = np.random.default_rng(12).integers(1, 1 << 63, 256, np.uint64)
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, so they have inverses modulo 2^64
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2^64; kept and extended as needed."""
    held = _POWERS.get(base)
    if held is None or len(held) < count:
        held = np.full(max(count, STRETCH + 1), base, np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if count <= 2 * STRETCH:
            _POWERS[base] = held
    return held[:count]


def windows(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial over values[start:end] for many windows, from prefix sums of the polynomial over all of them."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * powers(pow(base, -1, 1 << 64), len(values) + 1)[starts]


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ hashes >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ hashes >> np.uint64(29)


class Runs:
    """The words of several texts and the fingerprints of all runs of words."""

    def __init__(self, parts: list[tuple[bytes, int, int]], languages: np.ndarray):
        """``parts``: (bytes, number of the language, how many words at its beginning were counted before)."""
        joined = b"\n".join([p[0] for p in parts])
        self.data = np.frombuffer(joined, np.uint8)
        kind = _KIND[self.data]
        edges = np.flatnonzero(np.diff(kind == 0, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.offsets = np.concatenate([[0], np.cumsum([len(p[0]) + 1 for p in parts])])[:len(parts)]
        self.part = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.language = np.array([p[1] for p in parts], np.int64)[self.part]
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.starts)
        self.counted = np.ones(len(self.starts), bool)
        first_word = np.searchsorted(self.starts, self.offsets)
        for at, (_, _, skip) in enumerate(parts):
            self.counted[first_word[at]:first_word[at] + skip] = False
        hashes = windows(_VALUE[self.data], BYTE_BASE, self.starts, self.ends)
        self.words = mixed(hashes ^ languages[self.language])

    def fingerprints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint of each run of n words, does it lie in one piece and end in a word not counted before)."""
        count = len(self.words) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        start = np.arange(count)
        prints = self.words if n == 1 else mixed(windows(self.words, WORD_BASE, start, start + n) + np.uint64(n))
        return prints, (self.piece[:count] == self.piece[n - 1:]) & self.counted[n - 1:]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def cut_long(text: bytes, size: int = STRETCH) -> Iterator[tuple[bytes, int]]:
    """(bytes, words carried over) in stretches of about ``size`` bytes."""
    start, carried = 0, b""
    while True:
        found = END.search(text, start + size) if len(text) - start > size else None
        stop = found.start() if found else len(text)
        part = text[start:stop]
        words = carried.split(b" ") if carried else []
        yield (carried + b" " + part if words else part), len(words)
        if not found:
            return
        # A piece that goes on takes its last words along, so that no run is lost between stretches.
        tail = BREAK.split(carried + b" " + part)[-1].replace(b"\t", b" ") if _KIND[text[stop]] == 1 else b""
        carried = b" ".join([w for w in tail.split(b" ") if w][-(LONGEST - 1):])
        start = stop


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Runs, list[str], list]]:
    """(runs, language names, row id of each part) for about ``STRETCH`` bytes of text at a time."""
    parts, places, held, number = [], [], 0, {}

    def made() -> tuple[Runs, list[str], list]:
        hashes = np.array([xxhash.xxh64_intdigest(name) for name in number], np.uint64)
        return Runs(parts, hashes), list(number), places

    for batch in batches:
        ids = batch.column("id") if "id" in batch.schema.names else [None] * batch.num_rows
        for key, language, text in zip(ids, batch.column("lang").to_pylist(), batch.column("text")):
            text = text.as_py()
            if not text:
                continue
            for part, carried in cut_long(text.encode().translate(LOWER)):
                parts.append((part, number.setdefault(UNKNOWN if language is None else language, len(number)), carried))
                places.append(key)
                held += len(part)
                if held >= STRETCH:
                    yield made()
                    parts, places, held, number = [], [], 0, {}
    if parts:
        yield made()


def _may_be_frequent(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slot = prints & np.uint64(8 * len(bits) - 1)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _admitted(runs: Runs, n: int, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints of runs of n words, which of them to count): both runs of n - 1 words inside must be in ``bits``."""
    prints, valid = runs.fingerprints(n)
    if n > 1 and len(prints):
        shorter = _may_be_frequent(bits, runs.fingerprints(n - 1)[0])
        valid &= shorter[:-1] & shorter[1:]
    return prints, valid


def _count_batches(n: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else shared.value
        for runs, _, _ in _buffers(batches):
            prints, valid = _admitted(runs, n, bits)
            found, times = np.unique(prints[valid], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], names=["print", "times"])

    return run


def frequent_bits(counted: DataFrame, least: int, max_bits: int = MAX_FILTER_BITS) -> np.ndarray:
    """The bitmap of the fingerprints that occur ``least`` times or more."""
    often = cut_lineage(counted.groupBy("print").agg(F.sum("times").alias("times")).where(F.col("times") >= least).select("print"))
    size = min(max_bits, max(1 << BLOCK_BITS, 1 << (BITS_PER_RUN * often.count()).bit_length()))
    slot = F.col("print").bitwiseAND(F.lit(size - 1))
    low = (1 << BLOCK_BITS) - 1
    blocks = often.select(F.shiftright(slot, BLOCK_BITS).alias("block"), slot.bitwiseAND(F.lit(low)).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bitmap"))
    bits = np.zeros(size // 8, np.uint8)
    for row in blocks.toLocalIterator():
        start = row["block"] << (BLOCK_BITS - 3)
        bits[start:start + len(row["bitmap"])] = np.frombuffer(bytes(row["bitmap"]), np.uint8)
    return bits


class Seen:
    """The words and runs of a task, each once: exact numbers, counts and where they were first seen.

    A fingerprint points to the word or run it was first seen with.  Every later
    one is held against it, words byte by byte and runs word by word; those that
    differ though their fingerprint is the same get numbers by their contents.
    """

    def __init__(self):
        self.blob = bytearray()
        self.word_at = np.zeros((0, 3), np.int64)  # start and size in ``blob``, number of the language
        self.languages: dict[str, int] = {}
        self.known = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(LONGEST + 1)]  # fingerprints in order, their numbers; 0: words
        self.odd: list[dict] = [{} for _ in range(LONGEST + 1)]
        self.runs = [np.zeros((0, n), np.int64) for n in range(LONGEST + 1)]
        self.times = [np.zeros(0, np.int64) for _ in range(LONGEST + 1)]
        self.examples: list[list] = [[] for _ in range(LONGEST + 1)]
        self.totals: dict[str, int] = {}

    def _numbers(self, level: int, prints: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of each fingerprint, position of the first occurrence of each new one); new ones are numbered from ``count`` on."""
        held, numbers = self.known[level]
        found, first, inverse = np.unique(prints, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(held, found), max(0, len(held) - 1))
        old = held[at] == found if len(held) else np.zeros(len(found), bool)
        own = np.empty(len(found), np.int64)
        own[old] = numbers[at[old]]
        own[~old] = count + np.arange(int((~old).sum()))
        if not old.all():
            merged = np.concatenate([held, found[~old]])
            order = np.argsort(merged, kind="stable")
            self.known[level] = merged[order], np.concatenate([numbers, own[~old]])[order]
        return own[inverse], first[~old]

    def _add_words(self, runs: Runs, at: np.ndarray, names: np.ndarray) -> None:
        rows = []
        for i in at.tolist():
            word = runs.word(i)
            rows.append((len(self.blob), len(word), int(names[runs.language[i]])))
            self.blob += word
        self.word_at = np.concatenate([self.word_at, np.array(rows, np.int64).reshape(-1, 3)])

    def words_of(self, runs: Runs, at: np.ndarray, names: np.ndarray) -> np.ndarray:
        """The exact number of each word ``at``."""
        numbers, fresh = self._numbers(0, runs.words[at], len(self.word_at))
        self._add_words(runs, at[fresh], names)
        start, size, language = self.word_at[numbers].T
        sizes = runs.ends[at] - runs.starts[at]
        same = (size == sizes) & (language == names[runs.language[at]])
        if not same.all():
            sizes = np.where(same, sizes, 0)
        total = int(sizes.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        blob = np.frombuffer(bytes(self.blob), np.uint8)
        differ = runs.data[np.repeat(runs.starts[at], sizes) + inside] != blob[np.repeat(start, sizes) + inside]
        if differ.any():
            same[np.repeat(np.arange(len(at)), sizes)[differ]] = False
        for i in np.flatnonzero(~same).tolist():
            word = (runs.word(int(at[i])), int(names[runs.language[at[i]]]))
            if word not in self.odd[0]:
                self.odd[0][word] = len(self.word_at)
                self._add_words(runs, at[i:i + 1], names)
            numbers[i] = self.odd[0][word]
        return numbers

    def count_runs(self, n: int, prints: np.ndarray, words: np.ndarray, example) -> None:
        """Count runs of ``n`` words with their fingerprints; ``words`` has the number of each word, ``example`` names the place of the k-th run."""
        numbers, fresh = self._numbers(n, prints, len(self.runs[n]))
        self.runs[n] = np.concatenate([self.runs[n], words[fresh]])
        self.examples[n].extend(example(fresh))
        for i in np.flatnonzero((self.runs[n][numbers] != words).any(axis=1)).tolist():
            run = tuple(words[i].tolist())
            if run not in self.odd[n]:
                self.odd[n][run] = len(self.runs[n])
                self.runs[n] = np.concatenate([self.runs[n], words[i:i + 1]])
                self.examples[n].extend(example(np.array([i])))
            numbers[i] = self.odd[n][run]
        counts = np.bincount(numbers, minlength=len(self.runs[n]))
        counts[:len(self.times[n])] += self.times[n]
        self.times[n] = counts

    def count(self, buffer: Runs, languages: list[str], places: list, bits: list[np.ndarray]) -> None:
        names = np.array([self.languages.setdefault(x, len(self.languages)) for x in languages], np.int64)
        for name, times in zip(languages, np.bincount(buffer.language[buffer.counted], minlength=len(languages)).tolist()):
            self.totals[name] = self.totals.get(name, 0) + times
        wanted = np.flatnonzero(_may_be_frequent(bits[0], buffer.words))
        exact = np.full(len(buffer.words), -1, np.int64)
        exact[wanted] = self.words_of(buffer, wanted, names)
        for n in range(1, LONGEST + 1):
            prints, valid = _admitted(buffer, n, bits[n - 2])
            at = np.flatnonzero(valid & _may_be_frequent(bits[n - 1], prints)) if len(prints) else np.zeros(0, np.int64)
            words = np.column_stack([exact[at + k] for k in range(n)])
            self.count_runs(n, prints[at], words, lambda rows, at=at: [places[p] for p in buffer.part[at[rows]].tolist()])

    def rows(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """(lang, n, phrase, times, example); runs of no words hold the words of a language."""
        spelled = [bytes(self.blob[s:s + size]).decode() for s, size in self.word_at[:, :2].tolist()]
        names = list(self.languages)
        columns = [list(self.totals), [0] * len(self.totals), [""] * len(self.totals), list(self.totals.values()), [None] * len(self.totals)]
        for n in range(1, LONGEST + 1):
            columns[0] += [names[x] for x in self.word_at[self.runs[n][:, 0], 2].tolist()]
            columns[1] += [n] * len(self.runs[n])
            columns[2] += [" ".join([spelled[w] for w in run]) for run in self.runs[n].tolist()]
            columns[3] += self.times[n].tolist()
            columns[4] += self.examples[n]
        types = (pa.string(), pa.int32(), pa.string(), pa.int64(), kind)
        for start in range(0, len(columns[0]), ROWS_AT_ONCE):
            yield pa.RecordBatch.from_arrays([pa.array(c[start:start + ROWS_AT_ONCE], t) for c, t in zip(columns, types)], names=["lang", "n", "phrase", "times", "example"])


def _phrase_batches(filters: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [f.value for f in filters]
        seen, kind = Seen(), pa.null()
        for runs, languages, places in _buffers(batches):
            kind = next((p.type for p in places if p is not None), kind)
            seen.count(runs, languages, [p.as_py() for p in places], bits)
            if sum(map(len, seen.times)) > KEPT_RUNS:
                yield from seen.rows(kind)
                seen = Seen()
        if seen.totals:
            yield from seen.rows(kind)

    return run


def frequent_phrases(documents: DataFrame, least: int = LEAST, key: str = "doc_id") -> DataFrame:
    """(lang, n, phrase, times, example): every run of one to four words found ``least`` times or more.

    ``example`` is the id of a row that holds it.  Rows of n = 0 hold the number of words of a language.
    """
    rows = documents.select(F.col(key).alias("id"), F.col("lang").cast("string").alias("lang"), "text")
    context = documents.sparkSession.sparkContext
    filters: list = []
    for n in range(1, LONGEST + 1):
        counted = rows.select("lang", "text").mapInArrow(_count_batches(n, filters[-1] if filters else None), "print bigint, times bigint")
        filters.append(context.broadcast(frequent_bits(counted, least)))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_phrase_batches(filters), f"lang string, n int, phrase string, times bigint, example {kind}")
    summed = found.groupBy("lang", "n", "phrase").agg(F.sum("times").alias("times"), F.min("example").alias("example"))
    return summed.where((F.col("times") >= least) | (F.col("n") == 0))


def collocations(phrases: DataFrame, kept: int = KEPT_PER_LANGUAGE) -> DataFrame:
    """The best phrases of two to four words per language: (lang, rank, phrase, a, l, r, n, score, example).

    A phrase of count a, cut into two parts of counts l and r, scores
    floor(2,000,000 a / (l + r)); its lowest-scoring cut counts, of equal ones the
    earliest.  A phrase is left out if a longer one that holds it is found at least
    80 percent as often.  Products are decimals, so nothing overflows.
    """
    phrases = cut_lineage(phrases)
    totals = phrases.where("n = 0").select("lang", F.col("times").alias("total"))
    grams = phrases.where("n > 0").select("lang", F.col("n").alias("words"), "phrase", "times", "example")
    counts = grams.select("lang", F.col("phrase").alias("part"), F.col("times").alias("part_times"))
    candidates = grams.where("words > 1")

    longer = grams.where("words > 2").withColumn("word", F.split("phrase", " ")).select("lang", "words", "word", "times", F.explode(
        F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), s -> struct(s, m))))")).alias("cut"))
    inside = longer.select("lang", F.expr("array_join(slice(word, cut.s, cut.m), ' ')").alias("phrase"), "times").groupBy("lang", "phrase").agg(
        F.max("times").alias("longest"))
    kept_rows = candidates.join(inside, ["lang", "phrase"], "left").where(
        f"longest IS NULL OR cast(longest as decimal(20,0)) * 100 < cast(times as decimal(20,0)) * {COVERED_PERCENT}").drop("longest")

    cuts = kept_rows.select("lang", "phrase", "times", "words", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    sides = [("l", "substring_index(phrase, ' ', k)"), ("r", "substring_index(phrase, ' ', k - words)")]
    for side, part in sides:
        cuts = salted_join(cuts.withColumn("part", F.expr(part)), counts, ["lang", "part"]).drop("part").withColumnRenamed("part_times", side)
    score = F.expr(f"(cast(times as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = kept_rows.join(lowest, ["lang", "phrase"]).select("lang", "phrase", F.col("times").alias("a"), "cut.l", "cut.r", "cut.score", "example")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First among a share of a language's phrases, then among what is left of all shares.
    share = Window.partitionBy("lang", "share").orderBy(*order)
    best = scored.withColumn("share", scattered("phrase", parts=64)).withColumn("place", F.row_number().over(share)).where(F.col("place") <= kept)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= kept)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score", "example")
