"""Quality rules as gradient-boosted trees over document statistics.

Statistics are counts over whole texts; a base rule rejects texts that are too
short or repeat themselves.  The rest is decided by boosted trees of logistic
loss, grown on histograms of a bounded labelled sample (``MAX_EXAMPLES`` rows with
the smallest hash of their id) and flattened into arrays of nodes, so a batch of
documents walks all trees with array operations.  More symbols, repeated lines
or repeated words never raise a score: splits on those statistics are admitted
only in that direction and bound the values of all nodes below them.

The cut is the lower of one half and the score that all but ``LOST`` of the clean
examples reach, so that clean documents stay.  It comes from scores of examples by
trees that have not seen them (``FOLDS`` parts by a hash of the id), as an
interpolated quantile.

Defined cases: of several labelled texts that share an id the one with the smallest
hash is learned from, so partitioning does not matter; a null text has no words and fails the base rule, like an empty
one; a null id is kept as it is; repeated rows each give a row; without labels of
both kinds the trees reject nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
MAX_EXAMPLES = 20_000
LOST = 0.002
FOLDS = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistics the trees see, and the direction in which each may move the score (0: either).
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "repeated_line_share": -1, "repeated_word_share": -1, "upper_share": 0,
    "digit_share": 0, "mark_share": 0, "distinct_share": 0, "words_per_line": 0, "finished_lines": 0,
}


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found at least twice in the text."""
    if len(words) <= window:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    count = len(words) - window + 1
    mixed = np.zeros(count, np.uint64)
    for at in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[at:at + count]
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    twice = np.isin(mixed, ordered[1:][ordered[1:] == ordered[:-1]])
    # Equal sums are only candidates; the windows themselves decide.
    places = np.nonzero(twice)[0].tolist()
    seen = Counter(tuple(words[i:i + window]) for i in places)
    starts = np.zeros(len(words) + 1, np.int64)
    for i in places:
        if seen[tuple(words[i:i + window])] > 1:
            starts[i] += 1
            starts[i + window] -= 1
    return int((np.cumsum(starts)[:len(words)] > 0).sum())


def repeated_lines(lines: list[str]) -> int:
    """Lines with a word that equal an earlier line."""
    full = [line for line in lines if WORD.search(line)]
    return len(full) - len(set(full))


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(the counts of ``COUNTS``, the values of ``FEATURES``) of one text."""
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    again = repeated_lines(lines)
    repeats = repeated_words(words)
    n, size, height = max(1, len(words)), max(1, chars), max(1, len(lines))
    upper = len(UPPER.findall(text))
    digits = len(DIGIT.findall(text))
    finished = sum(line.endswith((".", "!", "?")) for line in lines)
    features = [
        float(np.log1p(len(words))), chars / n, symbols / size, again / height, repeats / n, upper / size, digits / size,
        (text.count("!") + text.count("?")) / n, len(set(words)) / n, len(words) / height, finished / height]
    return [len(words), chars, symbols, again, repeats], features


UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")
DIGIT = re.compile("[0-9]")


def failed_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


@dataclass
class Trees:
    """All trees side by side: node arrays of one row per tree, children by position in the row."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    least: float = 0.0

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of being clean for each row of ``features``."""
        total = np.full(len(features), self.start)
        rows = np.arange(len(features))
        for tree in range(len(self.feature)):
            node = np.zeros(len(features), np.int64)
            for _ in range(self.depth):
                low = features[rows, self.feature[tree, node]] <= self.cut[tree, node]
                node = np.where(low, self.left[tree, node], self.right[tree, node])
            total += self.value[tree, node]
        return 1 / (1 + np.exp(-total))


def grow(features: np.ndarray, clean: np.ndarray, directions: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2,
         bins: int = 64, least_weight: float = 1.0, ridge: float = 1.0) -> Trees:
    """Boosted trees on binned features; deterministic for a given order of rows."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in features.T]
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, features.T)])
    share = np.clip(clean.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(features), start)
    nodes = 2 ** (depth + 1) - 1
    model = Trees(start, *[np.zeros((trees, nodes), kind) for kind in (np.int64, np.float64, np.int64, np.int64, np.float64)], depth)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, weight = clean - chance, chance * (1 - chance)
        # (node, rows, lowest and highest value allowed, levels left); node n has children 2n + 1 and 2n + 2.
        open_nodes = [(0, np.arange(len(features)), -np.inf, np.inf, depth)]
        while open_nodes:
            node, rows, low, high, levels = open_nodes.pop()
            g, h = slope[rows].sum(), weight[rows].sum()
            value = float(np.clip(g / (h + ridge), low, high))
            found = None
            for at in range(features.shape[1] if levels else 0):
                if not len(edges[at]):
                    continue
                size = len(edges[at]) + 1
                gl = np.cumsum(np.bincount(binned[rows, at], slope[rows], size))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, at], weight[rows], size))[:-1]
                vl, vr = np.clip(gl / (hl + ridge), low, high), np.clip((g - gl) / (h - hl + ridge), low, high)
                gain = 2 * gl * vl - (hl + ridge) * vl * vl + 2 * (g - gl) * vr - (h - hl + ridge) * vr * vr
                fair = (hl >= least_weight) & (h - hl >= least_weight) & (directions[at] * (vr - vl) >= 0)
                gain = np.where(fair, gain, -np.inf) - (2 * g * value - (h + ridge) * value * value)
                best = int(np.argmax(gain))
                if gain[best] > 1e-9 and (found is None or gain[best] > found[0]):
                    found = (gain[best], at, best, float(vl[best]), float(vr[best]))
            model.left[tree, node] = model.right[tree, node] = node
            model.cut[tree, node] = np.inf
            if found is None:
                model.value[tree, node] = rate * value
                continue
            _, at, cut, vl, vr = found
            model.feature[tree, node], model.cut[tree, node] = at, edges[at][cut]
            model.left[tree, node], model.right[tree, node] = 2 * node + 1, 2 * node + 2
            middle = (vl + vr) / 2
            below = binned[rows, at] <= cut
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[directions[at]]
            open_nodes.append((2 * node + 1, rows[below], *bounds[0], levels - 1))
            open_nodes.append((2 * node + 2, rows[~below], *bounds[1], levels - 1))
        single = Trees(0.0, *[a[tree:tree + 1] for a in (model.feature, model.cut, model.left, model.right, model.value)], depth)
        chance = single.score(features)
        total += np.log(chance) - np.log1p(-chance)
    return model


def examples(labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """(example, quality): a bounded sample; an id labelled more than once counts as clean only if always so."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("example")).agg(
        F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64("example"), "example").limit(limit)


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [statistics(t.as_py())[1] for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("example"), batch.column("quality"), batch.column("named"), pa.array(values, pa.list_(pa.float64()))],
            names=["example", "quality", "named", "values"])


def fit(documents: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> Trees | None:
    """Trees from the labelled sample, which is broadcast and collected because its size is bounded."""
    sample = cut_lineage(examples(labels, limit))
    known = documents.select(F.col("doc_id").alias("example"), "text").join(F.broadcast(sample), "example")
    kind = sample.schema["example"].dataType.simpleString()
    rows = known.select("example", "quality", "text", F.xxhash64("text").alias("named")).mapInArrow(
        _sample_batches, f"example {kind}, quality int, named bigint, values array<double>")
    # Equal texts have equal values, so the order is complete.
    rows = rows.groupBy("example").agg(F.min(F.struct("named", "quality", "values")).alias("row")).select("example", "row.quality", "row.values")
    rows = sorted(tuple(r) for r in rows.collect())
    clean = np.array([r[1] for r in rows], np.float64)
    if not rows or clean.min() == clean.max():
        return None
    features = np.array([r[2] for r in rows])
    trees = grow(features, clean, list(FEATURES.values()))
    fold = np.array([zlib.crc32(str(r[0]).encode()) % FOLDS for r in rows])
    unseen = np.full(len(rows), np.nan)
    for part in range(FOLDS):
        rest = fold != part
        if 0 < clean[rest].sum() < rest.sum():
            unseen[~rest] = grow(features[rest], clean[rest], list(FEATURES.values())).score(features[~rest])
    reached = unseen[(clean == 1) & np.isfinite(unseen)]
    trees.least = float(min(0.5, np.quantile(reached, LOST))) if len(reached) else 0.0
    return trees


def _verdicts(texts, trees: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(counts, failed base rule, score, kept) for a batch of texts."""
    both = [statistics(t.as_py()) for t in texts]
    counts = np.array([c for c, _ in both], np.int64).reshape(-1, len(COUNTS))
    failed = np.array([failed_base(c[0], c[4]) for c, _ in both], bool)
    features = np.array([f for _, f in both], np.float64).reshape(-1, len(FEATURES))
    scores = trees.score(features) if trees is not None else np.ones(len(both))
    return counts, failed, scores, ~failed & (scores >= (trees.least if trees is not None else 0.0))


def judge(documents: DataFrame, trees: Trees | None, key: str = "doc_id") -> DataFrame:
    """(id, counts, base_failed, score, kept) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, scores, kept = _verdicts(batch.column("text"), trees)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c) for c in np.ascontiguousarray(counts.T)], pa.array(failed), pa.array(scores), pa.array(kept)],
                names=["id", *COUNTS, "base_failed", "score", "kept"])

    rows = documents.select(F.col(key).alias("id"), "text")
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {counts}, base_failed boolean, score double, kept boolean")


def kept_rows(documents: DataFrame, trees: Trees | None) -> DataFrame:
    """The rows of ``documents`` that stay, whole; nothing shuffles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = _verdicts(batch.column(batch.schema.names.index("text")), trees)[3]
            yield batch.filter(pa.array(kept))

    return documents.mapInArrow(run, documents.schema)
