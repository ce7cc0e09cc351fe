"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, with the examples as evidence.

Terms are lower-cased words of letters, the first letters of longer words, and
either of them found at least two, three or five times.  The vocabulary holds
the terms whose presence goes with the label: Dunning's G-squared of at least 2 ln T, T being the number of terms in
``MIN_ROWS`` or more examples, which lets about one term pass by chance, and odds
of the label at least ``MIN_ODDS`` times higher or lower with the term, which
leaves out what merely marks a language; ``MAX_TERMS`` at most, strongest first.  Document frequencies are counted over all documents.

Examples are a bounded sample: of the labelled rows that may be learnt from, the
``MAX_EXAMPLES`` with the smallest hash of their id.  Their postings lie in an
inverted index cut into blocks of ``BLOCK`` examples, each with the largest
weight per term and block.  A query adds up these maxima into a bound for each
block, visits blocks from the highest bound down and stops when no bound reaches
the k-th best cosine: the k nearest are exact.  Votes are weighted by cosine and
turned into probabilities by a monotone fit to leave-one-out votes.

Labels, language, source and ids never enter a score.  Defined cases: null and
empty texts and texts without any term of the vocabulary get the share of toxic
examples without terms; ties between neighbours go to the smaller example
number (examples are ordered by id); a null id is not held out; without labels
of both kinds every score is the share of toxic examples (0 without any); an
empty table gives an empty result.  Rows of ``labels`` that repeat an id count as
toxic if any of them is; null labels are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 7)
LEVELS = (1, 2, 3, 5)
MAX_EXAMPLES = 20_000
MAX_TERMS = 4096
MIN_ROWS = 3
MIN_ODDS = 3.0
NEIGHBOURS = 15
BLOCK = 64
CUT = 0.7
FLUSH = 200_000
REMEMBERED = 10_000


def held_out(key: str | Column) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _counted(text: str | None) -> Counter:
    """How often each word and each prefix, marked by a star, occurs."""
    words = Counter(WORD.findall((text or "").lower()))
    counts = Counter(words)
    for word, n in words.items():
        for size in PREFIXES:
            if len(word) > size:
                counts[word[:size] + "*"] += n
    return counts


def terms_of(text: str | None) -> list[str]:
    """The terms of a text; ``word#3`` stands for three occurrences or more."""
    return [t if level == 1 else f"{t}#{level}" for t, n in _counted(text).items() for level in LEVELS if n >= level]


def examples(labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """(example, toxic): the labelled rows to learn from."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id"))
    return usable.groupBy(F.col("doc_id").alias("example")).agg(F.max("toxic").cast("int").alias("toxic")).orderBy(
        F.xxhash64("example"), "example").limit(limit)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial (term, toxic rows, clean rows); the empty term counts the rows themselves."""
    def flushed():
        kept = sorted(set(counts[0]) | set(counts[1]))
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), *[
            pa.array([c[t] for t in kept], pa.int64()) for c in (counts[1], counts[0])]], names=["term", "toxic", "clean"])

    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            own = counts[bool(toxic)]
            own.update(terms_of(text.as_py()))
            own[""] += 1
            if len(own) > FLUSH:
                yield flushed()
                counts = (Counter(), Counter())
    yield flushed()


def vocabulary(documents: DataFrame, sample: DataFrame, limit: int = MAX_TERMS) -> list[str]:
    """The terms that tell the labels apart.  ``sample`` is bounded, so it is broadcast."""
    known = documents.select(F.col("doc_id").alias("example"), "text").join(F.broadcast(sample), "example")
    # Copies of one text say the same thing once; otherwise every word of a much copied text looks telling.
    known = known.withColumn("hash", F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(["hash", "toxic"])
    counted = known.select("text", "toxic").mapInArrow(_presence, "term string, toxic bigint, clean bigint").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    counted = cut_lineage(counted)
    rows = counted.where("term = ''").first()
    if rows is None or not rows["a"] or not rows["b"]:
        return []
    with_term, without = rows["a"], rows["b"]
    total = with_term + without
    seen = F.col("a") + F.col("b")
    cells = ((F.col("a"), with_term * seen), (with_term - F.col("a"), with_term * (total - seen)),
             (F.col("b"), without * seen), (without - F.col("b"), without * (total - seen)))
    g2 = sum((F.when(x > 0, x * F.log(x * total / e)).otherwise(0.0) for x, e in cells), F.lit(0.0)) * 2
    tested = counted.where(f"term <> '' AND a + b >= {MIN_ROWS}")
    least = 2 * math.log(max(2, tested.count()))
    odds = F.log((F.col("a") + 0.5) * (without - F.col("b") + 0.5) / ((F.col("b") + 0.5) * (with_term - F.col("a") + 0.5)))
    best = tested.withColumn("g2", g2).where(F.abs(odds) >= math.log(MIN_ODDS)).where(F.col("g2") >= least).orderBy(F.desc("g2"), "term").limit(limit)
    return [r["term"] for r in best.select("term").collect()]


class TermFinder:
    """Vocabulary terms in a text, by number, with how often their word or prefix occurs."""

    def __init__(self, terms: list[str]):
        self.words: dict[str, list[tuple[int, int]]] = {}
        self.starts: dict[int, dict[str, list[tuple[int, int]]]] = {}
        # Most words differ from every prefix in the first letters, which one look-up tells.
        self.heads = {t.partition("#")[0][:PREFIXES[0]] for t in terms if "*" in t}
        for number, term in enumerate(terms):
            base, _, level = term.partition("#")
            start = base.endswith("*")
            table = self.starts.setdefault(len(base) - 1, {}) if start else self.words
            table.setdefault(base.rstrip("*"), []).append((int(level or 1), number))

    def __call__(self, text: str | None) -> dict[int, int]:
        words = Counter(WORD.findall((text or "").lower()))
        found = [(self.words[w], words[w]) for w in words.keys() & self.words.keys()]
        heads, shortest = self.heads, PREFIXES[0]
        likely = [w for w in words if w[:shortest] in heads]
        for size, starts in self.starts.items():
            counts: Counter = Counter()
            for word in likely:
                if word[:size] in starts and len(word) > size:
                    counts[word[:size]] += words[word]
            found += [(starts[w], n) for w, n in counts.items()]
        return {number: n for levels, n in found for level, number in levels if n >= level}


def vectors(documents: DataFrame, terms: list[str], key: str = "doc_id") -> DataFrame:
    """(id, terms, counts): which vocabulary terms each text holds, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = TermFinder(terms)
        for batch in batches:
            found = [sorted(finder(t.as_py()).items()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int32())),
                pa.array([[n for _, n in f] for f in found], pa.list_(pa.int32()))], names=["id", "terms", "counts"])

    rows = documents.select(F.col(key).alias("id"), "text")
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, terms array<int>, counts array<int>")


def weighted(terms, counts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit vector of a text: (terms, weights)."""
    at = np.asarray(terms, np.int64)
    weights = (1 + np.log(np.asarray(counts, np.float64))) * idf[at]
    return at, weights / np.sqrt((weights * weights).sum()) if len(at) else weights


class BlockMaxIndex:
    """Postings by term and block of vectors, with the largest weight of each; equal vectors are one entry."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], terms: int):
        members: dict[tuple, list[int]] = {}
        for example, (t, w) in enumerate(rows):
            members.setdefault((tuple(t.tolist()), tuple(np.round(w, 12).tolist())), []).append(example)
        # Vectors led by the same term lie together, which keeps the maxima of other blocks low.
        def place(key):
            lead = max(range(len(key[0])), key=lambda i: key[1][i], default=-1)
            return (key[0][lead], -key[1][lead]) if lead >= 0 else (terms, 0.0), key
        ordered = sorted(members, key=place)
        self.members = [members[key] for key in ordered]
        vectors = [rows[m[0]] for m in self.members]
        self.size, self.blocks = len(vectors), -(-len(vectors) // BLOCK)
        term = np.concatenate([t for t, _ in vectors] or [np.array([], np.int64)])
        weight = np.concatenate([w for _, w in vectors] or [np.array([], np.float64)])
        at = np.repeat(np.arange(self.size), [len(t) for t, _ in vectors])
        by = np.lexsort((at, term))
        self.at, self.weight, term = at[by], weight[by], term[by]
        group = term * max(1, self.blocks) + self.at // BLOCK
        self.starts = np.nonzero(np.r_[True, group[1:] != group[:-1]])[0] if len(group) else np.array([], np.int64)
        self.lengths = np.diff(np.r_[self.starts, len(group)])
        self.block = self.at[self.starts] // BLOCK
        self.most = np.maximum.reduceat(self.weight, self.starts) if len(group) else self.weight
        self.first = np.searchsorted(term[self.starts], np.arange(terms + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> list[tuple[int, float]]:
        """The k examples with the largest positive cosine as (example, cosine), best first, ties by example."""
        low = self.first[terms]
        span = self.first[terms + 1] - low
        groups = np.repeat(low + span - np.cumsum(span), span) + np.arange(span.sum())
        scale = np.repeat(weights, span)
        bounds = np.bincount(self.block[groups], scale * self.most[groups], self.blocks)
        order = np.argsort(-bounds, kind="stable")
        best: list[tuple[float, int]] = []
        at, step = 0, 4
        while at < len(order) and bounds[order[at]] > 0:
            if len(best) >= k and bounds[order[at]] < -best[k - 1][0] - 1e-9:
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[order[at:at + step]] = True
            on = chosen[self.block[groups]]
            picked, n = groups[on], self.lengths[groups[on]]
            postings = np.repeat(self.starts[picked] + n - np.cumsum(n), n) + np.arange(n.sum())
            scores = np.bincount(self.at[postings], np.repeat(scale[on], n) * self.weight[postings], self.size)
            found = np.nonzero(scores > 0)[0]
            if len(found) > k + 1:
                found = found[scores[found] >= np.partition(scores[found], -k - 1)[-k - 1] - 1e-9]
            for entry in found:
                score = -round(float(scores[entry]), 12)
                best += [(score, example) for example in self.members[entry][:k + 1] if example != skip]
            best = sorted(best)[:k]
            at, step = at + step, step * 4
        return [(example, -minus) for minus, example in best]


def monotone_fit(votes: np.ndarray, labels: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """(vote, probability) knots of the best non-decreasing fit, each pool smoothed by one row at the prior."""
    pools: list[list[float]] = []
    for vote in np.unique(votes):
        mine = labels[votes == vote]
        pools.append([float(vote), float(mine.sum()), float(len(mine)), float(vote)])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, ones, n, high = pools.pop()
            pools[-1][1] += ones
            pools[-1][2] += n
            pools[-1][3] = high
    knots = [(v, (ones + prior) / (n + 1)) for low, ones, n, high in pools for v in dict.fromkeys((low, high))]
    x, y = np.array(knots).T
    return x, np.maximum.accumulate(y)


@dataclass
class Model:
    terms: list[str]
    idf: np.ndarray
    ids: list[int] = field(default_factory=list)
    toxic: np.ndarray = field(default_factory=lambda: np.array([], np.int64))
    index: BlockMaxIndex | None = None
    without: float = 0.0
    knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.0]))
    known: dict = field(default_factory=dict)

    def vote(self, terms, counts, skip: int = -1) -> tuple[float, list[tuple[int, float]]] | None:
        """Share of toxic weight among the nearest examples and the examples; None without any."""
        if not len(terms) or self.index is None:
            return None
        near = self.index.nearest(*weighted(terms, counts, self.idf), NEIGHBOURS, skip)
        if not near:
            return None
        return sum(c * self.toxic[e] for e, c in near) / sum(c for _, c in near), near

    def score(self, terms, counts) -> tuple[float, list[tuple[int, float]]]:
        """Probability and examples; the last ``REMEMBERED`` distinct texts are not searched again."""
        key = tuple(terms), tuple(counts)
        if key not in self.known:
            found = self.vote(terms, counts)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[key] = (self.without, []) if found is None else (float(np.interp(found[0], *self.knots)), found[1])
        return self.known[key]


def fit(documents: DataFrame, labels: DataFrame, table: DataFrame | None = None, limit: int = MAX_EXAMPLES) -> tuple[Model, DataFrame]:
    """The model, and (id, terms, counts) of all documents, from which frequencies and examples come."""
    sample = cut_lineage(examples(labels, limit))
    terms = vocabulary(documents, sample)
    table = cut_lineage(vectors(documents, terms))
    total = table.count()
    frequency = np.zeros(len(terms))
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[r["term"]] = r["count"]
    model = Model(terms, np.log((total + 1) / (frequency + 1)) + 1)
    known = table.join(F.broadcast(sample), table["id"] == sample["example"])
    # Of several texts that share an id the one whose terms come first is learned from.
    known = known.groupBy("example").agg(F.min(F.struct("terms", "counts", "toxic")).alias("row")).select("example", "row.toxic", "row.terms", "row.counts")
    rows = sorted(known.collect())
    model.ids = [r["example"] for r in rows]
    model.toxic = np.array([r["toxic"] for r in rows], np.int64)
    prior = float(model.toxic.mean()) if rows else 0.0
    bare = np.array([r["toxic"] for r in rows if not r["terms"]], np.int64)
    model.without = float((bare.sum() + prior) / (len(bare) + 1))
    if terms and rows:
        model.index = BlockMaxIndex([weighted(r["terms"], r["counts"], model.idf) for r in rows], len(terms))
        votes = [(model.vote(r["terms"], r["counts"], at), r["toxic"]) for at, r in enumerate(rows) if r["terms"]]
        votes = [(v[0], y) for v, y in votes if v is not None]
        if votes:
            model.knots = monotone_fit(np.round([v for v, _ in votes], 9), np.array([y for _, y in votes], np.float64), prior)
    return model, table


EVIDENCE = "array<struct<doc_id:bigint,cosine:double,toxic:int>>"


def score(table: DataFrame, model: Model, shown: int = 3) -> DataFrame:
    """(id, score, evidence) for rows (id, terms, counts); evidence names the nearest examples."""
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, near = [], []
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                value, found = model.score(terms, counts)
                scores.append(value)
                near.append([{"doc_id": model.ids[e], "cosine": c, "toxic": int(model.toxic[e])} for e, c in found[:shown]])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64()), pa.array(near, kind)], names=["id", "score", "evidence"])

    return table.mapInArrow(run, f"id {table.schema['id'].dataType.simpleString()}, score double, evidence {EVIDENCE}")


def clean_rows(documents: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of ``documents``, whole, that score below ``cut``; nothing shuffles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = TermFinder(model.terms)
        for batch in batches:
            keep = []
            for text in batch.column(batch.schema.names.index("text")):
                found = sorted(finder(text.as_py()).items())
                keep.append(model.score([t for t, _ in found], [n for _, n in found])[0] < cut)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
