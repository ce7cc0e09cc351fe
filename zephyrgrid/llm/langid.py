"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``WINDOW`` bytes.  In each window one gated recurrent
unit reads forwards and one backwards; from both states a softmax layer labels
every byte position with a distribution over the languages.  The mean of these over
all positions of a text gives the language of the text and its score.

The network is trained in numpy by backpropagation through time.  It learns from a
bounded sample: at most ``MAX_EXAMPLES`` texts, shared evenly among the at most
``MAX_LANGUAGES`` most frequent languages, and of each text ``WINDOWS_PER_TEXT``
windows spread over its whole length.  The sample is chosen by hashes of ids, so
partitioning does not change it; of rows that share an id the first by hash of the
text counts.  Prediction reads whole texts, in one pass, without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a
null id is not held out and nothing is learned from it; ``lang`` null is never
learned; with no learned language at all every text is ``und``; repeated rows each
give a row; a very long text is read in blocks of windows; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import stretches

UNKNOWN = "und"
WINDOW = 64
HIDDEN = 8
MAX_EXAMPLES = 4_000
MAX_LANGUAGES = 256
WINDOWS_PER_TEXT = 6
STEPS, BATCH, RATE = 300, 384, 0.012
SEED = 11
BLOCK = 2048  # windows that walk side by side
STRETCH = 1 << 20
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def held_out(key: str | Column) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place: between -1 and 1, and far cheaper than a hyperbolic tangent."""
    below = np.abs(x)
    below += np.float32(1)
    x /= below
    return x


def _gate(x: np.ndarray) -> np.ndarray:
    """The same between 0 and 1, in place."""
    _squash(x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def _gate_slope(gate: np.ndarray) -> np.ndarray:
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


@dataclass
class Network:
    """Weights of both directions (0 forwards, 1 backwards) and of the output layer.

    ``inputs`` has one column per byte value with the shares of the update gate, the
    reset gate and the candidate one below the other; ``states`` likewise per state.
    Windows lie side by side in the last axis of every array.
    """

    languages: list[str]
    inputs: list[np.ndarray]
    states: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int) -> "Network":
        draw = np.random.default_rng(seed)
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        return cls(languages, [normal(3 * hidden, 256, scale=0.3) for _ in range(2)], [normal(3 * hidden, hidden, scale=hidden ** -0.5) for _ in range(2)],
                   normal(len(languages), 2 * hidden, scale=0.3), np.zeros((len(languages), 1), np.float32))

    def parts(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, self.out, self.bias]

    def read(self, letters: np.ndarray, direction: int, inside: np.ndarray | None = None, trace: list | None = None) -> np.ndarray:
        """States (position, unit, window) after each of ``letters`` (position, window).

        Where ``inside`` is false the state stays zero.  ``trace`` gets what the way back needs.
        """
        table, weights = self.inputs[direction], self.states[direction]
        h = weights.shape[1]
        state = np.zeros((h, letters.shape[1]), np.float32)
        out = np.empty((len(letters), *state.shape), np.float32)
        given = np.empty((3 * h, letters.shape[1]), np.float32)
        for t in range(len(letters)) if direction == 0 else range(len(letters) - 1, -1, -1):
            np.take(table, letters[t], axis=1, out=given, mode="clip")
            kept = weights @ state
            gates = _gate(given[:2 * h] + kept[:2 * h])
            update, reset = gates[:h], gates[h:]
            candidate = kept[2 * h:] * reset
            candidate += given[2 * h:]
            _squash(candidate)
            if trace is not None:
                trace.append((t, state, update, reset, candidate, kept[2 * h:]))
            new = out[t]
            np.subtract(candidate, state, out=new)
            new *= update
            new += state
            if inside is not None:
                new *= inside[t]
            state = new
        return out

    def label(self, letters: np.ndarray, inside: np.ndarray | None = None, both: list[np.ndarray] | None = None) -> np.ndarray:
        """Probabilities (position, language, window)."""
        both = both or [self.read(letters, d, inside) for d in (0, 1)]
        h = both[0].shape[1]
        scores = self.out[:, :h] @ both[0]
        scores += self.out[:, h:] @ both[1]
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def slopes(self, letters: np.ndarray, inside: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """(mean cross entropy over all positions, its gradient by each of `parts`) by backpropagation through time."""
        traces: list[list] = [[], []]
        both = [self.read(letters, d, inside, traces[d]) for d in (0, 1)]
        chances = self.label(letters, inside, both)
        count = inside.sum()
        at = np.arange(letters.shape[1])
        loss = -(np.log(np.maximum(chances[:, wanted, at], 1e-12)) * inside).sum() / count
        error = chances
        error[:, wanted, at] -= 1
        error *= (inside / count)[:, None]
        h = both[0].shape[1]
        out = np.concatenate([np.einsum("tlb,thb->lh", error, side, optimize=True) for side in both], axis=1)
        gradients: list[list[np.ndarray]] = [[], []]
        for d in (0, 1):
            weights = self.states[d]
            back = self.out[:, d * h:(d + 1) * h].T @ error
            by_state = np.zeros_like(weights)
            by_letter = np.zeros((len(letters), 3 * h, letters.shape[1]), np.float32)
            coming = np.zeros((h, letters.shape[1]), np.float32)
            for t, before, update, reset, candidate, kept in reversed(traces[d]):
                coming = (coming + back[t]) * inside[t]
                shift = coming * update * (1 - np.abs(candidate)) ** 2
                letter = by_letter[t]
                letter[:h] = coming * (candidate - before) * _gate_slope(update)
                letter[h:2 * h] = shift * kept * _gate_slope(reset)
                letter[2 * h:] = shift
                recurrent = letter.copy()
                recurrent[2 * h:] *= reset
                by_state += recurrent @ before.T
                coming = coming * (1 - update) + weights.T @ recurrent
            order = np.argsort(letters, axis=None, kind="stable")
            values = letters.ravel()[order]
            first = np.flatnonzero(np.diff(values.astype(np.int64), prepend=-1))
            by_input = np.zeros_like(self.inputs[d])
            by_input[:, values[first]] = np.add.reduceat(by_letter.transpose(0, 2, 1).reshape(-1, 3 * h)[order], first, axis=0).T
            gradients[0].append(by_input)
            gradients[1].append(by_state)
        return float(loss), [*gradients[0], *gradients[1], out, error.sum(axis=(0, 2))[:, None]]


def train(windows: list[bytes], wanted: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH,
          rate: float = RATE, seed: int = SEED) -> Network:
    """A network for ``windows``, each labelled by the number of its language; adaptive moment steps over balanced batches."""
    network = Network.fresh(languages, hidden, seed)
    draw = np.random.default_rng(seed)
    letters = np.zeros((len(windows), WINDOW), np.intp)
    inside = np.zeros((len(windows), WINDOW), np.float32)
    for row, window in enumerate(windows):
        letters[row, :len(window)] = np.frombuffer(window, np.uint8)
        inside[row, :len(window)] = 1
    chance = 1 / np.bincount(wanted, minlength=len(languages))[wanted]
    chance /= chance.sum()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parts()]
    for step in range(1, steps + 1):
        rows = draw.choice(len(windows), batch, p=chance)
        _, slopes = network.slopes(letters[rows].T, inside[rows].T, wanted[rows])
        norm = np.sqrt(sum(float((s ** 2).sum()) for s in slopes))
        pace = rate * min(1.0, 4 * (1 - step / (steps + 1)))
        for part, slope, (mean, square) in zip(network.parts(), slopes, moments):
            slope = slope * min(1.0, 1 / max(norm, 1e-9))
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope ** 2 - square)
            part -= (pace * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return network


def _spread_windows(text: str, count: int = WINDOWS_PER_TEXT) -> list[bytes]:
    """Up to ``count`` windows, evenly spread over the whole text."""
    data = text.encode().translate(LOWER)
    starts = sorted({int(x) for x in np.linspace(0, max(0, len(data) - WINDOW), count)})
    return [data[s:s + WINDOW] for s in starts]


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        kept = pa.array([has_letter(t) for t in texts])
        windows = [_spread_windows(t) for t in texts if has_letter(t)]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).filter(kept) for c in ("example", "lang", "drawn", "named")], pa.array(windows, pa.list_(pa.binary()))],
            names=["example", "lang", "drawn", "named", "windows"])


def sample(documents: DataFrame, limit: int = MAX_EXAMPLES, most_languages: int = MAX_LANGUAGES) -> DataFrame:
    """(example, lang, windows): the bounded rows to learn from.

    Counts per language set how likely a row is drawn at all, so that only about
    twice the share of a language is ever ranked.
    """
    known = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).select(
        F.col("doc_id").alias("example"), "lang", "text", F.xxhash64(F.lit(SEED), "doc_id").alias("drawn"), F.xxhash64("text").alias("named"))
    counts = known.where("text IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(most_languages)
    counts = cut_lineage(counts)
    share = max(1, limit // max(1, counts.count()))
    luck = F.pmod("drawn", F.lit(1 << 30)) * F.col("rows") < F.lit(float(1 << 30) * 2 * max(share, 50))
    kind = known.schema["example"].dataType.simpleString()
    drawn = known.join(F.broadcast(counts), "lang").where(luck).select("example", "lang", "text", "drawn", "named").mapInArrow(
        _sample_batches, f"example {kind}, lang string, drawn bigint, named bigint, windows array<binary>")
    once = drawn.groupBy("example").agg(F.min_by(F.struct("lang", "drawn", "windows"), F.struct("named", "lang")).alias("row")).select("example", "row.*")
    order = Window.partitionBy("lang").orderBy("drawn", "example")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= share).select("example", "lang", "windows")


def fit(documents: DataFrame, limit: int = MAX_EXAMPLES, **how) -> Network | None:
    """The network trained on the sample, which is collected because its size is bounded."""
    rows = sorted((r["lang"], str(r["example"]), [bytes(w) for w in r["windows"]]) for r in sample(documents, limit).collect())
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    number = {name: at for at, name in enumerate(languages)}
    windows = [w for r in rows for w in r[2]]
    wanted = np.array([number[r[0]] for r in rows for _ in r[2]], np.int64)
    return train(windows, wanted, languages, **how)


def pooled(network: Network, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the position probabilities over each of the texts that lie end to end in ``data``."""
    total = np.zeros((len(sizes), len(network.languages)))
    begins = np.cumsum(sizes) - sizes
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + nth * WINDOW
    lengths = np.minimum(WINDOW, begins[owner] + sizes[owner] - starts)
    order = np.argsort(-lengths, kind="stable")
    padded = np.append(data, np.zeros(WINDOW, np.uint8))
    for at in range(0, len(order), BLOCK):
        rows = order[at:at + BLOCK]
        positions = np.arange(lengths[rows[0]])
        letters = padded[positions[:, None] + starts[rows]].astype(np.intp)
        inside = (positions[:, None] < lengths[rows]).astype(np.float32) if lengths[rows[-1]] < len(positions) else None
        chances = network.label(letters, inside)
        if inside is not None:
            chances *= inside[:, None]
        np.add.at(total, owner[rows], chances.sum(axis=0).T)
    return total


def chances_of(network: Network, text: str) -> np.ndarray:
    """The pooled distribution of one text, read in blocks."""
    data = np.frombuffer(text.encode().translate(LOWER), np.uint8)
    parts = [data[a:a + STRETCH] for a in range(0, len(data), STRETCH)]
    return sum(pooled(network, p, np.array([len(p)]))[0] for p in parts) / max(1, len(data))


def _predict_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            names, scores = [], []
            texts = batch.column("text").to_pylist()
            texts = [t if network is not None and has_letter(t) else "" for t in texts]
            for a, b in stretches(texts, STRETCH):
                if b - a == 1 or len(texts[b - 1]) > STRETCH:
                    found = [chances_of(network, t) if t else None for t in texts[a:b]]
                else:
                    raw = [t.encode().translate(LOWER) for t in texts[a:b]]
                    sizes = np.array([len(x) for x in raw])
                    sums = pooled(network, np.frombuffer(b"".join(raw), np.uint8), sizes) if network is not None else raw
                    found = [s / n if n else None for s, n in zip(sums, sizes.tolist())]
                for chances in found:
                    best = None if chances is None else int(chances.argmax())
                    names.append(UNKNOWN if best is None else network.languages[best])
                    scores.append(0.0 if best is None else min(1.0, float(chances[best])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    return run


def predict(documents: DataFrame, network: Network | None, key: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    rows = documents.select(F.col(key).alias("id"), "text")
    shared = documents.sparkSession.sparkContext.broadcast(network)
    return rows.mapInArrow(_predict_batches(shared), f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
