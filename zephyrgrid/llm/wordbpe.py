"""Byte-pair merges of many words at once, for vocabularies whose last token of a word carries its end.

Words of one length form the rows of a matrix.  Each step finds, in every row,
the leftmost pair of lowest rank and joins it, until no row has a pair left.  A
joined token takes part in later merges only, so joining one pair at a time is
the same as joining all equal pairs first.
"""

from __future__ import annotations

import json
from collections import defaultdict

import numpy as np

from .slots import SlotTable

END = "</w>"
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter each byte goes by: itself where printable, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """Rank and result of every pair of tokens that merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        letters = byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[c + END] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.result = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        self.pairs = SlotTable(keys)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where it is not merged."""
        found = self.pairs.find(a << 20 | b)
        return np.where(found < 0, NONE, found)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word as little-endian 32-bit numbers; words must not be empty."""
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = defaultdict(list)
        for at, word in enumerate(words):
            by_length[len(word)].append(at)
        for length, rows in by_length.items():
            letters = np.frombuffer(b"".join([words[r] for r in rows]), np.uint8).reshape(-1, length)
            tokens = self.inner[letters]
            tokens[:, -1] = self.last[letters[:, -1]]
            self._merge(tokens, rows, out)
        return out

    def _merge(self, tokens: np.ndarray, rows: list[int], out: list[bytes]) -> None:
        places = np.array(rows)
        ranks = self.ranks(tokens[:, :-1], tokens[:, 1:])
        while len(places):
            width = tokens.shape[1]
            if width > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(at)), at]
                done = best == NONE
            else:
                done = np.ones(len(places), bool)
            if done.any():
                ended = tokens[done].astype("<u4")
                flat = ended.tobytes()
                for i, place in enumerate(places[done].tolist()):
                    out[place] = flat[4 * width * i:4 * width * (i + 1)]
                going = ~done
                tokens, places = tokens[going], places[going]
                if not len(places):
                    return
                ranks, at, best = ranks[going], at[going], best[going]
            # Join at ``at``: what stands behind moves one place forward, and only two pairs change.
            n = np.arange(len(places))
            shift = np.arange(width - 1)
            source = shift + (shift > at[:, None])
            tokens[n, at] = self.result[best]
            tokens = np.take_along_axis(tokens, source, axis=1)
            if width > 2:
                # Pair j of the shorter row is old pair j before the join and j + 1 from it on.
                shift = shift[:-1]
                ranks = np.take_along_axis(ranks, shift + (shift >= at[:, None]), axis=1)
                for side in (-1, 0):
                    j = at + side
                    valid = np.nonzero((j >= 0) & (j < width - 2))[0]
                    ranks[valid, j[valid]] = self.ranks(tokens[valid, j[valid]], tokens[valid, j[valid] + 1])
            else:
                ranks = ranks[:, :0]
