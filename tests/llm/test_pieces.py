"""Piece sampling: exact distribution by enumeration, losslessness, independence of batches, edge cases."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zephyrgrid.llm import piecesample

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string, id string, ids string"


def _paths(text, words):
    """Every segmentation of ``text`` with its weight."""
    if not text:
        return [((), 1.0)]
    out = []
    for size in range(1, len(text) + 1):
        piece = text[:size]
        options = []
        if piece in words.number:
            options = [((words.number[piece],), words.weight[words.number[piece]])]
        elif size == 1:
            data = piece.encode()
            options = [(tuple(int(words.byte_ids[b]) for b in data), words.rarest ** len(data))]
        for ids, w in options:
            out += [(ids + rest, w * v) for rest, v in _paths(text[size:], words)]
    return out


@pytest.mark.parametrize("text", ["the", " than", "a, b", "▁x\n  y", "é!²."])
def test_segmentations_are_drawn_in_proportion_to_their_weight(text):
    model = piecesample.Lattices(MODEL, 0.3)
    paths = _paths(text, model.words)
    whole = sum(w for _, w in paths)
    draws = 20_000
    got = Counter(tuple(x.tolist()) for x in model.sample([text] * draws, [piecesample.row_seed(i) for i in range(draws)]))
    assert set(got) <= {p for p, _ in paths}
    for path, w in paths:
        expected = draws * w / whole
        assert abs(got[path] - expected) < 5 * np.sqrt(expected) + 5


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" ▁\n.,_²ax1é", max_size=40)))
def test_decoding_is_lossless(text):
    model = piecesample.lattices(MODEL)
    assert model.words.decode(model.sample([text], [7])[0].tolist()) == text


def test_parts_never_lose_a_piece():
    words = piecesample.Vocabulary(MODEL)
    whole = [p for p in words.number if words.part.findall(p) != [p]]
    assert whole == []


def test_draws_do_not_depend_on_batches_or_on_what_was_seen_before(monkeypatch):
    texts = [f"some words of text {i}, and more.\nend" for i in range(50)] + ["x" * 5000, ""]
    seeds = [piecesample.row_seed(i) for i in range(52)]
    fresh = [piecesample.Lattices(MODEL).sample([t], [s])[0].tolist() for t, s in zip(texts[48:], seeds[48:])]
    model = piecesample.Lattices(MODEL)
    together = [x.tolist() for x in model.sample(texts, seeds)]
    monkeypatch.setattr(piecesample, "KEPT_PARTS", 0)
    assert together[48:] == fresh and [x.tolist() for x in model.sample(texts, seeds)] == together
    assert len({tuple(x.tolist()) for x in model.sample(["segmentations of unfamiliar words vary"] * 40, seeds[:40])}) > 1


def test_tables_round_trip(spark):
    rows = [(1, "some text here", "c", "c"), (2, None, "c", "c"), (3, "", "c", "c"), (None, "é\U0001f600▁ \n", "c", "c"), (1, "some text here", "c", "c"), (5, "long words " * 30_000, "c", "c")]
    docs = spark.createDataFrame(rows, DOCS)
    encoded = piecesample.encode(docs.repartition(3), MODEL)
    assert Counter((r["id"], r["text"]) for r in piecesample.decode(encoded, MODEL).collect()) == Counter((r[0], r[1]) for r in rows)
    ids = {r["id"]: r["ids"] for r in encoded.collect()}
    for r in piecesample.digests(docs.coalesce(1), MODEL).collect():
        text = next(x[1] for x in rows if x[0] == r["id"]) or ""
        found = ids[r["id"]] or []
        assert (r["n_pieces"], r["ids_crc32"]) == (len(found), zlib.crc32(np.array(found, "<u4").tobytes()))
        assert r["lossless"] and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert piecesample.digests(docs.where("false"), MODEL).count() == 0
