"""Token alignment against nested loops over whole-text tokenizations."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from zephyrgrid.llm import tokenalign
from zephyrgrid.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ZEROS = [0] * 6
WHOLE = Tokenizer.from_file(A)
WHOLE.encode_special_tokens = True


@pytest.fixture(scope="module")
def both():
    return tokenalign.Aligner(A, B)


def _links(both, text):
    """(links, groups) by comparing byte ranges token by token; None where the text is not spelled."""
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = WHOLE.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    sides = []
    for ids, spelled in ((a, both.a_bytes), (b, both.b_bytes)):
        if b"".join(spelled[i] for i in ids) != whole:
            return None
        at, ranges = 0, []
        for i in ids:
            ranges.append((at, at + len(spelled[i]), i))
            at += len(spelled[i])
        sides.append(ranges)
    links = [(x, y) for s, e, x in sides[0] for t, f, y in sides[1] if s < f and t < e]
    ends = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
    groups, start = [], 0
    for end in ends:
        groups.append("|".join(",".join(str(i) for s, e, i in side if start < e <= end) for side in sides))
        start = end
    return len(a), len(b), groups, links


def _expected(both, texts):
    found = [_links(both, t) for t in texts]
    uses = Counter(link for f in found if f for link in f[3])
    top = Counter()
    for (_, b), n in uses.items():
        top[b] = max(top[b], n)
    return [[*ZEROS, ""] if f is None else [
        f[0], f[1], len(f[2]), len(f[3]), sum(uses[x] == top[x[1]] for x in f[3]), sum(uses[x] for x in f[3]), ";".join(f[2])] for f in found]


TEXTS = [
    None, "", " ", "\n", "plain words here", "  two  blanks\n\nand lines \n mixed\t\ttabs ", "\nfirst line", "ends with blank ", "a▁b", "x ▁ y",
    "<s>special</s> <|endoftext|> <unk> [INST]", "é è naïve ﬁ ９ 漢字かな 🙂👍🏽  x  y　z", "nul\x00byte \x1c\x1d sep\x85 end", "it's they'll \n I'd",
    "<0x41> <0x0A>", "same words", "same words", "don't\nstop.\nNow", "tail\n", "\t\n\t", "a" * 300, "．。、 漢字 " * 30]


def _rows(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "c", "c") for i, t in zip(ids or range(len(texts)), texts)], "doc_id bigint, text string, pair string, id string")


@pytest.mark.parametrize("bound", [tokenalign.BROADCAST_PAIRS, 0])
def test_counts_and_groups_equal_brute_force(spark, both, bound):
    pick = random.Random(3)
    texts = TEXTS + [" ".join("".join(pick.choices("abcdeé.\n", k=pick.randrange(1, 9))) for _ in range(pick.randrange(60))) for _ in range(40)]
    ids = [None if i % 9 == 4 else i for i in range(len(texts))]
    found = tokenalign.align(_rows(spark, texts, ids), A, B, broadcast_pairs=bound)
    want = Counter((i, *e) for i, e in zip(ids, _expected(both, texts)))
    assert Counter(tuple(r) for r in found.collect()) == want


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="ab .\n\té▁'漢 \x1c1🙂", max_size=40))
def test_chunks_keep_both_tokenizations(both, text):
    parts = tokenalign.chunks_of(" " + text) if text else []
    assert "".join(map(tokenalign.literal, parts)) == (" " + text if text else "")
    rows = both.numbers(parts)
    held = both.known()
    want = _links(both, text)
    if want is None:
        assert not text or not held.fine[rows].all()
    else:
        assert held.counts[rows].sum(axis=0).tolist() == [want[0], want[1], len(want[2]), len(want[3])]
        assert ";".join(both.groups[r] for r in rows) == ";".join(want[2])


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 9))
def test_pieces_of_any_size_give_the_same_merge(left, right, piece):
    a, b = (np.array(sorted({*side, 61}), np.int64) for side in (left, right))
    i, j, closes = tokenalign.merge_paths(a, b, piece)
    ends = sorted({*a.tolist(), *b.tolist()})
    assert [(x, y) for x, y in zip(i.tolist(), j.tolist())] == [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in ends]
    assert closes.tolist() == [e in a and e in b for e in ends]
    whole = tokenalign.merge_paths(a, b, 10_000)
    assert all(np.array_equal(x, y) for x, y in zip(whole, (i, j, closes)))


def test_stretches_and_a_small_memory_change_nothing(spark, both, monkeypatch):
    text = " ".join(f"word{i % 977}" + "\n" * (i % 50 == 0) for i in range(4000))
    monkeypatch.setattr(tokenalign, "STRETCH", 500)
    assert "".join(tokenalign.stretches_of(text, 500)) == " " + text and len(list(tokenalign.stretches_of(text, 500))) > 20
    rows = tokenalign._numbered(both, [text, "x", ""])
    assert ";".join(both.groups[r] for r in rows[0]) == ";".join(_links(both, text)[2]) and len(rows[2]) == 0


def test_query_digests_the_groups(spark, both):
    rows = {r["doc_id"]: r for r in QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(12).collect()
    assert len(rows) == 200
    for d in docs:
        a, b, groups, links = _links(both, d["text"])
        r = rows[d["doc_id"]]
        assert [r["n_a"], r["n_b"], r["n_groups"], r["n_links"]] == [a, b, len(groups), len(links)]
        assert r["groups_sha256"] == hashlib.sha256(";".join(groups).encode()).hexdigest()


def test_empty_table(spark):
    assert tokenalign.align(_rows(spark, TEXTS).where("false"), A, B).count() == 0
    assert tokenalign.align(_rows(spark, [None, ""]), A, B).count() == 2
    unspelled = tokenalign.align(_rows(spark, ["zz ▁ only here"]), A, B).collect()
    assert [tuple(r) for r in unspelled] == [(0, *ZEROS, "")]
