"""SimHash components and packing against brute force and edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zephyrgrid.llm import common, packing, simhash

DOCS = "doc_id bigint, text string, fp string, root string"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components_by_hand(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBÉ \t\n\x0b\x1c é.", max_size=60))
def test_fingerprints_follow_the_definition(text):
    assert simhash.fingerprint(text) == _fingerprint_by_hand(text)


def test_long_texts_count_every_shingle():
    text = " ".join(f"w{i % 4001}" for i in range(40_000))
    assert simhash.fingerprint(text) == _fingerprint_by_hand(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_golay_code_is_perfect_and_two_errors_always_share_a_key():
    patterns = simhash.nearby_patterns()
    assert (patterns[:, 0] >= 0).all()
    assert Counter((patterns >= 0).sum(axis=1).tolist()) == {1: 277, 6: 1771}
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 400, dtype=np.int64)
    flips = [1 << a ^ 1 << b for a, b in rng.integers(0, 63, (400, 2))]
    other = values ^ np.array(flips, np.int64)
    found = [defaultdict(set), defaultdict(set)]
    for side, v in zip(found, (values, other)):
        for row, key in zip(*simhash.keys_of(v)):
            side[row].add(key)
    assert all(found[0][i] & found[1][i] for i in range(400))


@pytest.mark.parametrize("bucket", [64, 3])
def test_components_equal_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    random.seed(bucket)
    base = [random.getrandbits(64) for _ in range(40)]
    values = set(base) | {0, 1 << 63}
    for b in base[:12]:
        for _ in range(12):
            for bit in random.sample(range(64), random.randint(1, 3)):
                b ^= 1 << bit
            values.add(b)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    rows = [(i, v) for i, v in enumerate(signed)] + [(i + 1000, v) for i, v in enumerate(signed[:9])] + [(2000 + i, signed[3]) for i in range(200)]
    rows += [(None, signed[5]), (5, signed[5])]
    marked = spark.createDataFrame(rows, "id bigint, fp bigint")
    distinct = sorted(set(signed))
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    root = _components_by_hand(links, distinct)
    smallest = {}
    for i, v in rows:
        if i is not None:
            smallest[root[v]] = min(i, smallest.get(root[v], i))
    assert Counter(tuple(r) for r in simhash.near_groups(marked).select("id", "fp", "component_id").collect()) == Counter((i, v, smallest[root[v]]) for i, v in rows)


def test_components_of_hubs_and_chains(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (1001, 1000)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == _components_by_hand(pairs, {n for p in pairs for n in p})
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_row_of_each_component_stays(spark):
    near = " ".join(f"word{i}" for i in range(3000))
    rows = [(1, near, "c", "c"), (2, near.upper(), "c", "c"), (3, "other text here now", "c", "c"), (None, near, "c", "c"), (4, None, "c", "c"),
            (5, "", "c", "c"), (3, "other text here now", "d", "c"), (3, "other text here now", "c", "c"), (None, "alone without id", "c", "c")]
    rows += [(3, near, "x", "c"), (None, "another without id", "c", "c"), (6, "one id two texts", "c", "c"), (6, "of two components", "c", "c")]
    docs = spark.createDataFrame(rows, DOCS)
    kept = simhash.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["fp"]) for r in kept.collect()) == [(0, "c"), (0, "c"), (1, "c"), (3, "c"), (4, "c"), (6, "c"), (6, "c")]
    assert simhash.survivors(docs.where("false")).count() == 0


ODD = ["it's a,b  c..! x<|endoftext|>y <|endoftext|>, İ, ΟΔΟΣ. á,b ́x ²x, x², \x1cfoo\x85bar\xa0baz ﬁ, don't! 12,3",
       "﻿x, ǅ. é, é!", "", "  ", " . , !", "a" * 50_000, "你好, क़."]


@settings(max_examples=80, deadline=None)
@given(st.one_of(st.sampled_from(ODD), st.text(max_size=80), st.text(alphabet="aZéİ.,! '\ń<|>", max_size=60)))
def test_words_encode_like_whole_texts(text):
    encoder = packing.encoder(TOKENIZER)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_many_words_merge_like_one_by_one():
    encoder = packing.encoder(TOKENIZER)
    random.seed(11)
    words = ["".join(random.choice("abcdefghijklmnopqrstuvwxyzéüñ") for _ in range(random.randint(1, 25))) for _ in range(3000)]
    words += ["a", "the", "aaaaaaaaaaaaaaaa", "internationalization", "ÿ", "ß" * 40]
    for word, ids in zip(words, encoder.merges.encode([w.encode() for w in words])):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(word, add_special_tokens=False).ids


def test_emptying_the_memory_of_words_changes_nothing(monkeypatch):
    encoder = packing.WordEncoder(TOKENIZER)
    text = "one two, three one! four. five two,"
    before = encoder.encode(text)
    monkeypatch.setattr(packing, "CACHED_WORDS", 1)
    assert encoder.encode(text) == before == encoder.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 4)), max_size=6, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_fillings_are_closest(lengths, target):
    lengths = sorted(lengths, reverse=True)
    sums = {0}
    for n, c in lengths:
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= target}
    uses = packing.closest_filling(lengths, target)
    assert sum(n * u for n, u in uses.items()) == max(sums)
    assert all(u <= dict(lengths)[n] for n, u in uses.items())


def _check_packing(rows, capacity):
    windows = defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(windows)


def test_packing_covers_every_token_once(spark):
    random.seed(3)
    texts = [" ".join(random.choice("alpha beta gamma delta, eps. zeta!".split()) for _ in range(random.randint(0, 90))) for _ in range(150)]
    rows = [(i, t, "c", "c") for i, t in enumerate(texts)] + [(7, "same words", "c", "c")] * 120 + [(None, None, "c", "c"), (900, "", "c", "c"), (901, "long " * 700, "c", "c")]
    docs = spark.createDataFrame(rows, DOCS)
    placed = packing.place(packing.cut(docs, TOKENIZER, capacity=64), 64)
    got = placed.collect()
    encoder = packing.encoder(TOKENIZER).tokenizer
    want = Counter((i, tuple(encoder.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t, *_ in rows)
    ids = Counter()
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        ids[r["id"], r["start"], tuple(r["ids"]), r["doc_tokens"]] += 1
    assert ids == Counter({(i, s, t[s:s + 64], len(t)): n for (i, t), n in want.items() for s in range(0, len(t), 64)})
    total = sum(r["length"] for r in got)
    assert _check_packing(got, 64) <= -(-total // 64) + 1
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()}
    assert all(whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"] for r in got)
    assert packing.place(packing.cut(docs.where("false"), TOKENIZER)).count() == 0


def test_a_hot_length_is_ranked_in_cells(spark, monkeypatch):
    monkeypatch.setattr(common, "CELL_ROWS", 50)
    rows = spark.range(900).select("id", F.when(F.col("id") < 600, 5).otherwise(F.col("id") % 9).cast("bigint").alias("length"))
    got = defaultdict(list)
    for r in common.ranked(rows.unionByName(rows.where("id = 3")), "length", 901).collect():
        got[r["length"]].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and len(got[5]) == 634
