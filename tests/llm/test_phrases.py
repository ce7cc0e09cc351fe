"""Phrase mining against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from zephyrgrid.llm import phrases

DOCS = "doc_id bigint, text string, lang string, n string, phrase string"


def _fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def _counted(rows):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", _fold(text)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    return counts, totals


def _expected(rows, least, kept):
    counts, totals = _counted(rows)
    out = []
    for lang, found in counts.items():
        grams = {p: n for p, n in found.items() if n >= least}
        scored = []
        for p, a in grams.items():
            longer = [q for q in grams if len(q) > len(p) and any(q[s:s + len(p)] == p for s in range(len(q) - len(p) + 1))]
            if len(p) < 2 or any(100 * grams[q] >= 80 * a for q in longer):
                continue
            score, k = min((2_000_000 * a // (grams[p[:k]] + grams[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), grams[p[:k]], grams[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:kept], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def _rows():
    pick = random.Random(12)
    texts = []
    for _ in range(150):
        words = pick.choices(["New", "york", "new York", "the", "of the", "a\tb", "x  y", "漢字", "É", "é", "big, red", "end.\nStart", "tie one", "tie two"], k=pick.randrange(40))
        texts.append(" ".join(words))
    texts += [None, "", " . , ", "one", "same text here again"] + ["same text here again"] * 9
    return [(None if i % 10 == 3 else i % 50, t, [None, "en", "de", "und"][pick.choice([0, 1, 1, 1, 1, 2, 3])]) for i, t in enumerate(texts)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS)


def _found(df, least, kept):
    found = phrases.collocations(phrases.frequent_phrases(df, least), kept)
    return sorted(tuple(r)[:8] for r in found.collect())


@pytest.mark.parametrize("kept", [2000, 5])
def test_ranking_equals_counting_by_hand(spark, kept):
    rows = _rows()
    assert _found(_frame(spark, rows), 3, kept) == _expected(rows, 3, kept)


@pytest.mark.parametrize("kept", [1 << 20, 50])
def test_collisions_and_full_filters_change_nothing(spark, monkeypatch, kept):
    """Run inside the driver with fingerprints of four bits: nearly everything collides."""
    rows = _rows()
    monkeypatch.setattr(phrases, "KEPT_RUNS", kept)
    monkeypatch.setattr(phrases, "STRETCH", 2000)
    monkeypatch.setattr(phrases, "mixed", lambda h: h & np.uint64(15))
    import pyarrow as pa

    table = pa.table({"id": pa.array([r[0] for r in rows], pa.int64()), "lang": [r[2] for r in rows], "text": [r[1] for r in rows]}).to_batches()

    class Everything:
        value = np.full(4096, 255, np.uint8)

    seen = Counter()
    for batch in phrases._phrase_batches([Everything] * 4)(iter(table)):
        for r in batch.to_pylist():
            seen[r["lang"], r["n"], r["phrase"]] += r["times"]
    counts, totals = _counted(rows)
    want = Counter({(lang, len(p), " ".join(p)): n for lang, found in counts.items() for p, n in found.items()})
    want.update({(lang, 0, ""): n for lang, n in totals.items()})
    assert seen == want


def test_long_texts_are_cut_without_losing_or_doubling(spark, monkeypatch):
    pick = random.Random(1)
    text = "".join(pick.choices(["a b", "c", "dd ee ff", "g. H", "i\tj", "  ", "k,"], k=600)).replace("b", "b ")
    parts = list(phrases.cut_long(text.lower().encode(), 40))
    assert len(parts) > 10
    runs = phrases.Runs([(p, 0, skip) for p, skip in parts], np.zeros(1, np.uint64))
    counts, _ = _counted([(1, text, "en")])
    for n in range(1, 5):
        _, valid = runs.fingerprints(n)
        spelled = Counter(b" ".join(runs.word(k) for k in range(i, i + n)).decode() for i in np.flatnonzero(valid))
        assert spelled == Counter({" ".join(p): c for p, c in counts["en"].items() if len(p) == n})


def test_examples_point_to_an_occurrence(spark):
    rows = [(i, f"so it goes {i}. It Goes on", "en") for i in range(40)]
    for r in phrases.frequent_phrases(_frame(spark, rows), 30).where("n > 0").collect():
        assert r["phrase"] in rows[r["example"]][1].lower()


def test_scores_do_not_overflow(spark):
    big = 4 * 10**15
    table = [("en", 0, "", 9 * 10**18, 1), ("en", 1, "a", big, 1), ("en", 1, "b", big, 1), ("en", 2, "a b", big, 1)]
    found = phrases.collocations(spark.createDataFrame(table, "lang string, n int, phrase string, times bigint, example bigint")).collect()
    assert [(r["score"], r["a"], r["n"]) for r in found] == [(1_000_000, big, 9 * 10**18)]


def test_empty_tables(spark):
    assert _found(_frame(spark, _rows()).where("false"), 3, 10) == []
    assert _found(_frame(spark, [(1, None, None), (2, "", "en")]), 3, 10) == []
