"""The five stages on whole small tables: columns, decisions and planted cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from zephyrgrid.llm import packing, quality

SMALL = "/root/testdata/sf0.01"


def _fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "exact dedup", "near-dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The small documents plus exact copies, a near copy, toxic and clean ones."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = docs.join(spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id"), "doc_id")
    lines = good.where("lang = 'en' AND size(split(text, ' ')) BETWEEN 800 AND 3000").orderBy("doc_id").first()["text"].split("\n")
    random.Random(4).shuffle(lines)  # a clean text that is not in the table
    clean = "\n".join(lines)
    toxic = "You are an idiot and a moron, a loser and pathetic scum. " + clean[:900]
    rows = [(10_000, clean, "en", "p", 0), (10_001, clean.replace("the ", "The "), "en", "p", 0), (10_002, clean + "\nThe end.", "en", "p", 0),
            (10_003, toxic, "en", "p", 0), (10_004, "too short", "en", "p", 0), (10_005, None, "en", "p", 0), (None, clean + "\nThan other.", "en", "p", 0)]
    path = str(tmp_path_factory.mktemp("stages"))
    spark.createDataFrame(rows, docs.schema).unionByName(docs).write.parquet(f"{path}/0")
    return path


def test_every_stage_decides_by_its_rule(spark, planted):
    before = spark.read.parquet(f"{planted}/0")
    seen = []
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, SMALL)
        if at < 4:
            assert out.columns == before.columns and dict(out.dtypes) == dict(before.dtypes)
        out.write.parquet(f"{planted}/{at + 1}")
        before = spark.read.parquet(f"{planted}/{at + 1}")
        seen.append([r.asDict() for r in before.collect()])
    start = [r.asDict() for r in spark.read.parquet(f"{planted}/0").collect()]
    ids = [{r["doc_id"] for r in rows} for rows in (start, *seen[:4])]
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}

    # Toxicity: the planted document goes, clean ones stay.
    assert 10_003 not in ids[1] and {10_000, 10_001, 10_002, 10_004, 10_005, None} <= ids[1]
    good = [i for i, r in labels.items() if not r["toxic"] and i in ids[0]]
    assert sum(i in ids[1] for i in good) >= 0.99 * len(good)

    # Quality: nobody stays who fails the base rule; clean documents that pass it do.
    texts = {r["doc_id"]: r["text"] for r in start}
    base = {i: quality.failed_base(*[quality.statistics(t)[0][k] for k in (0, 4)]) for i, t in texts.items()}
    assert not any(base[i] for i in ids[2]) and {10_000, 10_001, 10_002} <= ids[2]
    good = [i for i, r in labels.items() if r["quality"] and i in ids[1] and not base[i]]
    assert sum(i in ids[2] for i in good) >= 0.99 * len(good)

    # Exact copies: the largest id of each text.
    largest = defaultdict(list)
    for r in seen[1]:
        largest[_fold(r["text"])].append(r["doc_id"])
    assert ids[3] == {max((i for i in same if i is not None), default=None) for same in largest.values()}
    assert len(seen[2]) == len(largest)

    # Near copies: the smallest id within reach over a similarity of 0.8 between sets of five-word shingles.
    sets = []
    for r in seen[2]:
        words = re.findall(r"[^ \t-\r]+", _fold(r["text"]))
        sets.append(frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))))
    holders = defaultdict(list)
    for at, shingles in enumerate(sets):
        for s in shingles:
            holders[s].append(at)
    group = list(range(len(sets)))
    for i, shingles in enumerate(sets):
        shared = Counter(j for s in shingles for j in holders[s] if j < i)
        for j, n in shared.items():
            if 5 * n >= 4 * (len(shingles) + len(sets[j]) - n):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    prints = [(None, r["doc_id"]) for r in seen[2]]
    smallest = defaultdict(list)
    for g, (_, i) in zip(group, prints):
        smallest[g].append(i)
    assert ids[4] == {min((i for i in same if i is not None), default=None) for same in smallest.values()}
    assert len(seen[3]) == len(smallest)

    # Packing: every token of what stayed, once.
    tokenizer = packing.encoder(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    want = set()
    for r in seen[3]:
        tokens = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want |= {(r["doc_id"], s, zlib.crc32(np.array(tokens[s:s + 4096], "<u4").tobytes())) for s in range(0, len(tokens), 4096)}
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in seen[4]} == want and len(seen[4]) == len(want)
    windows = defaultdict(int)
    for r in seen[4]:
        windows[r["sequence_id"]] += r["length"]
    assert max(windows.values()) <= 4096 and sum(windows.values()) > 0.98 * 4096 * (len(windows) - 1)


def test_the_whole_run_gives_packed_pieces(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
