"""Language identification: gradients by differences, held-out accuracy, defined cases."""

import zlib

import numpy as np
import pytest

from zephyrgrid.llm import langid
from zephyrgrid.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, score string"


def test_backpropagation_equals_differences():
    draw = np.random.default_rng(1)
    net = langid.Network.fresh(["x", "y", "z"], 4, 7)
    for kind in ("inputs", "states"):
        setattr(net, kind, [w.astype(np.float64) for w in getattr(net, kind)])
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    letters = draw.integers(0, 6, (9, 5))
    inside = (np.arange(9)[:, None] < np.array([9, 9, 7, 3, 1])).astype(np.float64)
    wanted = np.array([0, 1, 2, 1, 0])
    _, slopes = net.slopes(letters, inside, wanted)
    for part, slope in zip(net.parts(), slopes):
        for place in [tuple(draw.integers(0, n) for n in part.shape) for _ in range(6)] + [np.unravel_index(np.abs(slope).argmax(), slope.shape)]:
            kept, step = part[place], 1e-2
            losses = []
            for sign in (1, -1):
                part[place] = kept + sign * step
                losses.append(net.slopes(letters, inside, wanted)[0])
            part[place] = kept
            assert abs((losses[0] - losses[1]) / (2 * step) - slope[place]) < 2e-3


@pytest.fixture(scope="module")
def network(spark):
    return langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_every_position_is_labelled_in_both_directions(network):
    text = np.frombuffer(b"the and of with that this", np.uint8).astype(np.intp)[:, None]
    chances = network.label(text)
    assert chances.shape == (len(text), len(network.languages), 1) and np.allclose(chances.sum(axis=1), 1, atol=1e-5)
    other = text.copy()
    other[-1] = ord("q")
    assert not np.allclose(network.label(other)[0], chances[0], atol=1e-9)  # what comes later is seen
    other = text.copy()
    other[0] = ord("q")
    assert not np.allclose(network.label(other)[-1], chances[-1], atol=1e-9)


def test_pooling_does_not_depend_on_neighbours_or_blocks(network, monkeypatch):
    texts = ["x", "the thing " * 40, "été " * 31, "und nicht", "a" * 64, "b" * 65]
    raw = [t.encode() for t in texts]
    sums = langid.pooled(network, np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]))
    single = [langid.pooled(network, np.frombuffer(r, np.uint8), np.array([len(r)]))[0] for r in raw]
    assert np.allclose(sums, single, atol=1e-3) and np.allclose(sums.sum(axis=1), [len(r) for r in raw], rtol=1e-4)
    whole = langid.chances_of(network, texts[1])
    monkeypatch.setattr(langid, "STRETCH", 2 * langid.WINDOW)
    assert np.allclose(langid.chances_of(network, texts[1]), whole, atol=1e-5)


def test_held_out_accuracy_and_columns(spark):
    directory = "/root/testdata/sf0.01"
    out = QUERIES["op11_language_id"](spark, directory)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = {r["doc_id"]: r for r in out.collect()}
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(found) == len(docs) == 1000
    assert all(found[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) for d in docs)
    unseen = [d for d in docs if found[d["doc_id"]]["held_out"] and langid.has_letter(d["text"])]
    right = sum(found[d["doc_id"]]["lang_pred"] == d["lang"] for d in unseen)
    assert len(unseen) > 200 and right >= 0.98 * len(unseen)


def test_held_out_labels_and_partitioning_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(1, "another text of the same id", "fr"), (1, "a third one", "es"), (None, "no id", "xx"), (7, None, "en"), (8, "12", "yy")], DOCS.rpartition(", ")[0]))
    from pyspark.sql import functions as F

    changed = docs.withColumn("lang", F.when(langid.held_out("doc_id"), "changed").otherwise(F.col("lang")))
    samples = [langid.sample(d, 60).collect() for d in (docs.repartition(7), changed.repartition(2, "text"))]
    assert sorted(map(str, samples[0])) == sorted(map(str, samples[1])) and {r["lang"] for r in samples[0]} == {"de", "en", "es", "fr"}
    few = langid.sample(docs, 8).groupBy("lang").count().collect()
    assert all(r["count"] <= 2 for r in few)


def test_defined_cases(spark, network):
    rows = [(1, None, "en", "c"), (2, "", "en", "c"), (3, "12 34 !?", "en", "c"), (None, "the thing that was", "en", "c"), (5, "the thing that was", "en", "c"),
            (5, "the thing that was", "en", "c"), (6, "é", "en", "c"), (7, "漢字", "en", "c"), (8, "The thing. " * 60_000 * 2, "en", "c")]
    found = langid.predict(spark.createDataFrame(rows, DOCS), network).collect()
    assert [(r["lang_pred"], r["score"]) for r in found if r["id"] in (1, 2, 3)] == [("und", 0.0)] * 3
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert len({(r["lang_pred"], r["score"]) for r in found if r["id"] in (None, 5)}) == 1
    assert all(r["lang_pred"] in network.languages for r in found if r["id"] in (6, 7, 8))
    unlabelled = spark.createDataFrame([(i, "some words", None, "c") for i in range(9)], DOCS)
    assert {r["lang_pred"] for r in langid.predict(unlabelled, langid.fit(unlabelled)).collect()} == {"und"}
    assert langid.predict(unlabelled.where("false"), network).count() == 0
