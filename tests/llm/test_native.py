"""URL filters, bounded sharding and exact deduplication against brute force and edge cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from zephyrgrid.llm import exactdedup, sharding, urlfilter
from zephyrgrid.session import cut_lineage

URLS = "page_id bigint, url string, host string, rule string"


def _judge_by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            return host, path, max(fits)[3], max(fits)[4]
    return host, path, None, "allow"


def test_urls_match_a_scan_of_all_rules(spark):
    rules = [*urlfilter.MAIN_RULES, ("a.org", "", "block"), ("a.org", "/x", "allow"), ("a.org", "/x/y.h", "block"),
             ("b.org", "/tie/", "allow"), ("b.org", "/tie/", "block"), ("a.org:8080", "/", "block")]
    urls = [None, "", "no scheme", "http://", "http://net", "http://x.NET/", "https://example.net/en/1?q#f", "http://xexample.net/en/",
            "http://www.a.org", "http://a.org/x", "http://a.org/xyz", "http://a.org/x/y.html", "http://b.org/tie/1", "http://a.org:8080/",
            "ftp://Example.COM/de/a/b", "http://e.org/fr/#x", "http://e.org/fr", "http://..net/a", "x://y://net/", "http://É.net/É",
            "http://h.org/" + "a/" * 5000, "http://" + "l." * 3000 + "net/" + "p" * 3000, "http://n.net/a\nb"]
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(1, "http://x.net/", "a", "b")] * 3 + [(None, "http://x.net/", "a", "b")]
    got = urlfilter.judge(spark.createDataFrame(rows, URLS), spark.createDataFrame(rules, "host string, path string, action string")).collect()
    assert Counter((r[0], *r[1:]) for r in got) == Counter((r[0], *_judge_by_hand(r[1], rules)) for r in rows)


def test_url_lists_and_tables_may_be_empty(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://x.net/", "h", "r")], URLS)
    assert urlfilter.judge(pages, none).collect()[0]["verdict"] == "allow"
    assert urlfilter.judge(pages.where("false"), urlfilter.main_rules(spark)).count() == 0
    assert urlfilter.judge(pages, spark.createDataFrame([(None, "/", "block")], none.schema)).collect()[0]["rule"] is None
    more = pages.unionByName(spark.createDataFrame([(2, "http://x.org/", None, None)], URLS))
    assert urlfilter.allowed(more, urlfilter.main_rules(spark)).collect() == more.where("page_id = 2").collect()


DOCS = "doc_id bigint, text string, shard string, hash string"


def _walk_by_hand(arcs, demand, total, shards):
    room = {s: total // shards + (s < total % shards) for s in range(shards)}
    over = []
    taken = []
    for arc, shard in arcs:
        own = min(demand.get(arc, 0), room[shard])
        room[shard] -= own
        taken.append((arc, shard, own))
        over.append(demand.get(arc, 0) - own)
    queue = []
    for step in range(2 * len(arcs)):
        arc, shard = arcs[step % len(arcs)]
        if step < len(arcs) and over[step]:
            queue.append([arc, over[step]])
        while queue and room[shard]:
            n = min(queue[0][1], room[shard])
            room[shard] -= n
            taken.append((queue[0][0], shard, n))
            queue[0][1] -= n
            if not queue[0][1]:
                queue.pop(0)
    counts = defaultdict(int)
    for arc, shard, n in taken:
        counts[arc, shard] += n
    return {k: v for k, v in counts.items() if v}


@pytest.mark.parametrize("shards,nodes,factor", [(3, 4, 7), (5, 20, 1), (7, 3, 40)])
def test_overflow_walks_clockwise(spark, shards, nodes, factor):
    arcs = cut_lineage(sharding.ring(spark, shards, nodes))
    order = [(r["arc"], r["shard"]) for r in arcs.orderBy("arc").collect()]
    demand = {a: (a * a * factor) % 11 for a, _ in order}
    total = sum(demand.values())
    table = spark.createDataFrame(list(demand.items()), "arc int, rows bigint")
    got = defaultdict(int)
    slots = defaultdict(list)
    for r in sharding.intervals(arcs, table, total, shards, 0.0).collect():
        got[r["arc"], r["shard"]] += r["high"] - r["low"]
        slots[r["shard"]] += range(r["base"], r["base"] + r["high"] - r["low"])
    assert dict(got) == _walk_by_hand(order, demand, total, shards)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_even_and_gapless_with_hot_and_repeated_rows(spark):
    rows = [(i, f"t{i}" * (i % 9), "x", "y") for i in range(700)] + [(5, "same", "x", "y")] * 300 + [(None, None, None, None)] * 3 + [(9, "", "x", "y")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sharding.assign(sharding.measured(docs), "doc_id", 7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(by) == 7
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.assign(sharding.measured(docs.where("false")), "doc_id", 7).count() == 0


def test_few_rows_move_when_a_shard_is_added(spark):
    rows = cut_lineage(spark.range(20_000).withColumnRenamed("id", "doc_id"))
    before = sharding.assign(rows, "doc_id", 20, slack=0.1).select("doc_id", F_shard("a"))
    after = sharding.assign(rows, "doc_id", 21, slack=0.1).select("doc_id", F_shard("b"))
    assert before.join(after, "doc_id").where("a <> b").count() < 0.15 * 20_000


def F_shard(name):
    from pyspark.sql import functions as F

    return F.col("shard").alias(name)


def _fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups_equal_brute_force(spark):
    rows = [(1, "Aé", "x", "h"), (2, "aé", None, None), (3, "aÉ", "x", "h"), (4, None, "x", "h"), (5, "", "x", "h"), (None, "aé", "x", "h"),
            (7, "b" * 300_000, "x", "h"), (8, "B" * 300_000, "x", "h"), (2, "aé", None, None)] + [(i, "hot", "x", "h") for i in range(100, 400)]
    rows += [(i, f"only {i}", "x", "h") for i in range(1000, 1500)] + [(None, "lone", "x", "h")] * 2
    docs = spark.createDataFrame(rows, DOCS)
    for bits in (exactdedup.MAX_BITS, 1 << 15):
        got = exactdedup.groups(docs, max_bits=bits).collect()
        want = defaultdict(list)
        for i, t, *_ in rows:
            want[_fold(t)].append(i)
        assert len(got) == len(rows)
        groups = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in want.items()}
        kept = Counter()
        for r in got:
            ids = groups[r["text_sha256"]]
            assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
            kept[r["text_sha256"]] += r["kept"]
            assert not r["kept"] or r["doc_id"] == r["keep_id"]
        assert set(kept.values()) == {1} and len(kept) == len(groups)
        left = exactdedup.survivors(docs, max_bits=bits)
        assert left.columns == docs.columns
        assert Counter((r["doc_id"], _fold(r["text"])) for r in left.collect()) == Counter((r["keep_id"], t) for t, r in (
            (t, {"keep_id": max((i for i in ids if i is not None), default=None)}) for t, ids in want.items()))
    assert exactdedup.groups(docs.where("false")).count() == 0 and exactdedup.survivors(docs.where("false")).count() == 0


def test_rows_that_cannot_repeat_do_not_shuffle(spark):
    docs = spark.createDataFrame([(i, f"only {i}", "x", "h") for i in range(2000)], DOCS)
    hashed = cut_lineage(docs.select("doc_id", exactdedup.text_hash().alias("hash")))
    bits, blocks = exactdedup.repeated_filter(hashed, 2000)
    assert exactdedup.marked(hashed, bits, blocks).where("maybe").count() < 200
