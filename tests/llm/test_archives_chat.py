"""WARC archives and prefix-tree chat formatting: round trips, brute force and edge cases."""

import glob
import gzip
import hashlib
import io
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zephyrgrid.llm import chat, warc

PAGES = "page_id bigint, url string, html string, digest string, shard string"
ROWS = [(i, f"http://a.org/{i}?q=1 2\r\n%", f"<p>{i % 37}</p>" * (i % 5), "c", "c") for i in range(300)]
ROWS += [(900 + i, None, "hot page é", "c", "c") for i in range(200)] + [(5000, "http://x", "once", "c", "c")] * 3
ROWS += [(None, "u", "once", "c", "c"), (None, "u", "nobody", "c", "c"), (None, "v", "nobody", "c", "c"), (7000, "http://long", "x" * 3_000_000, "c", "c"), (7001, "http://none", None, "c", "c")]


def _expected(rows, least):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2] or ""].append(row)
    want = Counter()
    for text, same in groups.items():
        data = text.encode()
        top = max((r[0] for r in same if r[0] is not None), default=None)
        answered = False
        for r in same:
            first = r[0] == top and not answered
            answered |= first
            kind = "response" if first or len(data) < least else "revisit"
            want[r[0], len(data), warc.base32_sha1(data), kind, top if kind == "revisit" else None] += 1
    return want


@pytest.mark.parametrize("least", [0, 40])
def test_archives_read_back_what_was_written(spark, tmp_path, least):
    pages = spark.createDataFrame(ROWS, PAGES)
    root = f"file://{tmp_path}/w{least}"
    warc.write(pages.repartition(5), root, shard_bytes=4000, file_bytes=1500, revisit_bytes=least)
    got = warc.read(spark, root).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == _expected(ROWS, least)
    assert {(r["page_id"], r["url"]) for r in got} == {(r[0], r[1]) for r in ROWS}
    assert all((r["payload"] or b"") == next((x[2] or "").encode() for x in ROWS if x[0] == r["page_id"] and warc.base32_sha1((x[2] or "").encode()) == r["payload_digest"])
               for r in got if r["record_type"] == "response")
    listed = spark.read.parquet(f"{root}/manifest").collect()
    for m in listed:
        data = open(f"{tmp_path}/w{least}/{m['file']}", "rb").read()
        assert (len(data), hashlib.sha1(data).hexdigest()) == (m["bytes"], m["sha1"]) and (m["bytes"] <= 1500 or m["records"] == 1)
        headers = [h for h, _ in warc.records(io.BytesIO(data))]
        assert len(headers) == m["records"] + 1 and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    assert len({m["shard"] for m in listed}) > 2 and max(m["roll"] for m in listed) > 0


def test_archives_are_the_same_bytes_whatever_the_partitioning(spark, tmp_path):
    pages = spark.createDataFrame([r for r in ROWS if r[0] is not None], PAGES)
    files = []
    for parts in (1, 7):
        root = f"{tmp_path}/p{parts}"
        warc.write(pages.repartition(parts), root, shard_bytes=4000, file_bytes=1500)
        files.append({f[len(root):]: open(f, "rb").read() for f in glob.glob(f"{root}/archives/*")})
    assert files[0] == files[1] and files[0]


def test_empty_pages(spark, tmp_path):
    root = f"{tmp_path}/none"
    warc.write(spark.createDataFrame([], PAGES), root)
    assert warc.read(spark, root).count() == 0


def test_uncommitted_archives_are_not_read(spark, tmp_path):
    root = f"{tmp_path}/stray"
    warc.write(spark.createDataFrame(ROWS[:20], PAGES), root)
    with open(f"{root}/archives/part-999999-0000.warc.gz", "wb") as stray:
        stray.write(b"half a file")
    assert warc.read(spark, root).count() == 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab|<\\>\n", max_size=6), st.one_of(st.text(max_size=20), st.text(alphabet="\\<|[]/>sINTSY", max_size=25),
       st.sampled_from(["</s>[INST] ok [/INST]", "<|end|>", "\\", "<\\|", "<<SYS>><</SYS>>", "[\\INST]"]))), max_size=4))
def test_formatting_is_reversible_and_leaves_no_control_strings(turns):
    whole = "".join(chat.header(r) + chat.escape(t) + chat.END for r, t in turns)
    assert chat.parse(whole) == turns
    for _, t in turns:
        assert not any(c in chat.escape(t) for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


TALK = "conv_id bigint, turn bigint, role string, text string, part string, chain string"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _talks():
    rows = []
    for c in range(150):
        rows.append((c, 0, "user", "a common first turn"))
        rows += [(c, t, ("assistant", "user")[t % 2 == 0], f"turn {t} of {c % 40}" if c % 3 else "same") for t in range(1, 2 + c % 4)]
    rows += [(200, None, "system", "é 你好 \U0001f600"), (200, 1, None, None), (200, 1, "assistant", ""), (200, 0, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(None, 1, "user", "q"), (None, 2, "assistant", "<|end|>"), (None, 2, "assistant", "<|end|>"), (201, 0, "assistant", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("most", [64, 5])
def test_conversations_read_back_from_their_trees(spark, most):
    rows = _talks()
    talks = spark.createDataFrame([(*r, "c", "c") for r in rows], TALK)
    sequences, ends = chat.format_trees(talks, TOKENIZER, most)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(sequences, ends, TOKENIZER).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        size = sum(len(chat.header(r) + chat.escape(t) + chat.END) for r, t in turns)
        assert got[c] == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                          len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)
    assert chat.read_back(*chat.format_trees(talks.where("false"), TOKENIZER), TOKENIZER).count() == 0


def test_shared_turns_are_emitted_once_and_attend_to_their_ancestors(spark):
    rows = _talks()
    sequences, _ = chat.format_trees(spark.createDataFrame([(*r, "c", "c") for r in rows], TALK), TOKENIZER, 1000)
    chains = Counter()
    for s in sequences.collect():
        at = 0
        for n in s["nodes"]:
            chains[n["chain"]] += 1
            assert n["start"] == at
            at += n["length"]
            up, seen = n["parent"], set()
            while up >= 0:
                seen |= set(range(s["nodes"][up]["start"], s["nodes"][up]["start"] + s["nodes"][up]["length"]))
                up = s["nodes"][up]["parent"]
            assert {i for a in n["attends"] for i in range(a["start"], a["stop"])} == seen and n["position"] == len(seen)
        assert at == len(s["ids"])
    assert set(chains.values()) == {1}
