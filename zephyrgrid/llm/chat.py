"""Conversations formatted as prefix trees: shared initial turns are emitted once.

A turn becomes ``<|role|>text<|end|>``; control strings inside texts and roles are
broken up by a backslash, which is itself doubled, so formatting is reversible.

A node of the tree is a chain of turns, known by a hash over all of them.
Conversations with equal chains are one leaf.  A tree is all conversations with
one first turn; trees of more than ``TREE`` conversations are split, by ranges of
the second turn's hash and, where a second turn is itself that common, by the
leaf's hash, so no task gathers an unbounded tree.  Each part is one sequence:
nodes in depth-first order, every shared token once, with the position a token
has in its conversation, the intervals of ancestor tokens it may attend to
(besides earlier tokens of its own node) and the span of the loss mask, which
covers the texts of assistant turns.

A conversation travels as a stream of rows ordered by turn until it reaches its
part; what a task holds is the hash of the chain, then one part.

Defined cases: null roles and texts are empty; rows of one turn number are
ordered by role and text; null turn numbers come first; a null conversation id
is a conversation like any other; repeated rows are repeated turns; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import salted_join

TREE = 64
END = "<|end|>"
LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"\\|<(?=\||/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\])")
_HEADER = re.compile(r"<\|((?:[^|\\]|\\.)*)\|>", re.DOTALL)
NODE = ("struct<parent:int,start:int,length:int,position:int,loss_start:int,loss_length:int,is_leaf:boolean,chain:string,"
        "attends:array<struct<start:int,stop:int>>>")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def header(role: str) -> str:
    return "<|" + role.replace("\\", "\\\\").replace("|", "\\|") + "|>"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEADER.match(formatted, at)
        stop = formatted.find(END, head.end()) if head else -1
        if stop < 0:
            raise ValueError("not a formatted conversation")
        turns.append((re.sub(r"\\(.)", r"\1", head.group(1), flags=re.DOTALL), unescape(formatted[head.end():stop])))
        at = stop + len(END)
    return turns


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by (conv, turn, role, text) plus their number and the hash of the chain up to them."""
    current, at, chain = None, 0, b""
    for batch in batches:
        numbers, chains, parents = [], [], []
        for conv, role, text in zip(batch.column("conv").to_pylist(), batch.column("role"), batch.column("text")):
            if conv != current:
                current, at, chain = conv, 0, b""
            parents.append(chain.hex())
            turn = hashlib.blake2b(chain, digest_size=16)
            for part in (role.as_py().encode(), text.as_py().encode()):
                turn.update(len(part).to_bytes(8, "little") + part)
            chain = turn.digest()
            numbers.append(at)
            chains.append(chain.hex())
            at += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(numbers, pa.int64()), batch.column("role"), batch.column("text"), pa.array(chains, pa.string()),
             pa.array(parents, pa.string())], names=["conv", "number", "role", "text", "chain", "parent"])


def chained(conversations: DataFrame) -> DataFrame:
    """(conv, number, role, text, chain, parent); conv is the id as text, empty for null."""
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").drop("turn")
    return ordered.mapInArrow(_chain_batches, "conv string, number bigint, role string, text string, chain string, parent string")


def leaves(turns: DataFrame) -> DataFrame:
    """(conv, leaf, root, second) for every conversation."""
    return turns.groupBy("conv").agg(
        F.max(F.struct("number", "chain"))["chain"].alias("leaf"), F.min(F.struct("number", "chain"))["chain"].alias("root"),
        F.coalesce(F.max(F.when(F.col("number") == 1, F.col("chain"))), F.lit("")).alias("second"))


def parts(ends: DataFrame, most: int = TREE) -> DataFrame:
    """(conv, part): one conversation for each distinct leaf and the part of a tree it belongs to."""
    unique = cut_lineage(ends.groupBy("leaf").agg(F.min("conv").alias("conv"), F.first("root").alias("root"), F.first("second").alias("second")))
    large = unique.groupBy("root").agg(F.count(F.lit(1)).alias("in_tree")).where(F.col("in_tree") > most)
    heavy = unique.groupBy("root", "second").agg(F.count(F.lit(1)).alias("in_second")).where(F.col("in_second") > most)
    counted = salted_join(salted_join(unique, large, ["root"], "left"), heavy, ["root", "second"], "left")
    place = F.conv(F.substring("second", 1, 8), 16, 10).cast("double") / float(1 << 32)
    by_range = F.floor(place * F.ceil(2 * F.col("in_tree") / most))
    by_leaf = F.pmod(F.xxhash64("leaf"), F.ceil(2 * F.col("in_second") / most))
    part = F.when(F.col("in_second").isNotNull(), F.concat_ws(":", "root", "second", by_leaf.cast("string"))).when(
        F.col("in_tree").isNotNull(), F.concat_ws(":", "root", by_range.cast("string"))).otherwise(F.col("root"))
    return counted.select("conv", part.alias("part"))


class Tokens:
    """Byte-level tokens of pieces of text; decoding what was encoded gives it back exactly."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def emit(rows: list[tuple[str, str, str, str, bool]], tokens: Tokens) -> tuple[list[int], list[dict]]:
    """Token ids and nodes of one part, from (chain, parent, role, text, is_leaf) with parents before children."""
    children: dict[str, list[str]] = {}
    known: dict[str, tuple[str, str]] = {}
    ends = {chain for chain, *_, is_leaf in rows if is_leaf}
    for chain, parent, role, text, _ in rows:
        if chain not in known:
            known[chain] = role, text
            children.setdefault(parent, []).append(chain)
    order, number = [], {}
    stack = [(c, -1) for c in sorted(children.get("", []), reverse=True)]
    while stack:
        chain, parent = stack.pop()
        number[chain] = len(order)
        order.append((chain, parent))
        stack += [(c, number[chain]) for c in sorted(children.get(chain, []), reverse=True)]
    heads = {role: ids for role in {known[c][0] for c, _ in order} for ids in tokens.encode([header(role)])}
    end = tokens.encode([END])[0]
    bodies = tokens.encode([escape(known[c][1]) for c, _ in order])
    ids: list[int] = []
    nodes: list[dict] = []
    for (chain, parent), body in zip(order, bodies):
        head = heads[known[chain][0]]
        above = nodes[parent] if parent >= 0 else None
        attends = []
        if above is not None:
            attends = [dict(x) for x in above["attends"]]
            stop = above["start"] + above["length"]
            if attends and attends[-1]["stop"] == above["start"]:
                attends[-1]["stop"] = stop
            else:
                attends.append({"start": above["start"], "stop": stop})
        nodes.append({
            "parent": parent, "start": len(ids), "length": len(head) + len(body) + len(end),
            "position": above["position"] + above["length"] if above else 0, "loss_start": len(ids) + len(head),
            "loss_length": len(body) if known[chain][0] == LOSS_ROLE else 0, "is_leaf": chain in ends, "chain": chain, "attends": attends})
        ids += head + body + end
    return ids, nodes


def _node_type() -> pa.DataType:
    spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    whole = [(n, pa.int32()) for n in ("parent", "start", "length", "position", "loss_start", "loss_length")]
    return pa.list_(pa.struct([*whole, ("is_leaf", pa.bool_()), ("chain", pa.string()), ("attends", spans)]))


def _emit_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)

        def sequence(part, rows):
            ids, nodes = emit(rows, tokens)
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([ids], pa.list_(pa.int32())), pa.array([nodes], _node_type())], names=["sequence_id", "ids", "nodes"])

        current, held = None, []
        for batch in batches:
            for part, *row in zip(*[batch.column(c).to_pylist() for c in ("part", "chain", "parent", "role", "text", "is_leaf")]):
                if part != current and held:
                    yield sequence(current, held)
                    held = []
                current = part
                held.append(tuple(row))
        if held:
            yield sequence(current, held)

    return run


def format_trees(conversations: DataFrame, tokenizer: str, most: int = TREE) -> tuple[DataFrame, DataFrame]:
    """(sequences, ends): (sequence_id, ids, nodes) and (conv, leaf, root, second) naming each conversation's last node."""
    turns = cut_lineage(chained(conversations))
    ends = cut_lineage(leaves(turns))
    chosen = parts(ends, most)
    rows = salted_join(turns, chosen.join(ends.select("conv", "leaf"), "conv"), ["conv"]).withColumn("is_leaf", F.col("chain") == F.col("leaf"))
    ordered = rows.select("part", "conv", "number", "chain", "parent", "role", "text", "is_leaf").repartition("part").sortWithinPartitions("part", "conv", "number")
    return ordered.mapInArrow(_emit_batches(tokenizer), f"sequence_id string, ids array<int>, nodes array<{NODE}>"), ends


def conversation(ids: list[int], nodes: list[dict], leaf: int, tokens: Tokens) -> tuple[str, list[str]]:
    """The formatted conversation that ends at node ``leaf`` and its stretches under the loss mask.

    The text is what the leaf attends to, followed by the leaf itself.
    """
    last = nodes[leaf]
    spans = [(s["start"], s["stop"]) for s in last["attends"]] + [(last["start"], last["start"] + last["length"])]
    text = tokens.decode([i for a, b in spans for i in ids[a:b]])
    path = []
    while leaf >= 0:
        path.append(nodes[leaf])
        leaf = nodes[leaf]["parent"]
    masked = [tokens.decode(ids[n["loss_start"]:n["loss_start"] + n["loss_length"]]) for n in reversed(path) if n["loss_length"]]
    return text, masked


def _digest_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)
        for batch in batches:
            for ids, nodes in zip(batch.column("ids"), batch.column("nodes")):
                ids, nodes = ids.as_py(), nodes.as_py()
                out: list[list] = [[] for _ in range(6)]
                for at, node in enumerate(nodes):
                    if node["is_leaf"]:
                        text, masked = conversation(ids, nodes, at, tokens)
                        turns = parse(text)
                        loss = "".join(map(unescape, masked))
                        whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                        for column, value in zip(out, (node["chain"], len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))):
                            column.append(value)
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                                 names=["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return run


def read_back(sequences: DataFrame, ends: DataFrame, tokenizer: str) -> DataFrame:
    """What each conversation holds, read from the packed sequences: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    found = sequences.select("ids", "nodes").mapInArrow(
        _digest_batches(tokenizer),
        "leaf string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    each = salted_join(ends.select("conv", "leaf"), found, ["leaf"])
    return each.select(F.when(F.col("conv") != "", F.substring("conv", F.lit(2), F.length("conv")).cast("bigint")).alias("conv_id"),
                       "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
