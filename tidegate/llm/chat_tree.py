"""Operator 7: conversations as one prefix tree, with shared turns emitted once.

Every turn is formatted by a template whose control strings are escaped inside texts. A node of
the tree is a turn together with all turns before it; the smallest conversation that passes
through a node owns it, so each conversation owns one unbroken tail of its turns (possibly none).
Nodes are written in depth-first order, a conversation's own tail before the branches that
leave it. A node carries

* start: its first code point in depth-first order; subtree: code points of the node and all below it.
  Its text attends to every node whose interval [start, start + subtree) holds its own start:
  these are its ancestors and itself;
* position: the position id of its first code point, counted along its own conversation;
* loss_from, loss_to: the part of its text under the loss mask (an assistant's escaped text).

Defined results: turns are ordered by (turn, role, text) with nulls first and equal rows kept; a null
text is empty, a null role is the empty role; rows with a null conv_id are one conversation; no
rows give no rows; other columns are not read. A conversation passes through its task turn by
turn, in order, because its checksum does; only numbers are held for all of its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidegate.llm.common import stage

NO_ID = -(1 << 63)  # stands for a null conv_id inside the operator
TURN_MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
ROLE_OPEN, ROLE_CLOSE, OTHER_END = "<<ROLE>>", "<</ROLE>> ", " </s>"
_CONTROL = re.compile(r"\\|\[/?INST\]|</?s>|<</?(?:SYS|ROLE)>>")
_ESCAPED = re.compile(r"\\(.)", re.S)
_ROLE = re.compile(r"<<ROLE>>((?:\\.|[^\\])*?)<</ROLE>> ", re.S)

CHAIN = "conv bigint, pos bigint, node binary, size bigint, position bigint, piece string, loss_from bigint, loss_to bigint"
DIRECTORY = "conv bigint, pos bigint, owner bigint, below bigint, path array<struct<depth:bigint,conv:bigint>>"
TREE = ("part int, part_start bigint, owner bigint, pos bigint, position bigint, size bigint, subtree bigint, "
        "piece string, loss_from bigint, loss_to bigint")


def escape(text: str) -> str:
    """A backslash before every backslash and every control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of the loss mask in it); the mask is empty but for assistants."""
    opening, closing = TURN_MARKS.get(role) or (ROLE_OPEN + escape(role) + ROLE_CLOSE, OTHER_END)
    body = escape(text)
    learned = len(body) if role == "assistant" else 0
    return opening + body + closing, len(opening), len(opening) + learned


def parse_turn(piece: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    if piece.startswith(ROLE_OPEN):
        role = _ROLE.match(piece)
        return unescape(role[1]), unescape(piece[role.end():len(piece) - len(OTHER_END)])
    for role, (opening, closing) in TURN_MARKS.items():
        if piece.startswith(opening) and piece.endswith(closing):
            return role, unescape(piece[len(opening):len(piece) - len(closing)])
    raise ValueError("not a formatted turn")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _out(rows: Iterator[tuple], schema: str, most: int = 4096) -> Iterator[pa.RecordBatch]:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "array<struct<depth:bigint,conv:bigint>>": pa.list_(pa.struct([("depth", pa.int64()), ("conv", pa.int64())]))}
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], kinds[k]) for i, (_, k) in enumerate(fields)],
                                          [n for n, _ in fields])

    for row in rows:
        held.append(row)
        if len(held) == most:
            yield batch()
            held = []
    if held:
        yield batch()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def turns():
        last, node, pos, position = None, b"", 0, 0
        for conv, role, text in _rows(batches):
            if conv != last:
                last, node, pos, position = conv, b"", 0, 0
            piece, a, b = format_turn(role, text)
            node = hashlib.blake2b(node + piece.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            yield conv, pos, node, len(piece), position, piece, a, b
            pos, position = pos + 1, position + len(piece)

    return _out(turns(), CHAIN)


def _directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def one(conv: int, owners: list[int], sizes: list[int]):
        path, last = [], None
        for pos, owner in enumerate(owners):
            if owner != last:
                path.append({"depth": -pos, "conv": owner})
                last = owner
        left = sum(s for s, o in zip(sizes, owners) if o == conv)
        for pos, (owner, size) in enumerate(zip(owners, sizes)):
            yield conv, pos, owner, left, path if owner == conv else None
            left -= size if owner == conv else 0

    def all_rows():
        last, owners, sizes = None, [], []
        for conv, owner, size in _rows(batches):
            if conv != last and owners:
                yield from one(last, owners, sizes)
                owners, sizes = [], []
            last = conv
            owners.append(owner)
            sizes.append(size)
        if owners:
            yield from one(last, owners, sizes)

    return _out(all_rows(), DIRECTORY)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()

    def nodes():
        start = 0
        for row in _rows(batches):
            yield (part, start, *row)
            start += row[3]

    return _out(nodes(), TREE, 1024)


def build(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes in depth-first order, directory) of (conv_id, turn, role, text).

    The directory names, for every turn of every conversation, the node that holds it.
    """
    rows = turns.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("conv"), "turn",
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    chain = stage(ordered.mapInArrow(_chain, CHAIN), "chat-chain")
    # Written out, so that adaptive execution may split the join on a node that many share.
    owners = stage(chain.groupBy("node").agg(F.min("conv").alias("owner")), "chat-owners")
    owned = chain.select("conv", "pos", "node", "size").join(owners, "node").select("conv", "pos", "owner", "size")
    in_order = owned.repartition("conv").sortWithinPartitions("conv", "pos").select("conv", "owner", "size")
    directory = stage(in_order.mapInArrow(_directory, DIRECTORY), "chat-directory")
    below = directory.groupBy("owner", "pos").agg(F.sum("below").alias("subtree"))
    own = directory.filter("owner = conv").select("owner", "pos", "path")
    texts = chain.select(F.col("conv").alias("owner"), "pos", "position", "size", "piece", "loss_from", "loss_to")
    nodes = own.join(below, ["owner", "pos"]).join(texts, ["owner", "pos"])
    depth_first = nodes.repartitionByRange("path", "pos").sortWithinPartitions("path", "pos").select(
        "owner", "pos", "position", "size", "subtree", "piece", "loss_from", "loss_to")
    tree = stage(depth_first.mapInArrow(_emit, TREE), "chat-tree")
    # One row per writing task, so the broadcast is bounded by their number.
    totals = tree.groupBy("part").agg(F.sum("size").alias("_size"))
    earlier = totals.select("part", F.coalesce(F.sum("_size").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = tree.join(F.broadcast(earlier), "part").select(
        "owner", "pos", (F.col("_before") + F.col("part_start")).alias("start"), "size", "subtree", "position", "piece",
        "loss_from", "loss_to")
    return placed, directory.select("conv", "pos", "owner")


RESULT = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def conversations():
        last, state = None, None

        def result():
            n, turns, chars, loss, formatted = state
            return (None if last == NO_ID else last, n, turns.hexdigest(), chars, loss.hexdigest(), formatted)

        for conv, piece, a, b in _rows(batches):
            if conv != last or state is None:
                if state is not None:
                    yield result()
                last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_turn(piece)
            learned = unescape(piece[a:b])
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[2] += len(learned)
            state[3].update(learned.encode("utf-8", "surrogatepass"))
            state[4] += len(piece)
        if state is not None:
            yield result()

    return _out(conversations(), RESULT)


def read_back(nodes: DataFrame, directory: DataFrame) -> DataFrame:
    """One row per conversation, from the emitted nodes alone."""
    texts = directory.join(nodes.select("owner", "pos", "piece", "loss_from", "loss_to"), ["owner", "pos"])
    ordered = texts.select("conv", "pos", "piece", "loss_from", "loss_to").repartition("conv").sortWithinPartitions("conv", "pos")
    return ordered.select("conv", "piece", "loss_from", "loss_to").mapInArrow(_read, RESULT)
