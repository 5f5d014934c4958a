"""Operator 4: document fingerprints, and how they move when half a text is replaced.

Documents are ordered by descending doc_id (ties by text, a null id last); the next of the last
is the first. Defined results: a null text is an empty one; the fingerprint of an empty text is
the empty string and is like another empty one only; a single document is its own next; no rows
give no rows; other columns are not read.

The range-partitioned sort hands each task a run of the order. A task finishes all its rows but
the last, whose next document opens the following run. Only those edges, two rows per task, are
joined afterwards. The staged runs hold digests in their packed form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidegate.llm import digest, scan
from tidegate.llm.common import stage

PIECE_BYTES = 1 << 18
RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
          "near_edited double, near_next double")
EDGES = f"{RESULT}, part int, kind string, edge_text string, edge_digest binary"
_NAMES = [c.split()[0] for c in EDGES.split(", ")]


def level_ranks(docs: DataFrame) -> np.ndarray:
    """The rank of each entropy level: the fewer windows of the whole corpus have it, the lower."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(digest.LEVELS, np.int64)
        for batch in batches:
            for _, _, texts in scan.text_chunks(batch.column(0), PIECE_BYTES):
                total += digest.level_counts(texts)
        level = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(total[level], pa.int64())], ["level", "n"])

    # At most LEVELS rows reach the driver, whatever the corpus holds.
    rows = docs.select("text").mapInArrow(count, "level int, n bigint").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(digest.LEVELS, np.int64)
    for row in rows:
        counts[row["level"]] = row["n"]
    rank = np.empty(digest.LEVELS, np.int64)
    rank[np.lexsort((np.arange(digest.LEVELS), counts))] = np.arange(digest.LEVELS)
    return rank


def digests_of(texts: list[str], rank: np.ndarray) -> list[bytes]:
    out: list[bytes] = []
    for _, _, piece in scan.text_chunks(pa.array(texts, pa.large_string()), PIECE_BYTES):
        out += digest.digests(piece, rank)
    return out


def edited(text: str, following: str) -> str:
    """The last half of the code points gives way to as many of the next text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _finish(rows: list[tuple], rank: np.ndarray) -> list[tuple]:
    """Result rows from (doc_id, text, digest, next text, next digest)."""
    changed = [edited(text, following) for _, text, _, following, _ in rows]
    after = digests_of(changed, rank)
    return [(doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), own, other,
             digest.likeness(own, other), digest.likeness(own, following))
            for (doc_id, text, own, _, following), new, other in zip(rows, changed, after)]


def _batch(rows: list[tuple], part: int | None = None) -> pa.RecordBatch:
    schema = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(),
              pa.int32(), pa.string(), pa.string(), pa.binary()]
    width = len(schema) if part is not None else 7
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], schema[c]) for c in range(width)], _NAMES[:width])


def _run(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    last = None
    for batch in batches:
        for a, b, _ in scan.text_chunks(batch.column(1), 1 << 22):
            ids = batch.column(0).slice(a, b - a).to_pylist()
            texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
            rows = list(zip(ids, texts, digests_of(texts, rank)))
            out = []
            if last is None:
                out.append((None,) * 7 + (part, "head", rows[0][1], rows[0][2]))
            chain = ([last] if last else []) + rows
            done = _finish([(*x, y[1], y[2]) for x, y in zip(chain, chain[1:])], rank)
            last = chain[-1]
            out += [(*r[:3], digest.packed(r[3]), digest.packed(r[4], r[3]), *r[5:], part, "row", None, None) for r in done]
            if out:
                yield _batch(out, part)
    if last is not None:
        yield _batch([(last[0],) + (None,) * 6 + (part, "tail", last[1], last[2])], part)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of (doc_id, text) and of the edited texts, with their likeness; see the module's text."""
    rank = level_ranks(docs)
    order = F.desc_nulls_last("doc_id")
    ordered = docs.select("doc_id", "text").repartitionByRange(order).sortWithinPartitions(order, F.desc_nulls_last("text"))
    runs = stage(ordered.mapInArrow(lambda b: _run(b, rank), EDGES), "fingerprint-runs")
    heads = runs.filter("kind = 'head'").select(F.col("part").alias("_head"), F.col("edge_text").alias("next_text"),
                                                F.col("edge_digest").alias("next_digest"))
    tails = runs.filter("kind = 'tail'").select("part", "doc_id", "edge_text", "edge_digest")
    # One number per task: the run after each run, and the first after the last.
    parts = runs.filter("kind = 'head'").select("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(whole)).alias("_head"))
    meeting = tails.join(F.broadcast(following), "part").join(heads, "_head").select(
        "doc_id", "edge_text", "edge_digest", "next_text", "next_digest")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _batch(_finish(list(zip(*(c.to_pylist() for c in batch.columns))), rank))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [digest.unpacked(x) for x in batch.column(3).to_pylist()]
            other = [digest.unpacked(x, base) for x, base in zip(batch.column(4).to_pylist(), own)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(own, pa.binary()), pa.array(other, pa.binary()),
                                              *batch.columns[5:]], _NAMES[:7])

    rows = runs.filter("kind = 'row'").select(*[c.split()[0] for c in RESULT.split(", ")]).mapInArrow(unpack, RESULT)
    return rows.unionByName(meeting.mapInArrow(close, RESULT)).withColumn("edited_sha256", F.lower(F.hex("edited_sha256")))

